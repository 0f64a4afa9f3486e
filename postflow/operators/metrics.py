"""Metrics of predicted probabilities, exact at any size.

Input is a row for each post and class, ``(label, class, p)``: the true label, a class, and the
probability given to it. :func:`long_probabilities` makes it of a vector of probabilities.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.sources.storage import shared_dir, store

BINS = 10
# The least probability that counts, so that one sure miss does not make the loss infinite.
LEAST = 1e-15


def long_probabilities(df: DataFrame, labels, label: str = "label", probabilities: str = "probability") -> DataFrame:
    """``(label, class, p)`` from a vector column; ``labels`` name its places."""
    pairs = F.arrays_zip(F.array(*[F.lit(int(float(x))) for x in labels]).alias("class"), vector_to_array(probabilities).alias("p"))
    return df.select(F.col(label).cast("int").alias("label"), F.explode(pairs).alias("x")).select(
        "label", "x.class", "x.p"
    )


def log_loss(scored: DataFrame) -> DataFrame:
    """``(n, log_loss)``: the mean of ``-ln p`` of the true classes, over rows whose label is a class."""
    true = scored.filter("label = class")
    loss = -F.log(F.greatest("p", F.lit(LEAST)))
    return true.agg(F.count("*").alias("n"), F.avg(loss).alias("log_loss"))


def with_rank_below(counts: DataFrame, value: str, group: str, order: str) -> DataFrame:
    """Add ``below``: the sum of ``value`` over the rows of the same ``group`` with less ``order``.

    ``counts`` has a row for each group and order. Rows are dealt into ranges of group and order,
    the ranges are summed, and only inside a range are rows ordered: no task holds a group.
    """
    ranges = counts.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id())
    dealt = store(ranges, shared_dir(counts.sparkSession, "ranges"))
    sums = dealt.groupBy(group, "_range").agg(F.sum(value).alias("_sum"))
    # A row for each range and group that meet: about as many as there are ranges.
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = ranked.join(sums, [group, "_range"])
    return joined.withColumn("below", F.col("_before") + F.col("_inside")).drop("_before", "_inside", "_range")


def one_vs_rest_auc(scored: DataFrame) -> DataFrame:
    """``(class, positives, negatives, auc)``: the chance that a post of the class has the larger p.

    Ties count half; null where one side is empty. Rows of equal class and p merge before they are
    ranked, and sums are whole numbers throughout.
    """
    is_class = F.col("label") == F.col("class")
    counts = scored.groupBy("class", "p").agg(
        F.sum(is_class.cast("long")).alias("pos"), F.sum((~is_class).cast("long")).alias("neg")
    )
    ranked = with_rank_below(counts, "neg", "class", "p")
    won = F.col("pos").cast("decimal(38,0)") * (2 * F.col("below") + F.col("neg"))
    sums = ranked.groupBy("class").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(won).alias("_won")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    auc = F.when(pairs > 0, F.col("_won").cast("double") / (2 * pairs))
    return sums.select("class", "positives", "negatives", auc.alias("auc"))


def calibration(scored: DataFrame, bins: int = BINS) -> DataFrame:
    """``(class, bin, n, mean_p, share)``: for equal bins of p, its mean and the share that is right.

    Bins are from 0; a p of 1 belongs to the last. Bins without rows are left out.
    """
    bin_ = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int").alias("bin")
    return scored.groupBy("class", bin_).agg(
        F.count("*").alias("n"),
        F.avg("p").alias("mean_p"),
        F.avg((F.col("label") == F.col("class")).cast("double")).alias("share"),
    )
