"""Sums of which models are made, for analysis that goes on window by window.

Statistics are rows ``(kind, label, key, n, posts, total)``; those of two sets of posts merge by
adding rows of one kind, label and key, so the sums over all windows are those of their union:

- ``rows``: ``n`` posts in all;
- ``class``: ``n`` posts of a label;
- ``term``: the occurrences ``n`` of the term ``key`` in posts of a label, and the ``posts`` of it;
- ``centre``: ``n`` points of the cluster ``label``, their ``total`` in the dimension ``key``.

Models are tables over terms, never objects on the driver; only what has a row for each class,
or for each cluster, is small.
"""

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.operators.cluster import nearest_centres
from postflow.operators.joins import BROADCAST_ROWS, lookup_join
from postflow.operators.text import term_counts
from postflow.sources.storage import shared_dir, store

KEY = ("kind", "label", "key")
SUMS = ("n", "posts", "total")
SCHEMA = "kind string, label int, key string, n long, posts long, total double"


def no_statistics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def _rows(df: DataFrame, kind: str, label, key, n, posts=None, total=None) -> DataFrame:
    return df.select(
        F.lit(kind).alias("kind"),
        label.cast("int").alias("label"),
        key.cast("string").alias("key"),
        n.cast("long").alias("n"),
        (F.lit(0) if posts is None else posts).cast("long").alias("posts"),
        (F.lit(0.0) if total is None else total).cast("double").alias("total"),
    )


def merge(*parts: DataFrame) -> DataFrame:
    """The statistics of all ``parts`` together."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in SUMS])


def post_statistics(posts: DataFrame, words: str = "filtered_words", label: str = "label") -> DataFrame:
    """Statistics of labelled posts with their words. Repeats within a post merge before the shuffle."""
    counts = term_counts(posts.select(F.col(label).alias("_label"), words), "_label", words)
    terms = counts.groupBy("_label", "term").agg(F.sum("tf").alias("n"), F.count("*").alias("posts"))
    classes = posts.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("n"))
    none = F.lit(None)
    return reduce(
        DataFrame.unionByName,
        [
            _rows(classes.agg(F.sum("n").alias("n")).filter("n > 0"), "rows", none, none, F.col("n")),
            _rows(classes, "class", F.col("_label"), none, F.col("n")),
            _rows(terms, "term", F.col("_label"), F.col("term"), F.col("n"), F.col("posts")),
        ],
    )


def centre_statistics(points: DataFrame, centres: DataFrame, features: str = "features") -> DataFrame:
    """Sums of the vectors nearest to each of ``centres (cluster, centre)``."""
    near = nearest_centres(points.select(features), centres, features, "_cluster")
    parts = near.select("_cluster", F.posexplode(vector_to_array(features)).alias("dim", "x"))
    sums = parts.groupBy("_cluster", "dim").agg(F.count("*").alias("n"), F.sum("x").alias("x"))
    return _rows(sums, "centre", F.col("_cluster"), F.col("dim"), F.col("n"), total=F.col("x"))


def idf_of(statistics: DataFrame) -> DataFrame:
    """``(term, df, idf)`` with ``idf = ln((m + 1) / (df + 1))`` over the m posts counted."""
    rows = statistics.filter("kind = 'rows'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("m"))
    terms = statistics.filter("kind = 'term'").groupBy(F.col("key").alias("term"))
    terms = terms.agg(F.sum("posts").alias("df"))
    idf = F.log((rows.scalar() + F.lit(1.0)) / (F.col("df") + 1.0))
    return terms.select("term", "df", idf.alias("idf"))


def bayes_of(statistics: DataFrame, smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Multinomial Naive Bayes over TF-IDF weights: ``(classes, terms)``.

    ``classes (label, prior, unseen)``: the log prior, and the log weight of a term that the class
    has never seen. ``terms (label, term, idf, weight)``: the log weights of the terms it has. As
    the IDF of a term is one factor of all its counts, they follow from the sums exactly.
    """
    idf = idf_of(statistics)
    counts = statistics.filter("kind = 'term'").select("label", F.col("key").alias("term"), "n")
    weighed = counts.join(idf, "term").select("label", "term", "idf", (F.col("n") * F.col("idf")).alias("x"))
    size = idf.agg(F.count("*")).scalar()
    mass = weighed.groupBy("label").agg(F.sum("x").alias("mass"))
    classes = statistics.filter("kind = 'class'").select("label", F.col("n").alias("docs"))
    docs, number = classes.agg(F.sum("docs")).scalar(), classes.agg(F.count("*")).scalar()
    prior = F.log(F.col("docs") + F.lit(smoothing)) - F.log(docs + number * F.lit(smoothing))
    whole = F.log(F.coalesce("mass", F.lit(0.0)) + size * F.lit(smoothing))
    priors = classes.join(mass, "label", "left").select(
        "label", prior.alias("prior"), (F.log(F.lit(smoothing)) - whole).alias("unseen"), whole.alias("_whole")
    )
    # A row for each class, so broadcast at any size of the vocabulary.
    terms = weighed.join(F.broadcast(priors.select("label", "_whole")), "label")
    weight = F.log(F.col("x") + F.lit(smoothing)) - F.col("_whole")
    return priors.drop("_whole"), terms.select("label", "term", "idf", weight.alias("weight"))


def predict_bayes(
    posts: DataFrame,
    classes: DataFrame,
    terms: DataFrame,
    key: str = "id",
    words: str = "filtered_words",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(key, prediction_bayes)`` for each post by the tables of :func:`bayes_of`.

    ``posts`` and both tables are stored; ``key`` is unique. Terms that no class has seen say
    nothing; of equally likely labels the smallest is given. Null where there are no classes.
    """
    spark = posts.sparkSession
    labels = [tuple(r) for r in classes.orderBy("label").collect()]
    # Beyond what an unseen term is worth, so that a term has an entry for its own classes only.
    gains = [
        F.coalesce(F.max(F.when(F.col("label") == label, F.col("weight") - unseen)), F.lit(0.0)).alias(f"g{i}")
        for i, (label, _, unseen) in enumerate(labels)
    ]
    if not labels:
        return posts.select(key, F.lit(None).cast("int").alias("prediction_bayes"))
    wide = store(
        terms.groupBy("term").agg(F.first("idf").alias("idf"), *gains), shared_dir(spark, "bayes_terms")
    )
    counts = term_counts(posts.select(key, words), key, words)
    found = lookup_join(counts, wide, "term", broadcast_rows=broadcast_rows)
    x = F.col("tf") * F.col("idf")
    sums = found.groupBy(key).agg(F.sum(x).alias("_x"), *[F.sum(x * F.col(f"g{i}")).alias(f"s{i}") for i in range(len(labels))])
    scored = posts.select(key).join(sums, key, "left").na.fill(0.0)
    score = [
        F.struct(
            # Sums over a post's terms come in any order.
            F.round(F.lit(prior) + F.col("_x") * unseen + F.col(f"s{i}"), 9).alias("p"),
            F.lit(-label).alias("l"),
        )
        for i, (label, prior, unseen) in enumerate(labels)
    ]
    best = F.array_max(F.array(*score))["l"]
    return scored.select(key, (-best).cast("int").alias("prediction_bayes"))


def centres_of_statistics(statistics: DataFrame, start: DataFrame) -> DataFrame:
    """``(cluster, centre)``: the mean of each cluster's points, its ``start`` where it has none."""
    sums = statistics.filter("kind = 'centre'").groupBy(F.col("label").alias("cluster")).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("key").cast("int").alias("dim"), (F.col("total") / F.col("n")).alias("x")))
        ).alias("parts")
    )
    mean = F.transform("parts", lambda p: p["x"])
    return start.join(sums, "cluster", "left").select("cluster", F.coalesce(mean, "centre").alias("centre"))
