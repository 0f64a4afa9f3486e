"""Filter interaction audit: what each filter removes, in every order of the filters.

A document is a mask of the filters it fails. In a given order it goes at the first filter of its
mask, so of all orders those that remove a mask at step s begin with s - 1 filters it passes and
one it fails. Orders with a common beginning have consecutive Lehmer ranks: each such beginning
is an interval of the lexicographic ranks. So the rows of a part are counted once by mask, each
count is added where the mask's intervals begin and taken off where they end, and a prefix sum
over the ranks gives the rows removed at each step of each order. No document is looked at again
for another order.
"""

from __future__ import annotations

from collections import Counter
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm.common import keep_table, text_id
from postflow.llm.quality_rules import CAPITALS, WORD, count_of, let

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 2
SYMBOL = r"[#$%&*|]"
COUNTS = ("n", "good", "toxic")


def lehmer_rank(beginning: tuple[int, ...], n: int) -> int:
    """Lexicographic rank of the first permutation of ``range(n)`` with this beginning."""
    left = list(range(n))
    rank = 0
    for i, x in enumerate(beginning):
        rank += left.index(x) * factorial(n - 1 - i)
        left.remove(x)
    return rank


def mask_ends(n: int) -> list[tuple[int, int, int, int]]:
    """``(mask, step, rank, change)``: the ends of the rank intervals of each mask's removal.

    The interval of a beginning of s filters holds (n - s)! ranks; ends at which one interval
    meets the next of the same step cancel out.
    """
    ends: Counter = Counter()
    for mask in range(1, 1 << n):
        fails = [i for i in range(n) if mask >> i & 1]
        passes = [i for i in range(n) if not mask >> i & 1]
        for step in range(1, len(passes) + 2):
            for before in permutations(passes, step - 1):
                for last in fails:
                    low = lehmer_rank((*before, last), n)
                    ends[mask, step, low] += 1
                    ends[mask, step, low + factorial(n - step)] -= 1
    return [(*key, change) for key, change in sorted(ends.items()) if change and key[2] < factorial(n)]


def removals(masks: DataFrame, n: int) -> DataFrame:
    """``(part, rank, step, n, good, toxic)``: rows removed at each step of each order.

    ``masks`` has a row for each part and mask, with the columns ``n``, ``good`` and ``toxic``.
    Every rank and step has a row, zeros included.
    """
    spark = masks.sparkSession
    ends = spark.createDataFrame(mask_ends(n), "mask int, step int, rank int, change long")
    # The table of ends depends on the number of filters only.
    changes = masks.join(F.broadcast(ends), "mask").select(
        "part", "step", "rank", *[(F.col(c) * F.col("change")).alias(c) for c in COUNTS]
    )
    ranks = F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))).alias("rank")
    steps = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")
    grid = masks.select("part").distinct().select("part", steps).select("part", "step", ranks)
    grid = grid.select("*", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    deltas = changes.unionByName(grid).groupBy("part", "step", "rank")
    deltas = deltas.agg(*[F.sum(c).alias(c) for c in COUNTS])
    up_to = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return deltas.select("part", "rank", "step", *[F.sum(c).over(up_to).alias(c) for c in COUNTS])


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of counts by part and mask, as :func:`audit_filters` returns it.

    Bit i of a mask stands for letter i of ``filters``, which are in ascending order. The result
    has a row for each part, order and step, so n! * n rows for each part: meant for a handful of
    filters.
    """
    n = len(filters)
    spark = masks.sparkSession
    orders = spark.createDataFrame(
        [(rank, "".join(order)) for rank, order in enumerate(permutations(filters))],
        "rank int, filter_order string",
    )
    removed = removals(masks, n).join(F.broadcast(orders), "rank")
    removed = removed.withColumn("letter", F.expr("substring(filter_order, step, 1)"))

    bits = [(mask, filters[i], mask == 1 << i) for mask in range(1 << n) for i in range(n) if mask >> i & 1]
    failing = masks.join(
        F.broadcast(spark.createDataFrame(bits, "mask int, letter string, only boolean")), "mask"
    )
    failing = failing.groupBy("part", "letter").agg(
        F.sum("n").alias("fails"), F.sum(F.when(F.col("only"), F.col("n")).otherwise(0)).alias("unique")
    )
    totals = masks.groupBy("part").agg(F.sum("n").alias("total"))
    one = removed.join(totals, "part").join(failing, ["part", "letter"], "left")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return one.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.coalesce("fails", F.lit(0)) - F.col("n")).alias("redundant"),
        F.coalesce("unique", F.lit(0)).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"),
    )


def text_mask(text: Column) -> Column:
    """The failures that a text shows by itself: A too few words, B too few distinct ones, C too
    many capitals, D a symbol; bits 0 to 3."""

    def words(w: Column, t: Column) -> Column:
        n = F.size(w)
        fails = (
            n < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT_PERCENT * n,
            100 * count_of(t, CAPITALS) > MOST_CAPITAL_PERCENT * F.length(t),
            t.rlike(SYMBOL),
        )
        mask = F.lit(0)
        for bit, fail in enumerate(fails):
            mask = mask + F.when(fail, 1 << bit).otherwise(0)
        return mask

    whole = F.coalesce(text, F.lit(""))
    return let(whole, lambda t: let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: words(w, t)))


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)`` of ``docs``: counts of the masks of each source.

    E fails where a document of smaller id has the same text (by a 128-bit hash), whatever else
    happens to that document. A null id is smaller than none and larger than none, so it never
    fails E. A document counts as good or toxic if any label row of its id says so.
    """
    part = F.coalesce("source", F.lit("")).alias("part")
    slim = docs.select("doc_id", part, text_id(F.col("text")).alias("i"), text_mask(F.col("text")).alias("mask"))
    slim = keep_table(slim.select("doc_id", "part", "i.h", "i.g", "mask"), "masks")
    first = slim.groupBy("h", "g").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
    first = first.withColumn("first", F.lit(True))
    # By id and text, so a text with many copies is not one key.
    slim = slim.join(first, ["doc_id", "h", "g"], "left")
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = (F.col("mask") + F.when(repeats, 1 << 4).otherwise(0)).alias("mask")

    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    )
    known = slim.filter("doc_id is not null").select("doc_id", "part", mask).join(marks, "doc_id", "left")
    unknown = slim.filter("doc_id is null").select("doc_id", "part", mask)
    rows = known.unionByName(unknown, allowMissingColumns=True)
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``docs``: a row for each source, order of the filters and step.

    ``part`` is the source (null: the empty string), ``filter_order`` one of the 120 orders and
    ``step`` 1 to 5; the step's filter is that letter of the order. Counts of documents of the
    part: ``kept`` after the step, ``removed`` by it, ``redundant`` failing its filter but removed
    before, ``unique_fails`` failing its filter only, ``good_lost`` and ``toxic_lost`` among the
    removed, and ``shapley``, the filter's removed in all orders together.

    Null texts count as empty: they fail A only, and E as copies of one another. Rows that repeat
    id and text count each. An empty table gives no rows. Other columns are not looked at.
    """
    return audit(keep_table(document_masks(docs, labels), "mask_counts"))
