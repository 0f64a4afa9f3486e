"""Row identity, stored tables and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.sources.storage import shared_dir, store

# Rows of an Arrow batch: documents are long, so batches stay at some megabytes.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again, which ends its lineage."""
    return store(df, shared_dir(df.sparkSession, name))


def by_position(docs: DataFrame, known: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``docs`` with the columns other than ``known`` ones named by position.

    No name a caller gives to an extra column can then meet a name used inside an operator;
    ``toDF(*docs.columns)`` gives the old names back.
    """
    names = [name if name in known else f"column {i}" for i, name in enumerate(docs.columns)]
    return docs.toDF(*names)


def text_id(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(
        F.xxhash64(whole).alias("h"), F.xxhash64(F.lit(7), whole, F.lit(7)).alias("g")
    )


def join_null_safe(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """An equi-join in which null keys meet; the keys come from ``left``."""
    renamed = right
    match = F.lit(True)
    for key in on:
        renamed = renamed.withColumnRenamed(key, f"right {key}")
    for key in on:
        match = match & F.col(key).eqNullSafe(F.col(f"right {key}"))
    joined = left.join(renamed, match, how)
    return joined.drop(*[f"right {key}" for key in on])


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)``: the smallest node of the component of each node of ``edges (a, b)``.

    Alternates the two star operations of Kiveris et al., "Connected components in MapReduce and
    beyond": every node hangs its larger neighbours, then its smaller ones, below the smallest.
    The edges never grow in number, and each round is a stored table, so neither the driver nor
    one task holds a component, and a lost executor costs at most the round under way.
    """

    def stored(df: DataFrame) -> DataFrame:
        return keep_table(df.filter(F.col("a") > F.col("b")).distinct(), name)

    def signature(df: DataFrame):
        # Exact: the sum of hashes as decimals can't overflow.
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return tuple(df.agg(F.count("*"), total).first())

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    seen = signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        up = both.join(least, "a").filter(F.col("b") > F.col("a"))
        edges = stored(up.select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        down = edges.join(least, "a")
        edges = stored(
            down.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b"))
            )
        )
        now = signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    top = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(top)
