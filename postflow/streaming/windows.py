"""Event-time windows, and rows that repeat across them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(
    df: DataFrame, length: str, ts: str = "ts", lateness: str | None = None, by=()
) -> DataFrame:
    """Rows per tumbling window of ``length`` (and per ``by`` column), batch or stream.

    ``lateness`` sets a watermark: windows older than that are final and their state is freed. A
    stream needs one, or its state would never end.
    """
    if df.isStreaming and not lateness:
        raise ValueError("window_counts of a stream needs lateness")
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if lateness:
        timed = timed.withWatermark(ts, lateness)
    counts = timed.groupBy(F.window(ts, length).alias("window"), *by).agg(
        F.count("*").alias("count")
    )
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        "count",
    )


def unique_within(stream: DataFrame, lateness: str, columns, ts: str = "createdAt") -> DataFrame:
    """A stream less the rows that repeat an earlier one in ``columns``, whatever window it came in.

    A row is known for ``lateness`` beyond its ``ts``, by the clock of the latest ``ts`` seen; a
    copy that comes later than that is a row of its own. Rows that are late themselves are
    dropped. The state holds two hashes and a time for each known row, never the row, and goes
    with the checkpoint; nulls are equal to nulls. Which of equal rows in one window stays is
    open, so ``columns`` should name all that matters.
    """
    if not stream.isStreaming:
        raise ValueError("unique_within is for streams; a table has dropDuplicates")
    # A hash passes over nulls, so each value goes with whether it is one.
    parts = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    keys = {"_h": F.xxhash64(*parts), "_g": F.xxhash64(F.lit(7), *parts, F.lit(7))}
    timed = stream.withWatermark(ts, lateness).withColumns(keys)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop(*keys)
