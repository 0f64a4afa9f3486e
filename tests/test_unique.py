import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from postflow.sources.storage import shared_dir
from postflow.streaming.windows import unique_within
from tests.conftest import SF_DIR

SCHEMA = "id long, text string, createdAt timestamp"


def arrive(spark, windows, lateness, columns):
    """The rows that come through, window by window, by a job that starts again for each."""
    source, out, checkpoint = (shared_dir(spark, name) for name in ("in", "out", "checkpoint"))
    for rows in windows:
        table = spark.createDataFrame(rows, "id long, text string, at string")
        table.select("id", "text", F.col("at").cast("timestamp").alias("createdAt")).write.mode("append").parquet(source)
        stream = unique_within(spark.readStream.schema(SCHEMA).parquet(source), lateness, columns)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.parquet(out).collect()
    return sorted(((r["id"], r["text"], f"{r['createdAt']:%d %H:%M}") for r in rows), key=str)


def at(hour, minute=0):
    return f"2024-01-01 {hour:02}:{minute:02}:00"


def test_a_copy_two_windows_later_goes_and_one_beyond_lateness_stays(spark):
    windows = [
        [(1, "a", at(1)), (1, "a", at(1)), (2, "b", at(1, 30)), (3, None, at(1, 40))],
        [(4, "c", at(2))],
        [(2, "b", at(2, 10)), (1, "other", at(2, 10)), (3, None, at(2, 20))],
        [(5, "d", at(9))],
        # Known no more: the clock is two hours behind nine.
        [(2, "b", at(9, 10)), (5, "d", at(9, 20))],
    ]
    expected = [
        (1, "a", "01 01:00"), (1, "other", "01 02:10"), (2, "b", "01 01:30"), (2, "b", "01 09:10"),
        (3, None, "01 01:40"), (4, "c", "01 02:00"), (5, "d", "01 09:00"),
    ]
    assert arrive(spark, windows, "2 hours", ("id", "text")) == expected


def test_a_null_is_a_value_of_its_column(spark):
    windows = [[(None, "1", at(1)), (1, None, at(1))], [(None, "1", at(1)), (1, None, at(1))]]
    assert len(arrive(spark, windows, "2 hours", ("id", "text"))) == 2


def test_tables_are_told_apart(spark):
    with pytest.raises(ValueError):
        unique_within(spark.createDataFrame([], SCHEMA), "1 hour", ("id",))


def test_the_query_has_both_kinds_of_copies(spark):
    rows = QUERIES["live_unique"](spark, SF_DIR)
    times = {r["id"]: r["n"] for r in rows.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert set(times.values()) == {1, 2}
