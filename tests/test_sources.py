import glob
import json
from datetime import datetime

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postflow.sources import readers, writers
from postflow.sources.storage import remove, shared_dir, store
from postflow.streaming import jobs
from tests.conftest import plan_of


def test_missing_fields_are_null(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "text": "x"}\n')
    row = readers.read_posts_json(spark, str(tmp_path)).first()
    assert row["id"] == 1 and row["retweetedStatus"] is None and row["createdAt"] is None


def test_what_cannot_be_read_is_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"id": 1, "createdAt": "yesterday"}', '{"id": 2, "createdAt": "Jan 12, 2019, 5:03:09\u202fPM"}', '{"id": 3,']
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    read = readers.read_posts_json(spark, str(tmp_path / "in"))
    rows = {r["id"]: r for r in read.collect()}
    assert rows[1]["createdAt"] is None and rows[1]["createdAtText"] == "yesterday"
    assert rows[2]["createdAt"] == datetime(2019, 1, 12, 17, 3, 9)
    assert rows[2]["createdAtText"] is None
    assert rows[None]["_corrupt_record"] == '{"id": 3,'
    jobs.collect_posts(
        readers.stream_posts(spark, str(tmp_path / "in"), None),
        str(tmp_path / "out"),
        str(tmp_path / "c"),
        None,
        "hour",
    ).awaitTermination()
    again = {r["id"]: r for r in readers.read_time_slice(spark, str(tmp_path / "out")).collect()}
    assert set(again) == {1, 2} and again[1]["createdAtText"] == "yesterday"
    lost = spark.read.text(str(tmp_path / "out" / "_corrupt")).collect()
    assert [r["value"] for r in lost] == ['{"id": 3,']


def test_json_text_is_valid(posts):
    row = writers.posts_to_json(posts.filter("id = 5")).first()
    record = json.loads(row["json"])
    assert record["createdAt"] == "Jan 12, 2019 12:03:05 AM"
    assert record["user"]["followersCount"] == 505


def test_slices_prune_and_return_everything(spark, posts, tmp_path):
    path = str(tmp_path / "slices")
    writers.write_time_slices(posts, path, "minute")
    assert readers.read_time_slice(spark, path, "minute").count() == posts.count()
    one = readers.read_time_slice(spark, path, "minute", hour=1, minute=30)
    partitions = plan_of(one).split("PartitionFilters: ")[1].splitlines()[0]
    assert "hour" in partitions and "minute" in partitions
    expected = posts.filter("hour(createdAt) = 1 and minute(createdAt) = 30")
    assert one.count() == expected.count() > 0


def test_rewriting_a_batch_replaces_it_only(spark, posts, tmp_path):
    path = str(tmp_path / "slices")
    writers.write_time_slices(posts, path, "hour", batch_id=1)
    writers.write_time_slices(posts, path, "hour", batch_id=2)
    writers.write_time_slices(posts, path, "hour", batch_id=2)
    assert readers.read_time_slice(spark, path, "hour").count() == 2 * posts.count()


def test_files_per_batch(posts, tmp_path):
    path = str(tmp_path / "slices")
    day = posts.withColumn("createdAt", F.lit("2019-01-12 05:00:00").cast("timestamp"))
    writers.write_time_slices(day, path, "hour", files=3)
    assert len(glob.glob(f"{path}/**/*.json", recursive=True)) == 3
    writers.write_stage(posts, str(tmp_path / "stage"), files=4)
    assert len(glob.glob(f"{tmp_path}/stage/*.json")) == 4


def test_files_of_many_slices_are_not_one_for_each_task_and_slice(posts, tmp_path):
    """the tasks share out the slices, not the rows of each slice; a few rows are shared evenly."""
    path = str(tmp_path / "slices")
    hours = posts.select((F.col("createdAt") + F.expr("make_interval(0, 0, 0, 0, cast(id % 40 as int))")).alias("createdAt"), "id")
    writers.write_time_slices(hours, path, "hour", files=3)
    slices = len(glob.glob(f"{path}/*/*/*/*/batch_id=0"))
    names = [name.rsplit("/", 1)[1] for name in glob.glob(f"{path}/**/*.json", recursive=True)]
    assert slices >= 40 and len(names) <= slices + 2
    assert {name.split("-")[1] for name in names} == {"00000", "00001", "00002"}


def test_unknown_grain_and_level(spark, posts, tmp_path):
    with pytest.raises(ValueError):
        writers.write_time_slices(posts, str(tmp_path / "x"), "day")
    with pytest.raises(ValueError):
        readers.read_time_slice(spark, str(tmp_path), "hour", minute=1)


def test_stage_refuses_to_overwrite(posts, tmp_path):
    path = str(tmp_path / "stage")
    writers.write_stage(posts, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        writers.write_stage(posts, path)


def test_vectors_in_a_json_stage(spark, tmp_path):
    rows = [(1, Vectors.dense([1.0, 2.0])), (2, Vectors.sparse(3, {1: 4.0}))]
    path = str(tmp_path / "vectors")
    writers.write_stage(spark.createDataFrame(rows, ["id", "v"]), path)
    read = spark.read.json(path)
    stored = {r["id"]: r["v"].asDict() for r in read.collect()}
    assert stored[1]["type"] == 1 and stored[1]["values"] == [1.0, 2.0]
    assert stored[2]["type"] == 0 and stored[2]["indices"] == [1] and stored[2]["size"] == 3


def test_a_removed_table_is_gone(spark, posts, tmp_path):
    path = str(tmp_path / "table")
    store(posts.limit(3), path)
    remove(spark, path)
    assert not (tmp_path / "table").exists()


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "a"), shared_dir(spark, "a")
    assert first.startswith(root) and first != second
