from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.fixtures import posts as made_posts
from postflow.sources import slices as Z
from postflow.sources import readers, writers
from postflow.sources.storage import shared_dir
from tests.conftest import SF_DIR


def archive(spark, start="2019-12-31 22:30:00", step=60, grain="minute", batches=2):
    """Posts of one minute after the other, across a year's end, in files of one slice each."""
    root = shared_dir(spark, "slices")
    rows = made_posts(spark, SF_DIR).withColumn(
        "createdAt", F.lit(start).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * step)
    )
    for b in range(batches):
        writers.write_time_slices(rows.filter(F.col("id") % batches == b), root, grain, batch_id=b)
    return root, {r["id"]: r["createdAt"] for r in rows.select("id", "createdAt").collect()}


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.fixture(scope="module")
def minutes(spark):
    root, times = archive(spark)
    Z.refresh_manifest(spark, root, "minute")
    return root, times


def test_ranges_across_a_years_end(spark, minutes):
    root, times = minutes
    start, end = datetime(2019, 12, 31, 23, 50), datetime(2020, 1, 1, 0, 10, 30)
    got = Z.read_range(spark, root, start, end, "minute")
    assert ids(got) == sorted(i for i, t in times.items() if start <= t < end)
    assert {r["year"] for r in got.select("year").distinct().collect()} == {2019, 2020}
    # Only files of those minutes are opened.
    opened = {f.rsplit("/batch_id", 1)[0] for f in got.inputFiles()}
    assert len(opened) == 21
    assert ids(Z.read_range(spark, root, "2018-01-01", "2018-02-01", "minute")) == []
    assert ids(Z.read_range(spark, root, "2000-01-01", "2030-01-01", "minute")) == sorted(times)


def test_slices_by_level(spark, minutes):
    root, times = minutes
    got = Z.read_slices(spark, root, "minute", year=2020, hour=0)
    assert ids(got) == sorted(i for i, t in times.items() if (t.year, t.hour) == (2020, 0))
    assert {r["batch_id"] for r in got.select("batch_id").distinct().collect()} == {0, 1}
    with pytest.raises(ValueError):
        Z.read_slices(spark, root, "minute", week=1)


def whole(spark, root, times, grain="minute"):
    rows = Z.read_slices(spark, root, grain).select("id", "createdAt", "batch_id").collect()
    assert sorted((r["id"], r["createdAt"], r["batch_id"]) for r in rows) == sorted((i, t, i % 2) for i, t in times.items())


def test_minutes_become_files_of_a_size(spark):
    root, times = archive(spark)
    Z.refresh_manifest(spark, root, "minute")
    before = Z.read_manifest(spark, root, "minute").filter("state = 'live'")
    target = before.agg(F.sum("bytes")).first()[0] // 6
    assert Z.compact(spark, root, "minute", target, by="day") is not None
    after = Z.read_manifest(spark, root, "minute").filter("state = 'live'").collect()
    assert len(after) <= 9 and all(r["bytes"] < 1.5 * target for r in after)
    whole(spark, root, times)
    assert ids(Z.read_range(spark, root, "2020-01-01 00:00:00", "2020-01-01 00:05:00", "minute")) == sorted(
        i for i, t in times.items() if datetime(2020, 1, 1) <= t < datetime(2020, 1, 1) + timedelta(minutes=5)
    )
    # What was replaced is not taken for new, is deleted once, and nothing is left to pack.
    Z.refresh_manifest(spark, root, "minute")
    whole(spark, root, times)
    assert Z.vacuum(spark, root, "minute") == len(times) and Z.vacuum(spark, root, "minute") == 0
    whole(spark, root, times)
    Z.refresh_manifest(spark, root, "minute")
    whole(spark, root, times)
    assert Z.compact(spark, root, "minute", 1) is None


@pytest.mark.parametrize("killed", ["_described", "_commit", "remove"])
def test_killed_at_each_step(spark, monkeypatch, killed):
    root, times = archive(spark, step=600)
    Z.refresh_manifest(spark, root, "minute")
    calls = []

    def stop(*args):
        calls.append(args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Z, killed, stop)
        with pytest.raises(KeyboardInterrupt):
            Z.compact(spark, root, "minute", 10**9, by="day")
    assert calls
    whole(spark, root, times)
    Z.compact(spark, root, "minute", 10**9, by="day")
    whole(spark, root, times)
    with monkeypatch.context() as patch:
        patch.setattr(Z, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            Z.vacuum(spark, root, "minute")
    whole(spark, root, times)
    Z.vacuum(spark, root, "minute")
    whole(spark, root, times)


def test_files_of_a_batch_that_ran_again(spark):
    root, times = archive(spark, step=600)
    Z.refresh_manifest(spark, root, "minute")
    rows = made_posts(spark, SF_DIR).filter("id % 2 = 0").withColumn(
        "createdAt", F.lit("2019-12-31 22:30:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 600)
    )
    writers.write_time_slices(rows, root, "minute", batch_id=0)
    Z.refresh_manifest(spark, root, "minute")
    whole(spark, root, times)
    none = shared_dir(spark, "none")
    assert not Z.has_manifest(spark, none) and Z.read_slices(spark, none).count() == 0


def test_minutes_are_shared_by_tasks(spark, tmp_path, monkeypatch):
    """What is small in bytes but many files is not left to one task; the setting comes back."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    monkeypatch.setattr(writers, "MINUTE_BYTES", 20_000)
    rows = spark.range(4000).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.timestamp_seconds(F.col("id") * 30).alias("createdAt")
    )
    writers.write_time_slices(rows, str(tmp_path / "slices"), "minute")
    assert spark.conf.get(name) == before
    tasks = {f.name.split("-")[1] for f in (tmp_path / "slices").rglob("part-*.json")}
    assert len(tasks) > 2
    assert spark.read.json(str(tmp_path / "slices")).count() == 4000


def test_many_files_share_a_task(spark, tmp_path):
    from postflow.sources.storage import many_files

    rows = spark.range(600).select(F.col("id"), F.lit("a").alias("text"))
    rows.repartition(600).write.json(str(tmp_path / "files"))
    with many_files(spark):
        assert spark.read.schema("id long").json(str(tmp_path / "files")).rdd.getNumPartitions() <= 12
    assert spark.read.schema("id long").json(str(tmp_path / "files")).count() == 600


def test_small_files_hold_what_the_json_writer_writes(spark, tmp_path):
    """minutes of a mounted file system are written without Hadoop, in one move for new hours."""
    from pathlib import Path

    rows = made_posts(spark, SF_DIR).withColumn("createdAt", F.when(F.col("id") % 9 > 0, F.col("createdAt")))
    root = tmp_path / "slices"
    writers.write_time_slices(rows.filter("id % 2 = 0"), str(root), "minute", batch_id=0)
    writers.write_time_slices(rows, str(root), "minute", batch_id=1)
    writers.write_time_slices(rows, str(root), "minute", batch_id=1)
    writers.write_time_slices(rows.limit(0), str(root), "minute", batch_id=2)
    read = lambda batch: sorted(line for f in root.rglob(f"batch_id={batch}/part-*.json") for line in Path(f).read_text(encoding="utf-8").split("\n") if line)
    sliced = writers.collected_record(rows)
    sliced.write.json(str(tmp_path / "plain"))
    plain = sorted(line for f in (tmp_path / "plain").glob("part-*.json") for line in f.read_text(encoding="utf-8").split("\n") if line)
    assert read(1) == plain and len(read(0)) == rows.filter("id % 2 = 0").count() and read(2) == []
    folders = {f.parent.parent.name for f in root.rglob("batch_id=1/part-*.json")}
    assert "minute=__HIVE_DEFAULT_PARTITION__" in folders and len(folders) > 30
    assert not [f for f in root.iterdir() if "=" not in f.name] and not list(root.rglob("*.crc"))
    whole_ = readers.read_time_slice(spark, str(root), "minute")
    assert whole_.filter("batch_id = 1").count() == rows.count()
    assert whole_.filter("minute is null and batch_id = 1").count() == rows.filter("createdAt is null").count()


def test_a_failed_write_of_minutes_leaves_nothing(spark, tmp_path):
    fail = F.udf(lambda i: 1 // (i - 3), "long")
    rows = spark.range(10).select(fail("id").alias("id"), F.timestamp_seconds(F.col("id") * 600).alias("createdAt"))
    with pytest.raises(Exception):
        writers.write_time_slices(rows, str(tmp_path / "slices"), "minute")
    assert not list((tmp_path / "slices").rglob("*.json"))


def test_folders_are_merged_by_hadoop_alike(spark, tmp_path, monkeypatch):
    from postflow.sources import storage

    monkeypatch.setattr(storage, "local_path", lambda *_: None)
    for name, text in (("a/h=1/m=1/b=0/x", "old"), ("s/h=1/m=1/b=0/y", "new"), ("s/h=1/m=2/b=0/z", "z"), ("s/h=2/m=1/b=0/u", "u"), ("s/_SUCCESS", "")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    storage.merge_folders(spark, str(tmp_path / "s"), str(tmp_path / "a"), "b")
    found = {str(f.relative_to(tmp_path / "a")) for f in (tmp_path / "a").rglob("*") if f.is_file() and f.suffix != ".crc"}
    assert found == {"h=1/m=1/b=0/y", "h=1/m=2/b=0/z", "h=2/m=1/b=0/u"}
