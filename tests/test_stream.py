import os

import pytest
from pyspark.sql import functions as F

from checks.fixtures import LEXICON, table
from postflow.operators import cluster as K
from postflow.operators.clean import flatten_posts
from postflow.plans.analyse import analyse_posts, classify_posts, score_posts
from postflow.plans.curate import clean_live, clean_posts
from postflow.sources import readers
from postflow.sources.writers import collected_record
from postflow.streaming import jobs
from postflow.streaming.windows import window_counts
from tests.conftest import SF_DIR


def test_collect_restarts_without_duplicates(spark, posts, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    stream = lambda: readers.stream_posts(spark, source, None, files_per_batch=1)
    first, second = posts.filter("id < 90"), posts.filter("id >= 90")
    collected_record(first).coalesce(1).write.json(source)
    jobs.collect_posts(stream(), out, checkpoint, None, "minute").awaitTermination()
    assert readers.read_time_slice(spark, out, "minute").count() == first.count()
    collected_record(second).coalesce(1).write.mode("append").json(source)
    for _ in range(2):
        jobs.collect_posts(stream(), out, checkpoint, None, "minute").awaitTermination()
    got = readers.read_time_slice(spark, out, "minute")
    assert got.count() == posts.count() == got.select("id").distinct().count()


def test_a_replayed_batch_leaves_one_copy(spark, posts, tmp_path):
    """The last batch runs again when its commit is lost."""
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    collected_record(posts).repartition(2).write.json(source)
    run = lambda: jobs.collect_posts(
        readers.stream_posts(spark, source, None, files_per_batch=1), out, checkpoint, None, "hour"
    ).awaitTermination()
    run()
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert readers.read_time_slice(spark, out, "hour").count() == posts.count()


def test_empty_windows_are_skipped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("")
    seen = []
    stream = readers.stream_posts(spark, str(source), None)
    jobs.run_batches(
        stream, lambda batch, i: seen.append(i), str(tmp_path / "c"), None
    ).awaitTermination()
    assert seen == []


def test_an_interval_triggers_by_time(spark, posts, tmp_path):
    source = str(tmp_path / "in")
    collected_record(posts).coalesce(1).write.json(source)
    job = jobs.collect_posts(
        readers.stream_posts(spark, source, None),
        str(tmp_path / "out"),
        str(tmp_path / "c"),
        "1 second",
    )
    try:
        job.processAllAvailable()
    finally:
        job.stop()
    assert readers.read_time_slice(spark, str(tmp_path / "out"), "minute").count() == posts.count()


def windows(spark, source, lateness, out, checkpoint):
    """Closed windows only, in append mode."""
    stream = spark.readStream.schema("ts timestamp, n int").option("maxFilesPerTrigger", 1).json(source)
    counts = window_counts(stream, "10 minutes", lateness=lateness)
    (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    rows = spark.read.schema(counts.schema).parquet(out).collect()
    return {r["window_start"].strftime("%H:%M"): r["count"] for r in rows}


def test_late_posts_count_until_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    slices = [
        ["10:01", "10:02", "10:15"],
        ["10:03", "10:31"],  # 10:03 is late but within half an hour
        ["10:04", "11:30"],  # still open: the watermark stands at 10:01
        ["11:31"],
        ["10:05", "11:32"],  # dropped: the watermark stands at 11:00, its window is out
    ]
    for i, times in enumerate(slices):
        path = source / f"{i}.json"
        path.write_text("".join(f'{{"ts": "2019-01-12T{t}:00Z", "n": 1}}\n' for t in times))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    got = windows(
        spark, str(source), "30 minutes", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    )
    assert got == {"10:00": 4, "10:10": 1, "10:30": 1}


def test_stream_counts_equal_batch_counts(spark):
    events = table(spark, SF_DIR, "events")
    hourly = window_counts(events, "1 hour")
    assert hourly.agg(F.sum("count")).first()[0] == events.count()


@pytest.fixture(scope="module")
def analysis(spark, posts, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("analysis"))
    return analyse_posts(clean_posts(posts), out, LEXICON, grid=(3, 5)), out


def test_analysis_stages(spark, analysis, posts):
    done, out = analysis
    assert done.features.count() == 43
    train, test = K.split_train_test(done.features)
    assert done.clusters.k in (3, 5)
    assert done.clusters.predictions.count() == done.classes.predictions.count() == test.count()
    assert done.classes.labelled.count() == train.count()
    assert done.clusters.sizes.agg(F.sum("count")).first()[0] == test.count()
    assert done.clusters.centres.count() == done.clusters.k
    for stage in ("features", "clusters", "labelled", "classes"):
        assert not spark.read.parquet(f"{out}/{stage}").isEmpty()


def test_a_saved_model_scores_like_the_analysis(spark, analysis, posts, tmp_path):
    from pyspark.ml import PipelineModel

    done, _ = analysis
    done.model.write().overwrite().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    scored = score_posts(model, clean_posts(posts))
    columns = ["id", "prediction_bayes"]
    expected = done.classes.predictions.select(columns)
    assert expected.exceptAll(scored.select(columns)).isEmpty()
    columns = ["id", "prediction"]
    assert done.clusters.predictions.select(columns).exceptAll(scored.select(columns)).isEmpty()


def test_live_scoring_with_a_model(spark, analysis, posts, tmp_path):
    done, _ = analysis
    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    collected_record(posts).repartition(4).write.json(source)
    stream = readers.stream_posts(spark, source, None, files_per_batch=2)
    jobs.analyse_live(
        stream, out, str(tmp_path / "c"), None, LEXICON, model=done.model
    ).awaitTermination()
    scored = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*/scored")
    expected = clean_live(flatten_posts(posts))
    assert scored.count() == expected.count()
    assert scored.select("batch_id").distinct().count() > 1


def test_an_empty_test_part_can_be_refit(spark, analysis, tmp_path):
    done, _ = analysis
    classes = classify_posts(
        done.features.select("id", "text", "filtered_words"),
        done.features.select("id", "text", "filtered_words").limit(0),
        str(tmp_path / "out"),
        LEXICON,
        refit=True,
    )
    assert classes.predictions.isEmpty() and classes.labelled.count() == done.features.count()


def test_a_stream_of_windows_needs_lateness(spark, tmp_path):
    stream = spark.readStream.schema("ts timestamp").json(str(tmp_path))
    with pytest.raises(ValueError):
        window_counts(stream, "1 hour")


def test_each_batch_is_read_once(spark, posts, tmp_path):
    source = str(tmp_path / "in")
    collected_record(posts).coalesce(1).write.json(source)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stream = readers.stream_posts(spark, source, None).select("id").mapInArrow(counted, "id long")
    jobs.run_batches(
        stream, lambda batch, i: batch.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "c"), None
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == posts.count()
    assert seen.value <= posts.count()


def test_nothing_to_learn_from(spark, posts, tmp_path):
    none = clean_posts(posts.filter("lang = 'xx'"))
    assert analyse_posts(none, str(tmp_path / "out"), LEXICON, grid=(2,)) is None
