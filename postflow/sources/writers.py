"""Writing posts: JSON text, time slices and analysis stages."""

import os
import shutil
import uuid

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.functions.posts import collected_date, slice_columns
from postflow.sources.storage import local_path, merge_folders, remove, settings
from postflow.values import SLICE_LEVELS

# What a task that writes minutes gets, as shuffled bytes.
MINUTE_BYTES = 1024 * 1024


def collected_record(df: DataFrame) -> DataFrame:
    """Posts with ``createdAt`` as the date text of collected JSON.

    A text that could not be read as a date goes out as it came in; a post has no
    ``_corrupt_record``.
    """
    text = collected_date(F.col("createdAt"))
    if "createdAtText" in df.columns:
        text = F.coalesce(text, F.col("createdAtText"))
    return df.withColumn("createdAt", text).drop("createdAtText", "_corrupt_record")


def posts_to_json(df: DataFrame) -> DataFrame:
    """One ``json`` string per row."""
    record = collected_record(df)
    return record.select(F.to_json(F.struct(*record.columns)).alias("json"))


def slice_levels(grain: str) -> tuple[str, ...]:
    if grain not in SLICE_LEVELS:
        raise ValueError(f"grain must be one of {sorted(SLICE_LEVELS)}, not {grain!r}")
    return SLICE_LEVELS[grain]


def write_time_slices(
    df: DataFrame,
    path: str,
    grain: str = "hour",
    ts: Column | None = None,
    batch_id: int = 0,
    files: int | None = None,
) -> None:
    """Write posts as JSON below ``year=/month=/day=/hour=[/minute=]/batch_id=`` folders.

    Writing one ``batch_id`` again replaces just what it wrote before, so a replayed batch adds
    no duplicates. ``files`` spreads a batch evenly over that many tasks; each has slices that follow
    one another, so that only those at its ends get files of several tasks. By default rows are
    gathered by slice, and adaptive execution cuts a slice too large for one file into several.
    Minutes are many and small, so that making files is their cost: more tasks share them. What is
    written gets to its place at the end, by whole folders where these are new.
    """
    levels = slice_levels(grain)
    when = F.col("createdAt") if ts is None else ts
    sliced = df.select(*df.columns, *slice_columns(when, levels), F.lit(batch_id).alias("batch_id"))
    record = collected_record(sliced) if "createdAt" in df.columns else sliced
    if files:
        hashed = [f.name for f in record.schema if "map<" not in f.dataType.simpleString()]
        spread = record.repartitionByRange(files, *levels, F.xxhash64(*hashed))
    else:
        spread = record.hint("rebalance", *levels)
    spark, folder = df.sparkSession, f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    share = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": MINUTE_BYTES} if grain == "minute" and not files else {}
    local = local_path(spark, folder) if grain == "minute" else None
    try:
        with settings(spark, share):
            if local is None:
                spread.write.partitionBy(*levels, "batch_id").json(folder)
            else:
                _write_small_files(spread, local, [*levels, "batch_id"])
        merge_folders(spark, folder, path, "batch_id")
    finally:
        if local is None:
            remove(spark, folder)
        else:
            shutil.rmtree(local, ignore_errors=True)


def _write_small_files(df: DataFrame, folder: str, levels: list[str]) -> None:
    """What ``df.write.partitionBy(*levels).json(folder)`` writes, on a file system that is mounted.

    There Hadoop starts processes for each folder and file, which take far longer than a small file.
    An attempt of a task writes to a folder of its own, so its files count from when it has ended.
    """
    value = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    slice_ = F.concat_ws("/", *[F.concat(F.lit(f"{name}="), value(name)) for name in levels])
    text = F.to_json(F.struct(*[name for name in df.columns if name not in levels]))
    job = uuid.uuid4()

    def write(batches):
        task = TaskContext.get()
        own, name = f"{folder}/_temporary/{task.taskAttemptId()}", f"part-{task.partitionId():05d}-{job}.json"
        made = set()
        for batch in batches:
            lines: dict[str, list[str]] = {}
            for where, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines.setdefault(where, []).append(line + "\n")
            for where, some in lines.items():
                if where not in made:
                    os.makedirs(f"{own}/{where}")
                    made.add(where)
                with open(f"{own}/{where}/{name}", "a", encoding="utf-8", newline="") as file:
                    file.writelines(some)
        for where in made:
            os.makedirs(f"{folder}/{where}", exist_ok=True)
            os.replace(f"{own}/{where}/{name}", f"{folder}/{where}/{name}")
        yield from ()

    os.makedirs(folder)
    df.select(slice_.alias("slice"), text.alias("line")).mapInArrow(write, "slice string").write.format("noop").mode("overwrite").save()


def write_stage(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    mode: str = "errorifexists",
    files: int | None = None,
) -> None:
    """Save a stage of an analysis as JSON or parquet, in ``files`` files when given."""
    spread = df.repartition(files) if files else df
    spread.write.mode(mode).format(fmt).save(path)
