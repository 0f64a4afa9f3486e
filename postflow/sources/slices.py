"""A manifest of time slices: range reads without listing folders, and compaction of small files.

``_manifest/<version>`` below the root of the slices holds a row for each file: where it is, its
slice, rows, bytes and the first and last ``createdAt`` in it. A version counts from when its
writing has ended, and readers take the latest one, so a new version swaps all files of a
compaction at once: whatever is killed, and when, a reader sees the files of the old version or
those of the new one. Files that a compaction has replaced stay listed, as replaced, until
:func:`vacuum` has deleted them, so they are not taken for new ones.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.functions.posts import parse_created_at as parsed_date
from postflow.operators.clean import parse_created_at
from postflow.sources.storage import committed, listed_from, many_files, remove, remove_all, store
from postflow.values import POST_SCHEMA, SLICE_LEVELS

LIVE, REPLACED = "live", "replaced"
FILE_BYTES = 128 * 1024 * 1024
COMPACTED = "_compacted"

_READ = T.StructType(POST_SCHEMA.fields + [T.StructField("batch_id", T.LongType())])


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(v) for v in committed(spark, f"{root}/_manifest"))


def has_manifest(spark: SparkSession, root: str) -> bool:
    return bool(_versions(spark, root))


def _schema(grain: str) -> str:
    levels = ", ".join(f"{level} int" for level in SLICE_LEVELS[grain])
    return f"path string, {levels}, rows long, bytes long, low timestamp, high timestamp, state string"


def read_manifest(spark: SparkSession, root: str, grain: str = "hour") -> DataFrame:
    """The files of the latest version, replaced ones too; without one, no rows."""
    versions = _versions(spark, root)
    if not versions:
        return spark.createDataFrame([], _schema(grain))
    return spark.read.schema(_schema(grain)).parquet(f"{root}/_manifest/{versions[-1]}")


def _commit(spark: SparkSession, root: str, files: DataFrame) -> int:
    """Write the next version. A half-written one of the same number is replaced."""
    versions = _versions(spark, root)
    version = versions[-1] + 1 if versions else 0
    store(files, f"{root}/_manifest/{version}")
    for old in versions[:-1]:
        remove(spark, f"{root}/_manifest/{old}")
    return version


def _raw(spark: SparkSession, paths) -> DataFrame:
    """Rows of files as they are, with the file's path and size."""
    # Without partition discovery: paths of compacted files have folders of their own.
    reader = spark.read.schema(_READ).option("recursiveFileLookup", "true")
    with many_files(spark):
        rows = reader.json(paths)
    return rows.select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_bytes")
    )


def _level(path: Column, level: str) -> Column:
    return F.regexp_extract(path, rf"/{level}=(-?\d+)/", 1).try_cast("int")


def _described(rows: DataFrame, grain: str) -> DataFrame:
    """Manifest rows of the files of :func:`_raw` rows. Only sums by file are shuffled."""
    when = parsed_date(F.col("createdAt"))
    files = rows.groupBy("_path").agg(
        F.count("*").alias("rows"), F.max("_bytes").alias("bytes"), F.min(when).alias("low"), F.max(when).alias("high")
    )
    levels = [_level(F.col("_path"), level).alias(level) for level in SLICE_LEVELS[grain]]
    return files.select(
        F.col("_path").alias("path"), *levels, "rows", "bytes", "low", "high", F.lit(LIVE).alias("state")
    )


def refresh_manifest(spark: SparkSession, root: str, grain: str = "hour") -> int:
    """Take up files that were written since the last version, and forget those that are gone.

    This is the one step that lists the folders; the number of the new version is returned.
    """
    with many_files(spark):
        return _refreshed(spark, root, grain)


def _refreshed(spark: SparkSession, root: str, grain: str) -> int:
    known = read_manifest(spark, root, grain)
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    listed = names.load(listed_from(spark, root, SLICE_LEVELS[grain])).select("path").filter(~F.col("path").contains("/_"))
    ours = F.col("path").contains(f"/{COMPACTED}/")
    gone = known.filter(~ours).select("path").join(listed, "path", "left_anti")
    fresh = listed.join(known.select("path"), "path", "left_anti")
    paths = [r["path"] for r in fresh.collect()]
    kept = known.join(gone, "path", "left_anti")
    new = _described(_raw(spark, paths), grain) if paths else None
    return _commit(spark, root, kept if new is None else kept.unionByName(new))


def _posts_of(spark: SparkSession, paths: list[str], grain: str) -> DataFrame:
    levels = {level: _level(F.col("_path"), level) for level in SLICE_LEVELS[grain]}
    if not paths:
        fields = [T.StructField(level, T.IntegerType()) for level in SLICE_LEVELS[grain]]
        return spark.createDataFrame([], T.StructType(POST_SCHEMA.fields + [T.StructField("batch_id", T.LongType()), *fields]))
    batch = F.coalesce("batch_id", F.regexp_extract("_path", r"/batch_id=(\d+)/", 1).try_cast("long"))
    return _raw(spark, paths).withColumns({"batch_id": batch, **levels}).drop("_path", "_bytes")


def files_between(manifest: DataFrame, start: Column, end: Column) -> DataFrame:
    """The live files that may hold a post from ``start`` to before ``end``."""
    return manifest.filter((F.col("state") == LIVE) & (F.col("high") >= start) & (F.col("low") < end))


def read_range(spark: SparkSession, root: str, start: datetime | str, end: datetime | str, grain: str = "hour") -> DataFrame:
    """Posts from ``start`` to before ``end``, over any borders of hours, days, months and years.

    Only files whose bounds meet the range are opened, and no folder is listed. Times are of the
    session time zone. A post without a date is in no range.
    """
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    chosen = files_between(read_manifest(spark, root, grain), low, high)
    paths = [r["path"] for r in chosen.select("path").collect()]
    posts = parse_created_at(_posts_of(spark, paths, grain))
    return posts.filter((F.col("createdAt") >= low) & (F.col("createdAt") < high))


def read_slices(spark: SparkSession, root: str, grain: str = "hour", **levels) -> DataFrame:
    """``readers.read_time_slice`` by the manifest: the posts of the slices with these levels."""
    unknown = set(levels) - set(SLICE_LEVELS[grain])
    if unknown:
        raise ValueError(f"no such level in {grain} slices: {sorted(unknown)}")
    files = read_manifest(spark, root, grain).filter(F.col("state") == LIVE)
    for level, value in levels.items():
        files = files.filter(F.col(level) == value)
    paths = [r["path"] for r in files.select("path").collect()]
    return parse_created_at(_posts_of(spark, paths, grain))


def pack_files(files: DataFrame, target: int, by: list[str]) -> DataFrame:
    """Add ``bin``: live files below ``target`` bytes, packed in order into bins of about that size.

    Bins keep to one slice, a bin of one file is left out, and so are larger files.
    """
    small = files.filter((F.col("state") == LIVE) & (F.col("bytes") < target))
    before = Window.partitionBy(*by).orderBy("low", "path").rowsBetween(Window.unboundedPreceding, -1)
    packed = small.withColumn(
        "bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(target)).cast("int")
    )
    size = F.count("*").over(Window.partitionBy(*by, "bin"))
    return packed.withColumn("_files", size).filter("_files > 1").drop("_files")


def compact(spark: SparkSession, root: str, grain: str = "hour", target: int = FILE_BYTES, by: str | None = None) -> int | None:
    """Rewrite the small files of each slice as files of about ``target`` bytes.

    ``by`` names a coarser level, so that minutes can become the files of their day; the posts keep
    their time, and the file its first slice's levels down to ``by``. Returns the new version, or
    None where nothing was to be packed. New files lie below ``_compacted``; they count from the
    commit of the version on, and until :func:`vacuum` the old ones stay where they are.
    """
    with many_files(spark):
        return _compacted(spark, root, grain, target, by)


def _compacted(spark: SparkSession, root: str, grain: str, target: int, by: str | None) -> int | None:
    levels = list(SLICE_LEVELS[grain])
    shared = levels[: levels.index(by) + 1] if by else levels
    files = read_manifest(spark, root, grain)
    versions = _versions(spark, root)
    number = versions[-1] + 1 if versions else 0
    folder = f"{root}/{COMPACTED}/{number}"
    packed = store(pack_files(files, target, shared), f"{root}/_packed/{number}")
    paths = [r["path"] for r in packed.select("path").collect()]
    if not paths:
        return None
    bins = packed.select(F.col("path").alias("_path"), *shared, "bin")
    batch = F.coalesce("batch_id", F.regexp_extract("_path", r"/batch_id=(\d+)/", 1).try_cast("long"))
    rows = _raw(spark, paths).withColumn("batch_id", batch).join(bins, "_path").drop("_path", "_bytes")
    # One task for each bin, whose size is the file's.
    spread = rows.repartition(*shared, "bin")
    spread.write.mode("overwrite").partitionBy(*shared, "bin").json(folder)
    made = store(_described(_raw(spark, [folder]), grain), f"{root}/_packed/made-{number}")
    replaced = files.join(packed.select("path", F.lit(True).alias("_packed")), "path", "left")
    state = F.when(F.col("_packed"), REPLACED).otherwise(F.col("state"))
    after = replaced.withColumn("state", state).drop("_packed").unionByName(made)
    version = _commit(spark, root, after)
    remove(spark, f"{root}/_packed")
    return version


def vacuum(spark: SparkSession, root: str, grain: str = "hour") -> int:
    """Delete the files that compactions have replaced; returns how many.

    Call it when no reader of an earlier version is left. Cut short, it can run again: files stay
    listed until all are deleted.
    """
    files = read_manifest(spark, root, grain)
    paths = [r["path"] for r in files.filter(F.col("state") == REPLACED).select("path").collect()]
    remove_all(spark, paths)
    if paths:
        _commit(spark, root, files.filter(F.col("state") != REPLACED))
    return len(paths)
