"""Stored intermediate tables."""

import os
import shutil
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the machines of the session share.

    ``spark.checkpoint.dir``, else the folder given to ``setCheckpointDir``, else the warehouse. A
    warehouse on the local disk is no folder that machines share, so a cluster must name one.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return warehouse


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below :func:`shared_root`."""
    return f"{shared_root(spark).rstrip('/')}/postflow/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet and read it back, which ends its lineage in a durable table.

    An earlier table at ``path`` is replaced, so a repeated batch leaves one copy.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table that no result reads any more, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def committed(spark: SparkSession, path: str) -> list[str]:
    """The names of the tables in ``path`` whose writing has ended, in ascending order."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    folders = [status.getPath() for status in files.listStatus(where) if status.isDirectory()]
    done = [f.getName() for f in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(done)


def file_system(spark: SparkSession, path: str):
    """The file system of ``path``, and the class of its paths, looked up once for many calls."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    return Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), Path


def listed_from(spark: SparkSession, root: str, levels) -> str:
    """A path from which to list the slices of ``root``: all folders above the last of ``levels``.

    Listed from the root, every folder of many folders would be a job of its own; these are one job.
    An archive without such folders is listed from the root.
    """
    files, Path = file_system(spark, root)
    below = "/".join([root.rstrip("/"), *[f"{level}=*" for level in levels[:-1]]])
    return below if files.globStatus(Path(below)) else root


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as machines that have it mounted see it, or None on any other file system."""
    files, Path = file_system(spark, path)
    if files.getScheme() != "file":
        return None
    return files.makeQualified(Path(path)).toUri().getPath()


def remove_all(spark: SparkSession, paths: list[str]) -> None:
    """:func:`remove` for many files of one file system, several at a time: each one only waits for it."""
    if paths:
        files, Path = file_system(spark, paths[0])
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda path: files.delete(Path(path), True), paths))


def merge_folders(spark: SparkSession, source: str, target: str, last: str) -> None:
    """Move the ``name=value`` folders of ``source`` into ``target``.

    A folder that ``target`` lacks moves as a whole; one that it has is merged, but those of the level
    ``last`` are replaced. Cut short, it can run again.
    """
    local = local_path(spark, target)
    if local is not None:
        _merge_local(local_path(spark, source), local, last)
        return
    files, Path = file_system(spark, target)
    files.mkdirs(Path(target))

    def children(folder, into: str) -> list:
        names = [(status.getPath(), status.getPath().getName()) for status in files.listStatus(folder)]
        return [(path, f"{into}/{name}") for path, name in names if "=" in name]

    def move(pair) -> list:
        folder, into = pair
        there = Path(into)
        if files.exists(there):
            if not folder.getName().startswith(f"{last}="):
                return children(folder, into)
            files.delete(there, True)
        if not files.rename(folder, there):
            raise OSError(f"cannot move {folder} to {into}")
        return []

    with ThreadPoolExecutor(16) as pool:
        pairs = children(Path(source), target.rstrip("/"))
        while pairs:
            pairs = [pair for made in pool.map(move, pairs) for pair in made]


def _merge_local(source: str, target: str, last: str) -> None:
    os.makedirs(target, exist_ok=True)
    for name in sorted(os.listdir(source)):
        if "=" in name:
            folder, there = f"{source}/{name}", f"{target}/{name}"
            if os.path.exists(there) and not name.startswith(f"{last}="):
                _merge_local(folder, there, last)
                continue
            if os.path.exists(there):
                shutil.rmtree(there)
            os.rename(folder, there)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """Settings of the session inside a ``with`` block; those before it come back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def many_files(spark: SparkSession):
    """Settings for listing and reading many small files: many of them to a task, not one or four."""
    tasks = max(8, 2 * spark.sparkContext.defaultParallelism)
    return settings(
        spark,
        {
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": tasks,
            "spark.sql.files.openCostInBytes": 64 * 1024,
        },
    )
