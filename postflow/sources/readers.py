"""Reading posts from JSON folders, in batch and as a stream."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.operators.clean import parse_created_at
from postflow.operators.text import track_filter
from postflow.sources.storage import listed_from, many_files
from postflow.values import POST_SCHEMA, SLICE_LEVELS, TRACK_PHRASES


# Holds a line that is no JSON record; all other fields of its row are null.
CORRUPT = "_corrupt_record"
_READ_SCHEMA = T.StructType(POST_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])


def read_posts_json(spark: SparkSession, path: str) -> DataFrame:
    """Posts of a JSON-lines path, with ``createdAt`` as a timestamp.

    The schema is given, never inferred: no pass over the data to find it, and a field no post
    has is null rather than missing. What can't be read is kept: a malformed line in
    ``_corrupt_record``, a date of another form in ``createdAtText``.
    """
    raw = spark.read.schema(_READ_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return parse_created_at(raw)


def sliced_schema(grain: str) -> T.StructType:
    levels = [T.StructField(level, T.IntegerType()) for level in SLICE_LEVELS[grain]]
    return T.StructType(POST_SCHEMA.fields + levels + [T.StructField("batch_id", T.LongType())])


def read_time_slice(spark: SparkSession, root: str, grain: str = "hour", **levels) -> DataFrame:
    """Posts of the slices below ``root`` that agree with ``year=``, ``month=``, ... ``minute=``.

    The levels are folders, so only matching folders are listed and read.
    """
    unknown = set(levels) - set(SLICE_LEVELS[grain])
    if unknown:
        raise ValueError(f"no such level in {grain} slices: {sorted(unknown)}")
    with many_files(spark):
        below = listed_from(spark, root, SLICE_LEVELS[grain])
        raw = spark.read.schema(sliced_schema(grain)).option("basePath", root).json(below)
    if levels:
        raw = raw.filter(reduce(and_, [F.col(name) == value for name, value in levels.items()]))
    return parse_created_at(raw)


def stream_posts(
    spark: SparkSession,
    path: str,
    phrases=TRACK_PHRASES,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the posts arriving as JSON files in ``path`` that match a tracked phrase.

    ``phrases=None`` streams every post, and malformed lines as :func:`read_posts_json` has them.
    """
    reader = spark.readStream.schema(_READ_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.json(path)
    posts = parse_created_at(raw)
    return posts if phrases is None else track_filter(posts, phrases)
