"""Filters, projections and cleaning of posts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.functions import posts as P
from postflow.values import DEVICES, MIN_REACH, MIN_REPOSTS, OTHER


def filter_lang(df: DataFrame, lang: str = "en") -> DataFrame:
    return df.filter(F.col("lang") == lang)


def filter_source_present(df: DataFrame) -> DataFrame:
    return df.filter(F.col("source").isNotNull())


def filter_repost_count(df: DataFrame, more_than: int = MIN_REPOSTS) -> DataFrame:
    """Keep reposts of posts shared often; an original post has no repost count and goes."""
    return df.filter(F.col("retweetedStatus.retweetCount") > more_than)


def filter_author_reach(df: DataFrame, more_than: int = MIN_REACH) -> DataFrame:
    """Keep reposts whose original author has many followers."""
    return df.filter(F.col("retweetedStatus.user.followersCount") > more_than)


def filter_devices(df: DataFrame, devices=DEVICES) -> DataFrame:
    """Keep posts written on one of the known devices, which drops bots."""
    return df.filter(P.from_device(F.col("source"), devices))


def with_source_name(df: DataFrame) -> DataFrame:
    return df.withColumn("sourceName", P.source_name(F.col("source")))


def project_posts(df: DataFrame) -> DataFrame:
    """The twelve columns of the file analysis. ``lang`` becomes the author's language."""
    return df.select(
        "createdAt",
        "favoriteCount",
        "retweetCount",
        P.source_name(F.col("source")).alias("sourceName"),
        "id",
        F.col("user.lang").alias("lang"),
        "text",
        F.col("user.location").alias("location"),
        F.col("user.followersCount").alias("followersCount"),
        F.col("retweetedStatus.user.followersCount").alias("retweetedStatus_user_followersCount"),
        F.col("retweetedStatus.favoriteCount").alias("retweetedStatus_favoriteCount"),
        F.col("retweetedStatus.retweetCount").alias("retweetedStatus_retweetCount"),
    )


def flatten_posts(df: DataFrame) -> DataFrame:
    """The flat table of the live analysis; ``source`` becomes the device name."""
    return df.select(
        "id",
        "createdAt",
        "text",
        P.source_name(F.col("source")).alias("source"),
        "lang",
        F.col("user.lang").alias("userLang"),
        P.place_name(F.col("place")).alias("place"),
        "retweetCount",
    )


def project_posts_live(df: DataFrame) -> DataFrame:
    """The six columns the live analysis keeps of :func:`flatten_posts`."""
    return df.select("createdAt", "retweetCount", "source", "id", "userLang", "text")


def fill_missing(
    df: DataFrame, columns=("timeZone", "location", "place"), value: str = OTHER
) -> DataFrame:
    """Fill nulls of the listed string columns; columns the table lacks are skipped."""
    present = [name for name in columns if name in df.columns]
    return df.na.fill(value, subset=present) if present else df


def dedup_posts(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows.

    Call it before adding columns derived from the row: the result is the same and the shuffle
    narrower. Copies are dropped on the map side first, so a post copied a billion times
    reaches the shuffle once per task.
    """
    return df.distinct()


def device_distribution(df: DataFrame, top: int = 15) -> DataFrame:
    """Posts per device name, most used first."""
    return (
        df.groupBy(P.source_name(F.col("source")).alias("sourceName"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "sourceName")
        .limit(top)
    )


def parse_created_at(df: DataFrame, column: str = "createdAt") -> DataFrame:
    """Turn the date text in ``column`` into a timestamp.

    Text that is no date stays, in ``<column>Text``, which is null where the date was read.
    """
    parsed = P.parse_created_at(F.col(column))
    unread = F.when(parsed.isNull(), F.col(column))
    return df.withColumns({column: parsed, f"{column}Text": unread})


def split_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Bucket of a key by a hash every SQL engine has, independent of the data layout."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
