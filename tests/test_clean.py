import datetime

import pytest
from pyspark.sql import functions as F

from postflow.functions import posts as P
from postflow.operators import clean as C
from postflow.plans.curate import curate_posts

SOURCES = [
    ('<a href="x" rel="nofollow">Twitter for iPhone</a>', "Twitter for iPhone"),
    ("plain", "Other"),
    ("", "Other"),
    (None, "Other"),
    ("x>", "Other"),
    ("x><", "Other"),
    ("a>>b", ""),
    ("<a></a>", ""),
    (">n<", "n"),
]


def test_source_name(spark):
    df = spark.createDataFrame(SOURCES, "source string, expected string")
    got = df.select(P.source_name(F.col("source")).alias("got"), "expected").collect()
    assert [row.got for row in got] == [row.expected for row in got]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Jan 12, 2019 5:03:09 PM", datetime.datetime(2019, 1, 12, 17, 3, 9)),
        ("Sat Jan 12 17:03:09 UTC 2019", datetime.datetime(2019, 1, 12, 17, 3, 9)),
        ("Jan 12, 2019 12:00:00 AM", datetime.datetime(2019, 1, 12, 0, 0, 0)),
        ("Jan 12, 2019 late", None),
        ("2019-01-12", None),
        (None, None),
    ],
)
def test_parse_created_at(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(P.parse_created_at(F.col("t")).cast("timestamp_ntz").alias("t")).first()["t"]
    assert got == expected


def test_place_name(spark):
    df = spark.createDataFrame(
        [(("Pune",),), ((None,),), (None,)], "place struct<name: string>"
    )
    got = [row[0] for row in df.select(P.place_name(F.col("place"))).collect()]
    assert got == ["Pune", "Other", "Other"]


def test_fill_skips_absent_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id long, location string")
    assert [tuple(r) for r in C.fill_missing(df).orderBy("id").collect()] == [(1, "Other"), (2, "x")]
    assert C.fill_missing(df, ["timeZone"]).columns == ["id", "location"]


def test_filters_drop_originals(posts):
    originals = posts.filter(F.col("retweetedStatus").isNull())
    assert originals.count() > 0
    assert C.filter_repost_count(originals).isEmpty()
    assert C.filter_author_reach(originals).isEmpty()


def test_devices_are_case_sensitive(spark):
    df = spark.createDataFrame([("Twitter for iPad",), ("twitter for ipad",)], "source string")
    assert C.filter_devices(df).count() == 1


def test_dedup_before_or_after_words_is_the_same(posts):
    twice = curate_posts(posts.unionAll(posts))
    once = curate_posts(posts)
    assert twice.count() == once.count() == 43
    assert twice.distinct().exceptAll(once).isEmpty()
    assert C.dedup_posts(twice).count() == 43


def test_device_distribution_order(spark):
    sources = ["<a>x</a>"] * 3 + ["<a>b</a>"] * 2 + ["<a>a</a>"] * 2 + [None]
    df = spark.createDataFrame([(s,) for s in sources], "source string")
    assert [tuple(r) for r in C.device_distribution(df, 3).collect()] == [
        ("x", 3),
        ("a", 2),
        ("b", 2),
    ]
