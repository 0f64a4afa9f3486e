"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import LARGE_LEXICON, LEXICON
from checks.queries import vectors, words_of
from postflow.operators import cluster as K
from postflow.operators import sentiment as S
from postflow.operators import text as W
from postflow.operators.joins import hot_keys
from postflow.plans.curate import clean_posts, curate_posts
from postflow.sources.storage import shared_dir, store
from tests.conftest import SF_DIR, plan_of


@pytest.fixture(scope="module")
def stored(spark, posts):
    return store(posts, shared_dir(spark, "posts"))


def scan_of(plan: str, field: str) -> str:
    return plan.split(f"{field}: ")[1].splitlines()[0]


def test_filters_reach_the_scan(stored):
    plan = plan_of(clean_posts(stored))
    pushed = scan_of(plan, "PushedFilters")
    assert "EqualTo(lang,en)" in pushed
    assert "GreaterThan(retweetedStatus.retweetCount,100)" in pushed
    assert "GreaterThan(retweetedStatus.user.followersCount,100)" in pushed
    assert "IsNotNull(source)" in pushed
    assert "Exchange" not in plan and "Python" not in plan


def test_only_needed_columns_are_read(stored):
    narrow = clean_posts(stored).select("id")
    schema = scan_of(plan_of(narrow), "ReadSchema")
    assert "text" not in schema and "place" not in schema and "favoriteCount" not in schema
    assert "retweetedStatus:struct<retweetCount:bigint,user:struct<followersCount:bigint>>" in schema


def test_curation_shuffles_once_without_the_words(stored):
    plan = plan_of(curate_posts(stored))
    exchanges = [part for part in plan.split("\n\n") if ") Exchange\n" in part]
    assert len(exchanges) == 1
    assert "words" not in exchanges[0] and "hashtags" not in exchanges[0]


@pytest.mark.parametrize(
    "make",
    [
        lambda df: S.post_sentiment(df, LEXICON),
        lambda df: S.label_posts(df, LEXICON),
        lambda df: S.sentence_scores(S.sentences(df), LEXICON),
        lambda df: W.track_filter(df, ["the than"]),
        words_of,
        K.with_part,
    ],
)
def test_row_operators_stay_narrow(stored, make):
    plan = plan_of(make(stored))
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_idf_counts_posts_without_reading_them(stored):
    plan = plan_of(W.idf_weights(words_of(stored)))
    assert "ReadSchema: struct<>" in plan
    assert "partial_count(1)" in plan


def test_lookup_is_broadcast_only_when_small(spark, stored):
    words = words_of(stored).select("id", "filtered_words")
    weights = store(W.idf_weights(words), shared_dir(spark, "idf"))
    assert "BroadcastHashJoin" in plan_of(W.tf_idf(W.term_counts(words), weights))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in off.items():
        spark.conf.set(name, value)
    try:
        plan = plan_of(W.tf_idf(W.term_counts(words), weights, 10))
    finally:
        for name in off:
            spark.conf.unset(name)
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_term_counts_need_no_shuffle(stored):
    plan = plan_of(W.term_counts(words_of(stored)))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_sentences_by_table_move_no_text(spark, stored, broadcast_rows):
    table = store(
        spark.createDataFrame(list(LEXICON.items()), "word string, score double"),
        shared_dir(spark, "lexicon"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = S.sentence_scores_by_table(S.sentences(stored), table, broadcast_rows=broadcast_rows)
        plan = plan_of(scored)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [part for part in plan.split("\n\n") if ") Exchange\n" in part]
    assert exchanges and not any("sentence" in part or "text" in part for part in exchanges)
    assert plan.count("text:string") == 1


def test_hot_keys_read_their_rows_once(spark):
    """rows that come of a long plan are not made a second time for their number."""
    made = spark.sparkContext.accumulator(0)

    def one(i):
        made.add(1)
        return ("hot" if i % 2 else None if i % 4 else f"k{i}", i)

    rows = spark.createDataFrame(spark.sparkContext.range(2000, numSlices=2).map(one), "key string, v long")
    assert hot_keys(rows, "key") == ["hot"]
    assert made.value == 2000
    assert hot_keys(rows.limit(0), "key") == []


def test_hot_keys_alone_are_copied(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key")
    )
    assert hot_keys(rows, "key") == ["hot"]


def test_a_literal_lexicon_is_folded(stored):
    assert "from_json" not in plan_of(S.label_posts(stored, LARGE_LEXICON))


def test_all_models_share_one_pass(spark):
    points = vectors(spark, SF_DIR)
    models = K.kmeans_grid(points, (2, 3))
    plan = plan_of(K.wssse(points, models).filter(F.col("k") > 0))
    assert plan.count("ReadSchema") == 1
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
