import math
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postflow.functions import text as X
from postflow.operators import joins
from postflow.operators import text as W
from postflow.sources.storage import shared_dir, store


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "text string").select(expr(F.col("text"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        (" Hello  World ", ["", "hello", "", "world"]),
        ("a\tb\nc", ["a", "b", "c"]),
        ("a\x0bb\x0c", ["a", "b"]),
        ("", [""]),
        ("   ", []),
        (None, []),
    ],
)
def test_tokens(spark, text, expected):
    assert one(spark, text, X.tokens) == expected


def test_tokens_and_stop_words_as_in_ml(spark, posts):
    ours = posts.transform(W.tokenize).transform(W.remove_stop_words)
    theirs = Tokenizer(inputCol="text", outputCol="words").transform(posts)
    theirs = StopWordsRemover(inputCol="words", outputCol="filtered_words").transform(theirs)
    columns = ["id", "words", "filtered_words"]
    assert ours.select(columns).exceptAll(theirs.select(columns)).isEmpty()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("#a b #C #a #d! x#y", ["#a", "#C", "#a", "#d!"]),
        ("none", []),
        (None, None),
    ],
)
def test_hashtags(spark, text, expected):
    assert one(spark, text, X.hashtags) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("India votes: ELECTION 2019!", True),
        ("election in india", False),
        ("#bjp wins", True),
        ("@BJP, again", True),
        ("bjparty", False),
        ("the lok and the sabha", True),
        ("", False),
        (None, False),
    ],
)
def test_track(spark, text, expected):
    phrases = ["election 2019 india", "BJP", "lok sabha"]
    assert one(spark, text, lambda c: X.matches_phrase(c, phrases)) is expected


def test_track_many_phrases(spark):
    phrases = [f"left{i} right{i}" for i in range(3000)]
    df = spark.createDataFrame(
        [("right2999 x left2999",), ("left1 right2",)], "text string"
    )
    assert W.track_filter(df, phrases).count() == 1


@pytest.mark.parametrize("phrases", [[], [" "], ["good", "!?"]])
def test_track_needs_terms(posts, phrases):
    with pytest.raises(ValueError):
        W.track_filter(posts, phrases)


@pytest.mark.parametrize(
    "phrase, text, expected",
    [
        ("#Tag", "see #tag!", True),
        ("#Tag", "see tag", False),
        ("tag", "see #tag", True),
        ("@bob", "hi @Bob,", True),
        ("@bob", "hi bob", False),
        ("@bob", "hi #bob", False),
        ("e-mail", "an E-Mail", True),
        ("e-mail", "an email", False),
        ("U.S.", "in the U.S. today", True),
        ("don't", "I DON'T", True),
    ],
)
def test_track_punctuation(spark, phrase, text, expected):
    assert one(spark, text, lambda c: X.matches_phrase(c, [phrase])) is expected


def test_stop_words_of_other_languages(spark):
    df = spark.createDataFrame([(["Der", "hund", "und"],)], "words array<string>")
    assert W.remove_stop_words(df, "german").first()["filtered_words"] == ["hund"]
    assert W.remove_stop_words(df, words=["HUND"]).first()["filtered_words"] == ["Der", "und"]


def test_tokenize_by_pattern(spark):
    df = spark.createDataFrame([("A-b--c",), (None,)], "text string")
    assert [r["words"] for r in W.tokenize(df, "-").collect()] == [["a", "b", "c"], []]


def words_by_id(spark):
    rows = [(1, ["a", "b", "a", ""]), (2, ["a"]), (3, ["c", "a"]), (4, [])]
    return spark.createDataFrame(rows, "id long, filtered_words array<string>")


def test_idf_and_tf_idf(spark):
    df = words_by_id(spark)
    weights = {r["term"]: r["idf"] for r in W.idf_weights(df).collect()}
    assert weights == pytest.approx(
        {"a": math.log(5 / 4), "b": math.log(5 / 2), "c": math.log(5 / 2)}
    )
    again = W.idf_weights(df, counts=W.term_counts(df))
    assert again.exceptAll(W.idf_weights(df)).isEmpty()
    stored = store(again, shared_dir(spark, "idf"))
    for rows in (1000, 0):
        got = {(r["id"], r["term"]): r["tf_idf"] for r in W.tf_idf(W.term_counts(df), stored, rows).collect()}
        assert got == pytest.approx(
            {
                (1, "a"): 2 * weights["a"],
                (1, "b"): weights["b"],
                (2, "a"): weights["a"],
                (3, "c"): weights["c"],
                (3, "a"): weights["a"],
            }
        )


def test_exact_counts_agree_with_the_idf_stage(spark, posts):
    words = posts.transform(W.tokenize).transform(W.remove_stop_words)
    vocabulary = [r["term"] for r in W.idf_weights(words).orderBy(F.desc("df"), "term").limit(30).collect()]
    counted = W.counted_features(words, vocabulary)
    model = W.fit_idf(counted)
    exact = {r["term"]: r["idf"] for r in W.idf_weights(words).collect()}
    assert list(model.idf.toArray()) == pytest.approx([exact[t] for t in vocabulary])


def test_hashing_tf_keeps_the_number_of_words(posts):
    words = posts.transform(W.tokenize).transform(W.remove_stop_words)
    hashed = W.hashing_tf(words, 20).select(
        F.size("filtered_words").alias("n"),
        F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, b: a + b).alias("sum"),
    )
    assert hashed.filter("n <> sum").isEmpty()


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_lookup_join_with_a_hot_key(spark, broadcast_rows):
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    table = spark.createDataFrame(
        [("hot", 1.0)] + [(f"k{i}", 2.0) for i in range(40)], "key string, value double"
    )
    joined = joins.lookup_join(rows, table, "key", "left", broadcast_rows)
    assert joined.count() == 9000
    counts = Counter(r["value"] for r in joined.collect())
    assert counts[1.0] == 3000
    assert counts[2.0] + counts[None] == 6000
    assert joined.columns == ["key", "id", "value"]


def test_word_vectors_average_as_the_model_does(spark):
    df = words_by_id(spark)
    model = W.fit_word_vectors(df, size=3)
    theirs = model.transform(df).select("id", vector_to_array("features").alias("v"))
    table = store(
        model.getVectors().select("word", vector_to_array("vector").alias("vector")),
        shared_dir(spark, "vectors"),
    )
    expected = {r["id"]: r["v"] for r in theirs.collect()}
    for rows in (1000, 0):
        ours = W.average_word_vectors(df, table, 3, broadcast_rows=rows)
        got = {r["id"]: r["vector"] for r in ours.collect()}
        assert got.keys() == expected.keys()
        for key, value in got.items():
            assert value == pytest.approx(expected[key], abs=1e-6)


def test_rows_that_share_an_id_stay_apart(spark):
    rows = [(1, ["a", "a", "b"]), (1, ["a"])]
    df = spark.createDataFrame(rows, "id long, filtered_words array<string>")
    counts = W.term_counts(df)
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 1), (1, "a", 2), (1, "b", 1)]
    for given in (None, counts):
        weights = {r["term"]: (r["df"], r["idf"]) for r in W.idf_weights(df, counts=given).collect()}
        assert weights == {"a": (2, 0.0), "b": (1, pytest.approx(math.log(3 / 2)))}
    table = store(
        spark.createDataFrame([("a", [3.0])], "word string, vector array<double>"),
        shared_dir(spark, "vectors"),
    )
    means = sorted(r["vector"][0] for r in W.average_word_vectors(df, table, 1).collect())
    assert means == [2.0, 3.0]


def test_word_vectors_follow_the_input_alone(spark):
    df = words_by_id(spark)
    assert W.fit_word_vectors(df, min_count=4).getVectors().count() == 1
    stage = W.fit_word_vectors(df)
    assert stage.getNumPartitions() == W.fit_word_vectors(df.repartition(3)).getNumPartitions() == 4
