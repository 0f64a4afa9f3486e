import math

import pytest
from pyspark.sql import functions as F

from checks.fixtures import LEXICON
from postflow.functions import sentiment as E
from postflow.functions import text as X
from postflow.functions.text import terms
from postflow.operators import classify as B
from postflow.operators import sentiment as S
from postflow.sources.storage import shared_dir, store
from postflow.values import SENTIMENT_LABELS, WHITE, WHITE_LETTERS
from tests.conftest import plan_of


@pytest.mark.parametrize(
    "score, name",
    [
        (-1.0, "NOT_UNDERSTOOD"),
        (0.0, "NOT_UNDERSTOOD"),
        (0.5, "VERY_NEGATIVE"),
        (1.0, "NEGATIVE"),
        (1.99, "NEGATIVE"),
        (2.0, "NEUTRAL"),
        (3.0, "POSITIVE"),
        (4.0, "VERY_POSITIVE"),
        (4.99, "VERY_POSITIVE"),
        (5.0, "NOT_UNDERSTOOD"),
        (5.1, "NOT_UNDERSTOOD"),
        (math.nan, "NOT_UNDERSTOOD"),
    ],
)
def test_class_and_label(spark, score, name):
    row = S.with_sentiment(spark.createDataFrame([(score,)], "score double")).first()
    assert (row["sentiment"], row["label"]) == (name, SENTIMENT_LABELS[name])


def test_unknown_class_has_no_label(spark):
    df = spark.createDataFrame([("WHATEVER",)], "name string")
    assert df.select(E.sentiment_label(F.col("name"))).first()[0] is None


def scored(spark, text, lexicon):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    row = S.post_sentiment(df, lexicon).first()
    return row["score"], row["mean_score"], row["main_score"]


def test_post_score_weighs_by_length(spark):
    text = "bad 345678" + ". " + "good 67890 234567890 234567890"
    got = scored(spark, text, {"bad": 1.0, "good": 4.0})
    assert got == (3.25, 2.5, 4.0)


def test_first_longest_sentence_wins(spark):
    assert scored(spark, "bad a. good.\nfine", {"bad": 1.0, "good": 4.0, "fine": 3.0})[2] == 1.0
    assert scored(spark, "good. fine", {"good": 4.0, "fine": 3.0})[2] == 4.0


@pytest.mark.parametrize("text", [None, "", " ... !", "\t\t", "\u00a0.\r\n", "https://t.co/ab1"])
def test_no_sentence(spark, text):
    assert scored(spark, text, {"x": 1.0}) == (-1.0, -1.0, -1.0)


def test_words_are_found_without_case_and_punctuation(spark):
    assert scored(spark, '"GOOD", they said', {"good": 4.0})[0] == 4.0


def test_all_ways_of_scoring_agree(spark, posts):
    parts = S.sentences(posts)
    narrow = S.sentence_scores(parts, LEXICON)
    table = store(
        spark.createDataFrame(list(LEXICON.items()), "word string, score double"),
        shared_dir(spark, "lexicon"),
    )
    expected = {r["id"]: (r["score"], r["mean_score"], r["main_score"]) for r in S.post_sentiment(posts, LEXICON).collect()}
    for rows in (1000, 0):
        by_table = S.sentence_scores_by_table(parts, table, broadcast_rows=rows)
        for way in (narrow, by_table):
            totals = S.post_sentiment_of(posts, way).collect()
            got = {r["id"]: (r["score"], r["mean_score"], r["main_score"]) for r in totals}
            assert got.keys() == expected.keys()
            for key, value in got.items():
                assert value == pytest.approx(expected[key])


def test_a_scorer_can_be_any_column_function(spark, posts):
    parts = S.sentence_scores(S.sentences(posts), scorer=lambda s: (F.length(s) % 5).cast("double"))
    assert parts.filter("score <> length % 5").isEmpty()


def test_a_lexicon_needs_a_word(posts):
    with pytest.raises(ValueError):
        S.post_sentiment(posts, {})


def test_a_lexicon_of_any_size(spark):
    large = {f"w{i}": i / 7000 for i in range(25_000)}
    assert scored(spark, "w70 x w14000", large)[0] == pytest.approx((70 / 7000 + 2.0) / 2)


@pytest.mark.parametrize("tail", ["", "\r\n", "\u00a0", "\t", " !", "\n...\n", " https://t.co/ab1"])
def test_white_space_and_links_are_no_sentence(spark, tail):
    assert scored(spark, "great." + tail, {"great": 4.0}) == (4.0, 4.0, 4.0)


def test_dots_inside_words_end_nothing(spark):
    df = spark.createDataFrame([(1, "v1.2 is 3.5. Yes... no?ok")], "id long, text string")
    assert [r["sentence"] for r in S.sentences(df).orderBy("pos").collect()] == [
        "v1.2 is 3.5", "Yes", "no", "ok"
    ]


def test_a_table_or_a_scorer_labels_posts(spark, posts):
    table = store(
        spark.createDataFrame(list(LEXICON.items()), "word string, score double"),
        shared_dir(spark, "lexicon"),
    )
    columns = ["id", "sentiment", "label"]
    expected = S.label_posts(posts, LEXICON).select(columns)
    by_table = S.label_posts(posts, table, shared_dir(spark, "rows")).select(columns)
    assert expected.exceptAll(by_table).isEmpty() and by_table.exceptAll(expected).isEmpty()
    one = S.label_posts(posts, lambda s: F.lit(3.5), shared_dir(spark, "rows"))
    assert {r["sentiment"] for r in one.select("sentiment").distinct().collect()} == {"POSITIVE"}
    with pytest.raises(ValueError):
        S.label_posts(posts, table)


def test_labels_with_gaps_come_back(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(label, Vectors.dense([1.0 if j == i else 0.0 for j in range(3)])) for i, label in enumerate([1, 3, 5]) for _ in range(4)]
    df = spark.createDataFrame(rows, ["label", "bayes_features"])
    model = B.fit_bayes(df)
    predicted = B.predict_bayes(model, df)
    assert predicted.filter("label <> prediction_bayes").isEmpty()
    assert {r["prediction_bayes"] for r in predicted.collect()} == {1, 3, 5}
    confusion = {tuple(r) for r in B.confusion_counts(predicted).collect()}
    assert confusion == {(1, 1, 4), (3, 3, 4), (5, 5, 4)}


def test_default_lexicon(spark):
    from postflow.lexicon import ENGLISH

    assert scored(spark, "What a wonderful day", ENGLISH)[0] == 4.0
    assert scored(spark, "A terrible, awful idea", ENGLISH)[0] == 0.0
    assert scored(spark, "The table is brown", ENGLISH)[0] == 2.0


def test_a_joined_lexicon_meets_each_word_once_for_many_sentences(spark):
    texts = [(i % 40, "Good bad good thing. The bad end! ?? Nothing here" if i % 3 else None) for i in range(300)]
    texts += [(None, "good"), (7, "good good bad"), (8, "é_1 GOOD")]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3).localCheckpoint()
    lexicon = {"good": 4.0, "bad": 1.0, "end": 0.0, "é_1": 3.0}
    table = spark.createDataFrame([*lexicon.items(), ("the", None)], "word string, score double").localCheckpoint()
    parts = S.sentences(df)
    expected = S.sentence_scores(parts, lexicon).select("id", "pos", F.round("score", 6), "length")
    got = S.sentence_scores_by_table(parts, table, broadcast_rows=0)
    rounded = got.select("id", "pos", F.round("score", 6), "length")
    assert sorted(map(str, rounded.collect())) == sorted(map(str, expected.collect()))
    words = parts.select(F.monotonically_increasing_id().alias("_part"), terms(F.col("sentence")).alias("words"))
    sent = words.mapInArrow(S._words_of_batch, "word string, _first long, places array<int>")
    whole = words.select(F.explode("words")).count()
    assert sent.agg(F.sum(F.size("places"))).first()[0] == whole
    assert sent.count() <= 3 * 10 < whole


def test_sentences_are_trimmed_without_a_regex(spark):
    """ends are cut at their letters; no pattern is tried at every blank of a sentence."""
    every = [(chr(i),) for i in range(0x10000) if not 0xD800 <= i <= 0xDFFF]
    white = spark.createDataFrame(every, "c string").filter(F.col("c").rlike(f"^[{WHITE}]$")).collect()
    assert sorted(r["c"] for r in white) == sorted(WHITE_LETTERS)
    rows = spark.createDataFrame([(c + "a" + c + "b" + c,) for c in WHITE_LETTERS if c not in "\n\r"], "text string")
    for r in rows.select("text", X.sentences(F.col("text")).alias("s")).collect():
        assert r["s"] == [r["text"][1:-1]]
    plan = plan_of(spark.createDataFrame([("a",)], "text string").select(X.sentences(F.col("text"))))
    assert "regexp_replace(lambda" not in plan


def test_links_are_left_out_as_before(spark):
    texts = ["see HTTPS://x.y/z now", "http://", "https://a http://b", "no link", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(X.sentences(F.col("text"))).collect()
    assert [r[0] for r in rows] == [["see   now"], ["http://"], [], ["no link"], None]
