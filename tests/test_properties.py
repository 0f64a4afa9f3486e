"""Random input against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postflow.functions import posts as P
from postflow.functions import text as X
from postflow.operators import clean as C
from postflow.operators import sentiment as S
from postflow.operators import text as W
from postflow.sources import readers, writers

LEXICON = {"a": 0.0, "b": 1.0, "ab": 4.0, "é": 3.0}


def strings(seed, alphabet, n=400, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def by_id(df, column):
    return [row[column] for row in df.orderBy("id").collect()]


def name_of(source):
    parts = source.split(">")
    while parts and parts[-1] == "":
        parts.pop()
    if len(parts) < 2 or (parts[1] and set(parts[1]) == {"<"}):
        return "Other"
    return parts[1].split("<")[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_source_names(spark, seed):
    texts = strings(seed, "<>ab")
    got = by_id(frame(spark, texts).select("id", P.source_name(F.col("text")).alias("n")), "n")
    assert got == [name_of(t) for t in texts]


def tokens_of(text):
    if text == "":
        return [""]
    parts = re.split(r"[ \t\n\x0b\f\r]", text.lower())
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize("seed", [3, 4])
def test_tokens(spark, seed):
    texts = strings(seed, " \t\n\x0b\f\rAbé#")
    assert by_id(W.tokenize(frame(spark, texts)), "words") == [tokens_of(t) for t in texts]


def terms_of(text):
    return [w for w in re.split(r"[^\w]+", text.lower()) if w]


@pytest.mark.parametrize("seed", [5, 6])
def test_tracking(spark, seed):
    phrases = ["a b", "ab", "É a", "b1 a"]
    texts = strings(seed, " .#AbBé1-")
    expected = [
        any(set(terms_of(p)) <= set(terms_of(t)) for p in phrases) for t in texts
    ]
    df = frame(spark, texts).select("id", X.matches_phrase(F.col("text"), phrases).alias("hit"))
    assert by_id(df, "hit") == expected
    assert any(expected) and not all(expected)


def sentiment_of(text):
    text = re.sub(r"\.+(\s|\Z)", r"\n\1", text)
    parts = [p.strip() for p in re.split(r"[!?\r\n]+", text)]
    parts = [p for p in parts if re.search(r"[^\W_]", p)]
    if not parts:
        return -1.0, -1.0, -1.0
    scores = []
    for part in parts:
        hits = [LEXICON[w] for w in terms_of(part) if w in LEXICON]
        scores.append(sum(hits) / len(hits) if hits else 2.0)
    sizes = [len(p) for p in parts]
    weighted = sum(s * n for s, n in zip(scores, sizes)) / sum(sizes)
    return weighted, sum(scores) / len(scores), scores[sizes.index(max(sizes))]


@pytest.mark.parametrize("seed", [7, 8])
def test_sentiment(spark, seed):
    texts = strings(seed, "  .!\r\n\u00a0abbé,", longest=30)
    rows = S.post_sentiment(frame(spark, texts), LEXICON).orderBy("id").collect()
    for row, text in zip(rows, texts):
        got = row["score"], row["mean_score"], row["main_score"]
        assert got == pytest.approx(sentiment_of(text)), text


def test_a_text_held_by_a_third_of_all_posts(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("the same text"))
        .otherwise(F.concat(F.lit("text "), F.col("id")))
        .alias("text")
    )
    assert C.dedup_posts(df).count() == 20_001
    words = W.tokenize(df).withColumn("filtered_words", F.col("words"))
    weights = {r["term"]: r["df"] for r in W.idf_weights(words).filter("df > 1").collect()}
    assert weights == {"the": 10_000, "same": 10_000, "text": 30_000}


def test_a_hot_slice_is_cut_into_files(spark, posts, tmp_path):
    wide = posts.withColumn("text", F.concat(F.repeat("text", 3), F.uuid()))
    many = wide.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("_copy")
    hot = many.withColumn(
        "createdAt",
        F.when(F.col("id") % 3 > 0, F.lit("2019-01-12 05:00:00").cast("timestamp")).otherwise(
            F.col("createdAt")
        ),
    )
    hot = hot.repartition(16)  # a large input comes from many tasks; cuts fall between those
    path = tmp_path / "slices"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        writers.write_time_slices(hot, str(path), "hour")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folder = path / "year=2019" / "month=1" / "day=12" / "hour=5" / "batch_id=0"
    assert len(list(folder.glob("*.json"))) > 3
    assert readers.read_time_slice(spark, str(path)).count() == hot.count()
