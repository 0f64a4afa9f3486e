import math
import random
import re

import pytest
from pyspark.sql import functions as F

from postflow.functions import reading as R
from postflow.functions.sentiment import PROBED_WORDS, sentence_score
from postflow.operators.ordinal import fit_ordinal
from postflow.sources.storage import shared_dir, store
from tests.conftest import plan_of

LEXICON = {"good": 3.5, "great": 4.0, "bad": 0.5, "awful": 0.0, "fine": 2.5, "not": 4.0}


def read(text):
    s = dict.fromkeys((*R.FEATURES, "listed"), 0)
    reach, boost, contrast = 0, 1.0, False
    for w in re.findall(r"\w+", (text or "").lower()):
        if w in R.NEGATIONS:
            reach, boost = R.SCOPE, 1.0
        elif w in R.CONTRASTS:
            s["before"] += s["plain"] - s["negated"] + s["after"]
            s["plain"] = s["negated"] = s["after"] = 0
            reach, boost, contrast = 0, 1.0, True
        elif w in R.INTENSIFIERS:
            boost, reach = boost * R.INTENSIFIERS[w], max(reach - 1, 0)
        else:
            if w in LEXICON:
                x = (LEXICON[w] - 2) * boost
                s["listed"] += 1
                if contrast:
                    s["after"] += -x if reach else x
                else:
                    s["negated" if reach else "plain"] += x
            reach, boost = max(reach - 1, 0), 1.0
    return s


def sentences(rng, n):
    words = [*LEXICON, "very", "slightly", "but", "never", "the", "film", "was", "and"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(n)]


def test_fold_against_a_loop(spark):
    texts = sentences(random.Random(1), 200) + ["", "Not very GOOD, but great!", "good but not bad yet awful"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "id long, s string")
    got = df.select("id", R.read_sentence(F.col("s"), LEXICON).alias("r"), R.reading_score(F.col("s"), LEXICON).alias("score"))
    for r in got.collect():
        s = read(texts[r["id"]] if r["id"] >= 0 else None)
        assert r["r"].asDict() == pytest.approx(s)
        mean = sum(s[k] * w for k, w in R.WEIGHTS.items()) / s["listed"] if s["listed"] else 0
        assert r["score"] == pytest.approx(min(max(2 + mean, 0), 4))


def test_a_lexicon_too_large_to_probe(spark):
    texts = sentences(random.Random(4), 100)
    large = LEXICON | {f"unused{i}": 1.0 for i in range(PROBED_WORDS)}
    df = spark.createDataFrame(list(enumerate(texts)), "id long, s string")
    for r in df.select("id", R.read_sentence(F.col("s"), large).alias("r")).collect():
        assert r["r"].asDict() == pytest.approx(read(texts[r["id"]]))


def test_the_fold_sees_listed_words_only(spark):
    """an unlisted word costs a probe of a set, not a step of the fold."""
    df = spark.createDataFrame([("not the the good",)], "s string")
    plan = plan_of(df.select(R.read_sentence(F.col("s"), LEXICON)))
    assert "filter(transform(" in plan[plan.index("aggregate(") :]


def test_ordinal_regression_finds_the_model(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(3000):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        u = rng.random()
        noise = math.log(u / (1 - u))
        rows.append((x, z, sum(2 * x - z + noise > t for t in (-1.0, 0.5, 2.0))))
    table = store(spark.createDataFrame(rows, "x double, z double, label int"), shared_dir(spark, "rows"))
    model = fit_ordinal(table, ("x", "z"), penalty=0.0)
    assert model.weights == pytest.approx((2, -1), abs=0.2)
    assert model.thresholds == pytest.approx((-1, 0.5, 2), abs=0.2)
    scored = table.select("label", model.expected_class().alias("e"), model.likeliest_class().alias("k")).collect()
    assert sum(r["k"] == r["label"] for r in scored) > 0.5 * len(scored)
    assert sum(r["e"] for r in scored) == pytest.approx(sum(r["label"] for r in scored), rel=0.02)


def test_few_classes_and_no_rows(spark):
    table = spark.createDataFrame([(1.0, 0), (2.0, 0), (None, 1)], "x double, label int")
    assert fit_ordinal(table, ("x",)).thresholds == ()
    assert fit_ordinal(table.limit(0), ("x",)).weights == (0.0,)
    apart = spark.createDataFrame([(0.0, 0), (1.0, 1)] * 20, "x double, label int")
    model = fit_ordinal(apart, ("x",))
    assert math.isfinite(model.weights[0]) and model.weights[0] > 1


def test_held_out_against_the_lexicon_mean(spark):
    """Sentences labelled by a reader who heeds negation and contrast, with some noise."""
    rng = random.Random(3)
    rows = []
    for i, text in enumerate(sentences(rng, 1500)):
        s = read(text)
        heard = s["plain"] - 0.8 * s["negated"] + 0.3 * s["before"] + 1.2 * s["after"]
        rows.append((i, text, min(4, max(0, round(2 + heard + rng.gauss(0, 0.3))))))
    table = spark.createDataFrame(rows, "id long, s string, label int")
    read_ = table.select("id", "label", R.read_sentence(F.col("s"), LEXICON).alias("r"), sentence_score(F.col("s"), LEXICON).alias("mean"))
    stored = store(read_.select("id", "label", "mean", "r.*"), shared_dir(spark, "read"))
    model = fit_ordinal(stored.filter("id % 3 != 0"), R.FEATURES)
    held = stored.filter("id % 3 = 0").withColumn("e", model.expected_class())
    ours, theirs = held.agg(F.avg(F.abs(F.col("e") - F.col("label"))), F.avg(F.abs(F.col("mean") - F.col("label")))).first()
    assert ours < 0.6 * theirs
