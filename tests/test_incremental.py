import math
import random
from collections import Counter

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from postflow.operators import statistics as M
from postflow.sources.storage import committed, shared_dir, store
from postflow.streaming.incremental import StatisticsStore
from tests.conftest import plan_of

POSTS = "id long, label int, filtered_words array<string>"


def made(rng, n, start=0):
    return [
        (start + i, rng.randrange(3), rng.choices(["a", "b", "c", "d", "", "é"], k=rng.randint(0, 6))) for i in range(n)
    ]


def table(spark, rows):
    return spark.createDataFrame(rows, POSTS)


def sums(df):
    return {(r["kind"], r["label"], r["key"]): (r["n"], r["posts"], r["total"]) for r in df.collect()}


def plain(rows):
    out = Counter()
    posts = Counter()
    for _, label, words in rows:
        out["rows", None, None] += 1
        out["class", label, None] += 1
        for w, n in Counter(w for w in words if w).items():
            out["term", label, w] += n
            posts["term", label, w] += 1
    return {k: (n, posts[k], 0.0) for k, n in out.items()}


def test_parts_merge_to_the_whole(spark):
    rng = random.Random(1)
    first, second = made(rng, 40), made(rng, 30, 40)
    both = M.merge(M.post_statistics(table(spark, first)), M.post_statistics(table(spark, second)))
    assert sums(both) == sums(M.post_statistics(table(spark, first + second))) == plain(first + second)
    assert sums(M.post_statistics(table(spark, []))) == {}


def test_statistics_shuffle_sums_only(spark):
    stored = store(table(spark, made(random.Random(2), 5)), shared_dir(spark, "posts"))
    plan = plan_of(M.post_statistics(stored))
    exchanges = [part for part in plan.split("\n\n") if ") Exchange\n" in part]
    assert exchanges and not any("filtered_words" in part for part in exchanges)
    assert "Python" not in plan


@pytest.mark.parametrize("every", [1, 3])
def test_batches_that_run_again_count_once(spark, every):
    rng = random.Random(every)
    state = StatisticsStore(spark, shared_dir(spark, "sums"), every)
    assert sums(state.read()) == {}
    batches = [made(rng, 8, 10 * i) for i in range(5)]
    for i, rows in enumerate(batches):
        so_far = [r for b in batches[:i] for r in b]
        for _ in range(rng.choice([1, 2, 3])):
            # A batch that runs again finds the state that it found the first time.
            assert sums(state.read(before=i)) == plain(so_far)
            state.add(i, M.post_statistics(table(spark, rows)))
            assert sums(state.read()) == plain(so_far + rows)
    assert len(committed(spark, f"{state.root}/delta")) <= 2 * every + 1
    assert len(committed(spark, f"{state.root}/base")) <= 2


def test_a_table_counts_from_when_it_is_whole(spark):
    state = StatisticsStore(spark, shared_dir(spark, "sums"))
    rows = made(random.Random(3), 9)
    state.add(0, M.post_statistics(table(spark, rows)))
    half = M.post_statistics(table(spark, made(random.Random(4), 5)))
    for kind in ("delta", "base"):
        half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{state.root}/{kind}/1")
    assert sums(state.read()) == plain(rows)
    state.add(1, half)
    assert sums(state.read()) == sums(M.merge(M.post_statistics(table(spark, rows)), half))


def bayes(rows, tests, smoothing=1.0):
    """Naive Bayes over TF-IDF weights, one post at a time."""
    df = Counter(w for _, _, words in rows for w in set(words) if w)
    idf = {w: math.log((len(rows) + 1) / (n + 1)) for w, n in df.items()}
    labels = sorted({r[1] for r in rows})
    mass = {c: Counter() for c in labels}
    for _, c, words in rows:
        for w in filter(None, words):
            mass[c][w] += idf[w]
    out = {}
    for i, _, words in tests:
        best = None
        for c in labels:
            whole = sum(mass[c].values()) + smoothing * len(idf)
            p = math.log(sum(r[1] == c for r in rows) + smoothing) - math.log(len(rows) + smoothing * len(labels))
            for w in words:
                if w in idf:
                    p += idf[w] * math.log((mass[c][w] + smoothing) / whole)
            if best is None or round(p, 9) > best[0]:
                best = (round(p, 9), c)
        out[i] = best[1]
    return out


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_predictions(spark, broadcast_rows):
    rng = random.Random(5)
    rows, tests = made(rng, 60), made(rng, 30, 100) + [(200, 0, []), (201, 0, ["unheard"])]
    classes, terms = M.bayes_of(store(M.post_statistics(table(spark, rows)), shared_dir(spark, "s")))
    classes, terms = store(classes, shared_dir(spark, "c")), store(terms, shared_dir(spark, "t"))
    got = M.predict_bayes(table(spark, tests), classes, terms, broadcast_rows=broadcast_rows).collect()
    assert {r["id"]: r["prediction_bayes"] for r in got} == bayes(rows, tests)


def test_no_classes_predict_nothing(spark):
    classes, terms = M.bayes_of(M.no_statistics(spark))
    got = M.predict_bayes(table(spark, [(1, 0, ["a"])]), classes, terms).collect()
    assert [tuple(r) for r in got] == [(1, None)]
    assert M.idf_of(M.no_statistics(spark)).count() == 0


def test_centres_without_points_stay(spark):
    start = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, 9.0]), (2, [99.0, 99.0])], "cluster int, centre array<double>")
    points = spark.createDataFrame([([1.0, 0.0],), ([0.0, 3.0],), ([8.0, 8.0],)], "v array<double>")
    points = points.select(array_to_vector(F.col("v")).alias("features"))
    done = M.centres_of_statistics(M.merge(M.centre_statistics(points, start)), start)
    assert {r["cluster"]: r["centre"] for r in done.collect()} == {0: [0.5, 1.5], 1: [8.0, 8.0], 2: [99.0, 99.0]}
