import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from postflow.operators import cluster_grid as G


def table(spark, points):
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(points)], "id long, v array<double>")
    return df.repartition(4).select("id", array_to_vector(F.col("v")).alias("features"))


def start_of(spark, points, ks):
    rows = [(k, i, list(map(float, points[i]))) for k in ks for i in range(k)]
    return spark.createDataFrame(rows, "k int, cluster int, centre array<double>")


def lloyd(points, centres, rounds):
    for _ in range(rounds):
        near = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([points[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
    far = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    return centres, far.min(axis=1).sum(), far.argmin(axis=1)


def blobs(seed, n=400, d=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(6, d))[rng.integers(0, 6, n)] * 4 + rng.normal(size=(n, d))


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_same_centres_as_plain_lloyd(spark, rounds):
    points, ks = blobs(rounds), (1, 2, 5, 9)
    done = G.lloyd_grid(table(spark, points), start_of(spark, points, ks), rounds, 0.0)
    got = {k: {} for k in ks}
    for r in done.centres.collect():
        got[r["k"]][r["cluster"]] = r["centre"]
    rows = {r["id"]: r["cluster"] for r in done.rows.collect()}
    for i, k in enumerate(ks):
        centres, cost, near = lloyd(points, points[:k], rounds)
        assert np.allclose([got[k][c] for c in range(k)], centres, atol=1e-9)
        assert done.wssse[k] == pytest.approx(cost)
        assert [rows[j][i] for j in range(len(points))] == near.tolist()


def test_settled_rows_take_no_distances(spark):
    points = blobs(7, 800)
    done = G.lloyd_grid(table(spark, points), start_of(spark, points, (4, 8, 30)), 30, 1e-9)
    full = len(points) * (4 + 8 + 30)
    assert done.computed[0] == full
    assert len(done.computed) > 5 and done.computed[-1] < 0.1 * full
    # One table is left, that of the last round.
    assert done.rows.count() == len(points)


def test_few_equal_and_no_points(spark):
    same = np.ones((5, 2))
    done = G.lloyd_grid(table(spark, same), start_of(spark, same, (1, 3)))
    assert done.wssse == {1: 0.0, 3: 0.0}
    assert {tuple(r["cluster"]) for r in done.rows.collect()} == {(0, 0)}
    none = G.lloyd_grid(table(spark, same).limit(0), start_of(spark, same, (2,)))
    assert none.rows.count() == 0 and none.wssse == {2: 0.0}
    assert [r["centre"] for r in none.centres.collect()] == [[1.0, 1.0]] * 2


def test_starts_are_parts_of_one_order(spark):
    points = [(random.Random(i).random(), i) for i in range(20)]
    got = {}
    for r in G.start_centres(table(spark, points), (2, 5, 50), seed=3).collect():
        got.setdefault(r["k"], {})[r["cluster"]] = tuple(r["centre"])
    assert [len(got[k]) for k in (2, 5, 50)] == [2, 5, 20]
    assert all(got[2][i] == got[5][i] == got[50][i] for i in range(2))
