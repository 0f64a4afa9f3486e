import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks.queries import vectors
from postflow.operators import cluster as K
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def points(spark):
    return vectors(spark, SF_DIR)


def curve(spark, pairs):
    return spark.createDataFrame(pairs, "k int, wssse double")


def test_elbow_takes_the_last_steep_step(spark):
    steep = curve(spark, [(20, 500.0), (30, 400.0), (40, 390.0), (50, 350.0), (60, 340.0)])
    assert K.elbow(steep).first()["elbow_k"] == 50
    flat = curve(spark, [(20, 500.0), (30, 480.0), (40, 470.0)])
    assert K.elbow(flat).first()["elbow_k"] == 20
    assert K.elbow(flat, -1.5).first()["elbow_k"] == 30


def test_split_covers_and_ignores_layout(spark, posts):
    train, test = K.split_train_test(posts)
    ids = lambda df: {r["id"] for r in df.select("id").collect()}
    assert ids(train) | ids(test) == ids(posts)
    assert not ids(train) & ids(test)
    again, _ = K.split_train_test(posts.repartition(5, "text"))
    assert ids(again) == ids(train)
    other, _ = K.split_train_test(posts, seed=7)
    assert ids(other) != ids(train)
    assert 0.6 < len(ids(train)) / len(ids(posts)) < 0.8


def test_random_split_covers(posts):
    train, test = K.split_train_test(posts, by_hash=False)
    assert train.count() + test.count() == posts.count()


def test_wssse_is_the_training_cost(points):
    models = K.kmeans_grid(points, (3, 7))
    assert list(models) == [3, 7]
    costs = {r["k"]: r["wssse"] for r in K.wssse(points, models).collect()}
    for k, model in models.items():
        assert costs[k] == pytest.approx(model.summary.trainingCost, rel=1e-6)
        distances = K.with_distance(K.assign_clusters(points, model), model)
        assert distances.agg(F.sum("distance")).first()[0] == pytest.approx(costs[k])


def test_given_centres_against_brute_force(spark, points):
    centres = K.centres_of(points, "label")
    given = np.array([r["centre"] for r in centres.orderBy("cluster").collect()])
    data = np.array([r["features"].toArray() for r in points.select("features").collect()])
    exact = ((data[:, None, :] - given[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert K.wssse_of(points, centres.withColumn("k", F.lit(10))).first()["wssse"] == pytest.approx(exact)
    nearest = K.nearest_centres(points, centres)
    assert nearest.agg(F.sum("distance")).first()[0] == pytest.approx(exact)


def test_one_centre_and_equal_centres(spark):
    df = spark.createDataFrame([([0.0],), ([4.0],)], "v array<double>")
    df = df.select(array_to_vector("v").alias("features"))
    one = spark.createDataFrame([(7, [1.0])], "cluster int, centre array<double>")
    rows = K.nearest_centres(df, one).orderBy("distance").collect()
    assert [(r["prediction"], r["distance"]) for r in rows] == [(7, 1.0), (7, 9.0)]
    equal = spark.createDataFrame(
        [(2, [4.0]), (1, [4.0]), (0, [0.0])], "cluster int, centre array<double>"
    )
    rows = K.nearest_centres(df, equal).orderBy("prediction").collect()
    assert [(r["prediction"], r["distance"]) for r in rows] == [(0, 0.0), (1, 0.0)]


def test_more_clusters_than_points(spark):
    df = spark.createDataFrame([([0.0],), ([1.0],), ([9.0],)], "v array<double>")
    model = K.fit_kmeans(df.select(array_to_vector("v").alias("features")), 20)
    assert len(model.clusterCenters()) <= 3


def test_cluster_sizes(spark):
    df = spark.createDataFrame([(c,) for c in [2, 2, 1, 1, 0]], "prediction int")
    assert [tuple(r) for r in K.cluster_sizes(df, top=2).collect()] == [(1, 2), (2, 2)]
