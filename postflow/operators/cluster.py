"""Splitting, k-means over a grid of k, elbow choice and cluster reports."""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.operators.clean import split_bucket
from postflow.values import ELBOW_SLOPE, K_GRID, KMEANS_SEED, SPLIT_SEED

SPLIT_BUCKETS = 1000


def with_part(
    df: DataFrame, train: float = 0.7, seed: int = SPLIT_SEED, key: str = "id"
) -> DataFrame:
    """Add ``part``: ``train`` or ``test``, decided by a hash of the key alone.

    A lost task that runs again, or another layout of the files, gives the same parts.
    """
    bucket = split_bucket(F.col(key), seed, SPLIT_BUCKETS)
    part = F.when(bucket < round(train * SPLIT_BUCKETS), "train").otherwise("test")
    return df.withColumn("part", part)


def split_train_test(
    df: DataFrame,
    train: float = 0.7,
    seed: int = SPLIT_SEED,
    key: str = "id",
    by_hash: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The two parts of a table; ``by_hash=False`` uses ``randomSplit``, which needs no key."""
    if not by_hash:
        first, second = df.randomSplit([train, 1 - train], seed)
        return first, second
    parts = with_part(df, train, seed, key)
    return tuple(parts.filter(F.col("part") == name).drop("part") for name in ("train", "test"))


def fit_kmeans(
    df: DataFrame, k: int, seed: int = KMEANS_SEED, features: str = "features", **settings
):
    """``settings`` go to the fit, such as ``maxIter`` and ``tol``."""
    return KMeans(k=k, seed=seed, featuresCol=features, **settings).fit(df)


def kmeans_grid(
    train: DataFrame,
    grid=K_GRID,
    seed: int = KMEANS_SEED,
    features: str = "features",
    at_once: int = 8,
) -> dict[int, KMeansModel]:
    """One model per k.

    The features are cached once for all fits. ``at_once`` of these overlap, the longest first.
    """
    points = train.select(features).persist()
    fit = inheritable_thread_target(train.sparkSession)(
        lambda k: fit_kmeans(points, k, seed, features)
    )
    try:
        points.count()
        largest = sorted(grid, reverse=True)
        with ThreadPoolExecutor(at_once) as pool:
            models = dict(zip(largest, pool.map(fit, largest)))
    finally:
        points.unpersist()
    return {k: models[k] for k in grid}


def centres_of(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """``(cluster, centre)``: the mean vector of each integer ``label``."""
    means = df.groupBy(label).agg(Summarizer.mean(F.col(features)).alias("centre"))
    return means.select(
        F.col(label).cast("int").alias("cluster"), vector_to_array("centre").alias("centre")
    )


def _centre_table(spark: SparkSession, models: Mapping[int, Sequence]) -> DataFrame:
    """``(k, cluster, centre)`` as a local relation, which needs no job to be read."""
    rows = [(k, i, c) for k, centres in models.items() for i, c in enumerate(centres)]
    columns = {
        "k": pa.array([row[0] for row in rows], pa.int32()),
        "cluster": pa.array([row[1] for row in rows], pa.int32()),
        "centre": pa.array([list(map(float, row[2])) for row in rows], pa.list_(pa.float64())),
    }
    return spark.createDataFrame(pa.table(columns))


def _squared_distance(point: Column, centre: Column) -> Column:
    parts = F.zip_with(point, centre, lambda a, b: (a - b) * (a - b))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def _nearest(point: Column, centres: Column) -> Column:
    """The least ``struct<distance, cluster>`` over an array of ``struct<cluster, centre>``."""
    return F.array_min(
        F.transform(
            centres,
            lambda c: F.struct(
                _squared_distance(point, c["centre"]).alias("distance"), c["cluster"].alias("cluster")
            ),
        )
    )


def nearest_centres(
    df: DataFrame, centres: DataFrame, features: str = "features", output: str = "prediction"
) -> DataFrame:
    """Add the nearest of ``centres (cluster, centre)`` and the squared ``distance`` to it.

    Of equally near centres the first cluster wins. The centres are a model of k rows: they are
    read into one value of the plan, which each task gets.
    """
    table = centres.agg(F.sort_array(F.collect_list(F.struct("cluster", "centre"))))
    best = df.withColumn("_centres", table.scalar()).withColumn(
        "_best", _nearest(vector_to_array(features), F.col("_centres"))
    )
    return best.withColumns(
        {output: F.col("_best.cluster"), "distance": F.col("_best.distance")}
    ).drop("_best", "_centres")


def wssse_of(df: DataFrame, centres: DataFrame, features: str = "features") -> DataFrame:
    """``(k, wssse)`` over all rows of ``df`` for given centre sets ``(k, cluster, centre)``."""
    sets = centres.groupBy("k").agg(
        F.sort_array(F.collect_list(F.struct("cluster", "centre"))).alias("centres")
    )
    table = sets.agg(F.sort_array(F.collect_list(F.struct("k", "centres"))))
    points = df.select(vector_to_array(features).alias("point"))
    every = points.select("point", F.explode(table.scalar()).alias("s"))
    cost = _nearest(F.col("point"), F.col("s.centres"))["distance"]
    return every.select(F.col("s.k").alias("k"), cost.alias("d")).groupBy("k").agg(
        F.sum("d").alias("wssse")
    )


def assign_clusters(df: DataFrame, model: KMeansModel, output: str = "prediction") -> DataFrame:
    return model.transform(df, {model.predictionCol: output})


def with_distance(
    df: DataFrame, model: KMeansModel, features: str = "features", cluster: str = "prediction"
) -> DataFrame:
    """Add ``distance``: the squared distance to the centre of the assigned cluster.

    The centres broadcast here are already on the driver, inside the model.
    """
    centres = cluster_centres(df.sparkSession, model).withColumnRenamed("cluster", cluster)
    joined = df.withColumn("_point", vector_to_array(features)).join(F.broadcast(centres), cluster)
    distance = _squared_distance(F.col("_point"), F.col("centre"))
    return joined.withColumn("distance", distance).drop("_point", "centre")


def wssse(df: DataFrame, models: Mapping[int, KMeansModel], features: str = "features") -> DataFrame:
    """``(k, wssse)`` over all rows of ``df``: every model in one pass over the features.

    A row is assigned by each model in turn, then meets its centres in one broadcast join. Only
    one partial sum per model and task is shuffled.
    """
    rows = df.select(features)
    for k, model in models.items():
        rows = assign_clusters(rows, model, f"_c{k}")
    assigned = [
        F.struct(F.lit(k).alias("k"), F.col(f"_c{k}").alias("cluster")) for k in models
    ]
    points = rows.select(
        vector_to_array(features).alias("point"), F.explode(F.array(*assigned)).alias("a")
    ).select("point", "a.k", "a.cluster")
    given = {k: model.clusterCenters() for k, model in models.items()}
    centres = _centre_table(df.sparkSession, given)
    return (
        points.join(F.broadcast(centres), ["k", "cluster"])
        .groupBy("k")
        .agg(F.sum(_squared_distance(F.col("point"), F.col("centre"))).alias("wssse"))
    )


def elbow(curve: DataFrame, threshold: float = ELBOW_SLOPE) -> DataFrame:
    """``(elbow_k)``: the last k reached by a slope below ``threshold``, else the first k.

    The curve has one row per k tried, so its single-partition window is a dozen rows.
    """
    order = Window.orderBy("k")
    slope = (F.col("wssse") - F.lag("wssse").over(order)) / (F.col("k") - F.lag("k").over(order))
    steep = curve.select("k", (slope < threshold).alias("steep"))
    return steep.agg(
        F.coalesce(F.max(F.when(F.col("steep"), F.col("k"))), F.min("k")).alias("elbow_k")
    )


def cluster_centres(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """``(cluster, centre)`` of a fitted model."""
    return _centre_table(spark, {0: model.clusterCenters()}).drop("k")


def cluster_sizes(df: DataFrame, cluster: str = "prediction", top: int = 20) -> DataFrame:
    """Rows per cluster, largest first."""
    return (
        df.groupBy(cluster)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), cluster)
        .limit(top)
    )
