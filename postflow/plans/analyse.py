"""Clustering and classification of clean posts, stage by stage.

Every stage that is read more than once is a stored table: fits that pass over it many times
neither repeat the stages before it nor depend on executors keeping their caches.
"""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import HashingTF, Word2VecModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.operators import classify as B
from postflow.operators import cluster as K
from postflow.operators import text as X
from postflow.operators.clean import dedup_posts
from postflow.operators.sentiment import Lexicon, label_posts
from postflow.operators.word_training import WordVectorTable
from postflow.plans.curate import with_words
from postflow.sources.storage import remove, store
from postflow.values import (
    ELBOW_SLOPE,
    K_GRID,
    KMEANS_SEED,
    SPLIT_SEED,
    TERM_BUCKETS,
    VECTOR_SIZE,
    WORD_VECTOR_TASKS,
)


@dataclass
class Clusters:
    curve: DataFrame
    k: int
    model: KMeansModel
    predictions: DataFrame
    sizes: DataFrame
    centres: DataFrame


@dataclass
class Classes:
    labelled: DataFrame
    predictions: DataFrame
    stages: list


@dataclass
class Analysis:
    features: DataFrame
    clusters: Clusters
    classes: Classes
    model: PipelineModel


def prepare_features(
    clean: DataFrame,
    out_dir: str,
    size: int = VECTOR_SIZE,
    min_count: int = 0,
    tasks: int = WORD_VECTOR_TASKS,
) -> tuple[Word2VecModel | WordVectorTable, DataFrame] | None:
    """Word vectors fitted on all posts, and the stored ``features`` of the unique posts.

    None when the posts hold no word often enough. Words are cut once and stored, for the fit's
    passes and the features.
    """
    folder = f"{out_dir}/words"
    words = store(with_words(clean), folder)
    occurs = words.select(F.explode("filtered_words").alias("w")).groupBy("w").count()
    if occurs.filter(F.col("count") >= min_count).isEmpty():
        remove(clean.sparkSession, folder)
        return None
    model = X.fit_word_vectors(words, size, min_count, tasks=tasks)
    features = store(model.transform(dedup_posts(words)), f"{out_dir}/features")
    remove(clean.sparkSession, folder)
    return model, features


def cluster_posts(
    train: DataFrame,
    test: DataFrame,
    points: DataFrame,
    out_dir: str,
    grid=K_GRID,
    threshold: float = ELBOW_SLOPE,
    seed: int = KMEANS_SEED,
) -> Clusters:
    """Fit every k on ``train``, choose one by the elbow over all ``points``, and assign ``test``.

    The chosen model is the one the grid already holds: fitting it again with the same seed
    would only repeat the work.
    """
    models = K.kmeans_grid(train, grid, seed)
    spark = train.sparkSession
    costs = K.wssse(points.select("features"), models)
    curve = spark.createDataFrame(costs.collect(), "k int, wssse double").coalesce(1)
    k = K.elbow(curve, threshold).first()["elbow_k"]
    predictions = store(K.assign_clusters(test, models[k]), f"{out_dir}/clusters")
    centres = K.cluster_centres(spark, models[k])
    return Clusters(curve, k, models[k], predictions, K.cluster_sizes(predictions), centres)


def classify_posts(
    train: DataFrame,
    test: DataFrame,
    out_dir: str,
    lexicon: Lexicon,
    buckets: int = TERM_BUCKETS,
    refit: bool = False,
) -> Classes:
    """Label ``train`` by sentiment, learn the labels from term weights, and predict ``test``.

    Term weights come from ``train``; ``refit`` fits them on ``test`` again before predicting, if
    it has rows. ``lexicon`` is a mapping, a stored table or a scorer.
    """
    rows = f"{out_dir}/scored_rows"
    labelled = store(label_posts(train, lexicon, rows), f"{out_dir}/labelled")
    remove(train.sparkSession, rows)
    hashed = X.hashing_tf(labelled, buckets)
    idf = X.fit_idf(hashed)
    bayes = B.fit_bayes(idf.transform(hashed))
    hashed_test = X.hashing_tf(test, buckets)
    idf_test = X.fit_idf(hashed_test) if refit and not test.isEmpty() else idf
    predicted = B.predict_bayes(bayes, idf_test.transform(hashed_test))
    predictions = store(predicted, f"{out_dir}/classes")
    hashing = HashingTF(
        inputCol="filtered_words", outputCol="rawFeatures", numFeatures=buckets
    )
    return Classes(labelled, predictions, [hashing, idf, *bayes.stages])


def analyse_posts(
    clean: DataFrame,
    out_dir: str,
    lexicon: Lexicon,
    grid=K_GRID,
    threshold: float = ELBOW_SLOPE,
    seed: int = SPLIT_SEED,
    refit: bool = False,
    size: int = VECTOR_SIZE,
    min_count: int = 0,
    tasks: int = WORD_VECTOR_TASKS,
) -> Analysis | None:
    """The whole analysis of clean posts. None when there is nothing to learn from.

    ``size``, ``min_count`` and ``tasks`` are those of the word vectors.
    """
    prepared = prepare_features(clean, out_dir, size, min_count, tasks)
    if prepared is None:
        return None
    vectors, features = prepared
    train, test = K.split_train_test(features, seed=seed)
    if train.isEmpty():
        return None
    clusters = cluster_posts(train, test, features, out_dir, grid, threshold)
    classes = classify_posts(train, test, out_dir, lexicon, refit=refit)
    model = PipelineModel(stages=[vectors, clusters.model, *classes.stages])
    return Analysis(features, clusters, classes, model)


def score_posts(model: PipelineModel, clean: DataFrame) -> DataFrame:
    """Clusters and classes of new posts by an earlier analysis' model: no fit, no shuffle."""
    return B.predict_bayes(model, with_words(clean))
