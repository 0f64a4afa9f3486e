"""Naive Bayes over term features."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = "bayes_features"
PREDICTION = "prediction_bayes"


def fit_bayes(
    train: DataFrame, features: str = FEATURES, label: str = "label", smoothing: float = 1.0
) -> PipelineModel:
    """Multinomial Naive Bayes that predicts labels as given.

    Spark numbers classes 0, 1, 2, ... so labels are indexed first and turned back after
    prediction; otherwise a class missing from the training set shifts all later ones.
    """
    index = StringIndexer(inputCol=label, outputCol="_index", stringOrderType="alphabetAsc")
    indexer = index.fit(train)
    model = NaiveBayes(
        featuresCol=features,
        labelCol="_index",
        predictionCol="_predicted",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        smoothing=smoothing,
    ).fit(indexer.transform(train))
    back = IndexToString(inputCol="_predicted", outputCol=PREDICTION, labels=indexer.labels)
    return PipelineModel(stages=[model, back])


def predict_bayes(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the integer ``prediction_bayes``."""
    predicted = model.transform(df).drop("_predicted", "_probability", "_raw")
    return predicted.withColumn(PREDICTION, F.col(PREDICTION).cast("int"))


def bayes_probabilities(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, list[int]]:
    """``df`` with the vector ``probability``, and the labels that its places stand for."""
    bayes, back = model.stages
    scored = bayes.transform(df).withColumnRenamed("_probability", "probability")
    return scored.drop("_predicted", "_raw"), [int(float(name)) for name in back.getLabels()]


def bayes_weights(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(label, prior, weights)``: log prior and log likelihood per feature of each class."""
    bayes, back = model.stages
    theta = bayes.theta.toArray()
    rows = [
        (int(float(name)), float(bayes.pi[i]), [float(x) for x in theta[i]])
        for i, name in enumerate(back.getLabels())
    ]
    return spark.createDataFrame(rows, "label int, prior double, weights array<double>")


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = PREDICTION) -> DataFrame:
    """``(label, prediction, count)`` for every pair that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("count")
    )

