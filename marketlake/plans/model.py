"""Train, score and judge a multiclass classifier."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_split(df: DataFrame, key: Column, test_percent: int = 20) -> DataFrame:
    """Add ``is_test`` from a hash of the key: the same rows on any cluster."""
    bucket = F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("bigint") % 100
    return df.withColumn("is_test", bucket < test_percent)


def with_features(df: DataFrame, features: Column) -> DataFrame:
    return df.withColumn("features", array_to_vector(features.cast("array<double>")))


def fit_classifier(train: DataFrame, label: str, max_iter: int = 1000) -> LogisticRegressionModel:
    """Multinomial logistic regression; the solver is L-BFGS."""
    return LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, family="multinomial"
    ).fit(train)


def score(model: LogisticRegressionModel, df: DataFrame, label: str) -> DataFrame:
    """Rows with ``actual_class`` and ``predicted_class``."""
    return model.transform(df).select(
        *df.columns,
        F.col(label).cast("bigint").alias("actual_class"),
        F.col("prediction").cast("bigint").alias("predicted_class"),
    )


def accuracy(scored: DataFrame) -> DataFrame:
    hit = F.col("actual_class") == F.col("predicted_class")
    return scored.agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.round(F.avg(hit.cast("double")), 6).alias("accuracy"),
    )
