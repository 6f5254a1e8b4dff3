"""Joins that assemble feature and training tables.

Every join is an equi-join on (Customer_ID, snapshot_date). No side carries a broadcast
hint, because both grow with the data: Spark picks the strategy from measured sizes and
splits hot keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens import schemas


def attributes_with_financials(attributes: DataFrame, financials: DataFrame) -> DataFrame:
    return attributes.join(financials, schemas.KEYS, "inner")


def with_clickstream(clickstream: DataFrame, profile: DataFrame) -> DataFrame:
    """All clickstream rows, with the customer profile of the same snapshot where there is one.

    ``feature_snapshot_date`` is the profile's date, so it is NULL without a profile.
    """
    dated = profile.withColumn("feature_snapshot_date", F.col("snapshot_date"))
    return clickstream.join(dated, schemas.KEYS, "left")


def feature_store(attributes: DataFrame, financials: DataFrame, clickstream: DataFrame) -> DataFrame:
    """Gold features; ``snapshot_date`` stays as the key the table is partitioned by."""
    joined = with_clickstream(clickstream, attributes_with_financials(attributes, financials))
    return joined.drop(*schemas.FEATURE_STORE_DROPS)


def model_features(engagement: DataFrame, risk: DataFrame, base: str = "engagement") -> DataFrame:
    """Engagement and financial-risk features side by side.

    ``base`` says whose rows are kept: ``engagement`` (training), ``risk`` (scoring) or
    ``both`` (full outer).
    """
    if base == "risk":
        return risk.join(engagement, schemas.KEYS, "left")
    how = {"engagement": "left", "both": "full"}[base]
    return engagement.join(risk, schemas.KEYS, how)


def training_frame(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with their features; a label without features keeps NULLs."""
    return labels.join(features, schemas.KEYS, "left")


def labelled_predictions(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """Scores with their outcomes, paired by key; pairs with a NULL on either side are dropped."""
    pairs = labels.select(*schemas.KEYS, "label").join(predictions, schemas.KEYS, "inner")
    return pairs.na.drop("any", subset=["label", "model_predictions"]).select(
        *schemas.PREDICTION_COLUMNS[:3], "label", "model_predictions"
    )
