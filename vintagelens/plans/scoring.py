"""Batch scoring of snapshots with a stored model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from vintagelens import schemas
from vintagelens.operators import modelling
from vintagelens.operators.features import model_features
from vintagelens.operators.fills import fill_within_date
from vintagelens.operators.treesql import Ensemble
from vintagelens.plans.datamart import Datamart
from vintagelens.plans.monitoring import store_baselines
from vintagelens.sources.snapshots import read_all, snapshot_between, write_snapshots

PREDICTION_PARTITIONS = ["model_name", "snapshot_date"]


def score_snapshots(
    model: PipelineModel | Ensemble, model_name: str, engagement: DataFrame, risk: DataFrame, start: str, end: str
) -> DataFrame:
    """Scores of a closed period, each snapshot by its own features only.

    Rows that share a customer and a snapshot fill each other's gaps; nothing is taken from
    another snapshot.
    """
    features = model_features(snapshot_between(engagement, start, end), snapshot_between(risk, start, end), "risk")
    return modelling.score(model, fill_within_date(features, schemas.MODEL_FEATURES), model_name)


def write_predictions(
    predictions: DataFrame, path: str, model_name: str | None = None, period: tuple[str, str] | None = None
) -> None:
    """Replace the scores of the period, those of snapshots that have none any more included."""
    within = {"model_name": model_name} if model_name else None
    write_snapshots(predictions, path, PREDICTION_PARTITIONS, period=period, within=within)


def run(
    spark: SparkSession, mart: Datamart, model_name: str, start: str, end: str | None = None, source: str = "risk"
) -> DataFrame:
    """Score one snapshot, or every snapshot of a period, and store the predictions.

    The baselines that monitoring compares the next month with are stored beside them.
    """
    end = end or start
    model = modelling.load_model(mart.model(model_name))
    if source == "clickstream":
        clicks = read_all(spark, mart.feature_silver("clickstream"))
        predictions = modelling.score(model, snapshot_between(clicks, start, end), model_name)
    else:
        engagement, risk = read_all(spark, mart.engagement, schemas.ENGAGEMENT), read_all(spark, mart.risk, schemas.RISK)
        predictions = score_snapshots(model, model_name, engagement, risk, start, end)
    write_predictions(predictions, mart.predictions, model_name, (start, end))
    stored = read_all(spark, mart.predictions, schemas.PREDICTIONS)
    scored = snapshot_between(stored.where(stored.model_name == model_name), start, end)
    store_baselines(scored, mart.baselines, model_name, (start, end))
    return scored
