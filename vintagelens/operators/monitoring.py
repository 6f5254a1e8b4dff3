"""Monitoring of stored predictions: drift, quality, status, history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.functions.scores import auc_status, psi_status
from vintagelens.operators.drift import psi_by_snapshot, psi_from_baselines
from vintagelens.operators.features import labelled_predictions
from vintagelens.operators.ranking import auc

RUN = ["model_name", "snapshot_date"]


def monitor_report(predictions: DataFrame, labels: DataFrame, baselines: DataFrame | None = None) -> DataFrame:
    """One row per model and snapshot that has a snapshot one month before it.

    PSI against that snapshot, AUC where labels have arrived, and a status for each. With stored
    ``baselines`` the predictions of the snapshot before are not needed.
    """
    if baselines is None:
        drift = psi_by_snapshot(predictions, ["model_name"])
    else:
        drift = psi_from_baselines(predictions, baselines, ["model_name"])
    quality = auc(labelled_predictions(labels, predictions), RUN, "label", "model_predictions").select(*RUN, "roc_auc")
    return (
        drift.withColumnRenamed("psi", "predict_psi")
        .join(quality, RUN, "left")
        .withColumns({"psi_status": psi_status("predict_psi"), "auc_status": auc_status("roc_auc")})
        .select(*schemas.MONITOR_COLUMNS)
    )


def with_history(history: DataFrame, run: DataFrame) -> DataFrame:
    """Earlier monitor rows and those of this run, matched by column name.

    A snapshot and model that is run again replaces its earlier row.
    """
    kept = history.join(run.select(*RUN), RUN, "left_anti")
    return kept.unionByName(run, allowMissingColumns=True)


def metric_trend(monitor: DataFrame, metric: str) -> DataFrame:
    """One metric over time, in date order."""
    return monitor.select("model_name", "snapshot_date", F.col(metric)).orderBy("model_name", "snapshot_date")
