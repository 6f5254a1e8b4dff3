"""Monthly monitoring of the stored predictions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.operators import drift
from vintagelens.operators.monitoring import monitor_report
from vintagelens.plans.datamart import Datamart
from vintagelens.sources.snapshots import read_all, snapshot_between, write_snapshots


BASELINE_COLUMNS = ["model_name", "snapshot_date"]


def store_baselines(scored: DataFrame, path: str, model_name: str, period: tuple[str, str] | None = None) -> None:
    """Bin edges and counts of a model's snapshots, which later months are compared with."""
    rows = drift.baselines(scored, ["model_name"])
    write_snapshots(rows, path, BASELINE_COLUMNS, period=period, within={"model_name": model_name})


def read_baselines(spark: SparkSession, path: str, model_name: str) -> DataFrame | None:
    try:
        return read_all(spark, path, schemas.BASELINES).where(F.col("model_name") == model_name)
    except AnalysisException:  # none has been stored yet
        return None


def run(
    spark: SparkSession,
    mart: Datamart,
    model_name: str,
    start: str,
    end: str | None = None,
    label_def: str = schemas.LABEL_DEFINITION,
) -> DataFrame:
    """Report one snapshot, or every snapshot of a period, and add it to the history.

    Reads the predictions of the period only: those of the month before are represented by
    their stored baseline. Where scoring has stored none, it is made up for first. Returns the
    whole history of the model in date order.
    """
    end = end or start
    month_before = F.add_months(F.lit(start).cast("date"), -1)
    day = F.col("snapshot_date")
    scored = read_all(spark, mart.predictions, schemas.PREDICTIONS).where(F.col("model_name") == model_name)
    needed = scored.where(day.between(month_before, F.lit(end).cast("date"))).select("snapshot_date").distinct()
    have = read_baselines(spark, mart.baselines, model_name)
    if have is not None:
        needed = needed.join(have.select("snapshot_date").distinct(), "snapshot_date", "left_anti")
    missing = sorted(r.snapshot_date for r in needed.collect())  # dates of the calendar
    if missing:
        store_baselines(scored.where(day.isin(missing)), mart.baselines, model_name)
    own = snapshot_between(scored, start, end)
    labels = snapshot_between(read_all(spark, mart.label_store, schemas.LABELS), start, end)
    report = monitor_report(own, labels.where(F.col("label_def") == label_def), read_baselines(spark, mart.baselines, model_name))
    period = (start, end)
    write_snapshots(report, mart.monitor, BASELINE_COLUMNS, period=period, within={"model_name": model_name})
    history = read_all(spark, mart.monitor, schemas.MONITOR)
    return history.where(F.col("model_name") == model_name).orderBy("snapshot_date")
