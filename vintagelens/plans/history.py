"""Monthly forward fill of the model features from a carried state."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.operators.features import model_features
from vintagelens.operators.fills import carry_forward
from vintagelens.plans.datamart import Datamart
from vintagelens.sources.snapshots import read_all, snapshot_between, snapshot_equals, write_snapshots

LAST_DAY = "9999-12-31"


def last_state(spark: SparkSession, path: str, start: str) -> DataFrame | None:
    """The state after the last snapshot before ``start``; None if the history starts there."""
    try:
        states = read_all(spark, path)
    except AnalysisException:  # no state has been written yet
        return None
    earlier = states.where(F.col("snapshot_date") < F.lit(start).cast("date"))
    day = earlier.agg(F.max("snapshot_date")).first()[0]
    return None if day is None else snapshot_equals(states, day).drop("snapshot_date")


def fill_period(
    features: DataFrame, filled_path: str, state_path: str, start: str | dt.date, end: str | dt.date, columns: list[str]
) -> None:
    """Fill the snapshots of a period and store them, and the state at its end.

    Reads the period and the state before it, whatever the length of the history. States
    after ``start`` are replaced, as they rest on what the period held before: periods go in
    order of time, and after a rerun so do those behind it.
    """
    spark, start, end = features.sparkSession, str(start), str(end)
    rows = snapshot_between(features, start, end)
    filled, state = carry_forward(rows, last_state(spark, state_path, start), columns)
    write_snapshots(filled, filled_path, period=(start, end))
    after = state.withColumn("snapshot_date", F.lit(end).cast("date"))
    write_snapshots(after, state_path, period=(start, LAST_DAY))


def run(spark: SparkSession, mart: Datamart, start: str, end: str | None = None) -> DataFrame:
    """Filled model features of one snapshot, or of a period, from the stored feature tables."""
    end = end or start
    tables = ((mart.engagement, schemas.ENGAGEMENT), (mart.risk, schemas.RISK))
    engagement, risk = (snapshot_between(read_all(spark, path, schema), start, end) for path, schema in tables)
    joined_path = mart.joined_features
    joined = model_features(engagement, risk, "engagement").select(*schemas.KEYS, *schemas.MODEL_FEATURES)
    write_snapshots(joined, joined_path, period=(start, end))
    fill_period(read_all(spark, joined_path, schemas.JOINED), mart.filled_features, mart.fill_state, start, end, schemas.MODEL_FEATURES)
    return snapshot_between(read_all(spark, mart.filled_features, schemas.JOINED), start, end)
