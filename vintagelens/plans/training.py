"""Training set, model search, report and registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.operators import modelling
from vintagelens.operators.features import model_features, training_frame
from vintagelens.operators.fills import fill_history
from vintagelens.operators.rows import columns_with_prefix, drop_incomplete, is_usable
from vintagelens.operators.splits import split_windows, stratified_split, time_split
from vintagelens.plans.datamart import Datamart
from vintagelens.sources.snapshots import read_all, snapshot_between, write_snapshots

# Writes a table under a name and reads it back.
Store = Callable[[str, DataFrame], DataFrame]

SPLIT_KEYS = ["Customer_ID", "snapshot_date", "loan_id"]


@dataclass
class Trained:
    model: PipelineModel
    report: DataFrame
    registry: DataFrame
    trials: DataFrame


def filled_training_frame(
    labels: DataFrame, engagement: DataFrame, risk: DataFrame, direction: str = "both", store: Store | None = None
) -> DataFrame:
    """Complete labelled rows with engagement and risk features, gaps filled from the history.

    ``store`` writes a table and reads it back: the fill reads the joined features twice.
    """
    joined = model_features(engagement, risk, "engagement")
    features = fill_history(store("features", joined) if store else joined, schemas.MODEL_FEATURES, direction)
    return drop_incomplete(training_frame(labels, features))


def split_rows(frame: DataFrame, train_date: str) -> DataFrame:
    """Rows of the two periods with ``split`` as train, test or oot.

    Train and test have the exact share of each label. ``frame`` should be a stored table.
    """
    tagged = time_split(frame, train_date)
    development = tagged.where(F.col("period") == "train_test").drop("period")
    later = tagged.where(F.col("period") == "oot").drop("period").withColumn("split", F.lit("oot"))
    return stratified_split(development, "label", SPLIT_KEYS).unionByName(later)


def training_set(
    labels: DataFrame,
    engagement: DataFrame,
    risk: DataFrame,
    train_date: str,
    direction: str = "both",
    store: Store | None = None,
) -> DataFrame:
    frame = filled_training_frame(labels, engagement, risk, direction, store)
    return split_rows(store("frame", frame) if store else frame, train_date)


def clickstream_training_set(
    labels: DataFrame, clickstream: DataFrame, train_date: str, store: Store | None = None
) -> DataFrame:
    """The laboratory's variant: labels with the clickstream family, missing features kept."""
    frame = training_frame(labels, clickstream)
    return split_rows(store("frame", frame) if store else frame, train_date)


def window_dates(train_date: str) -> dict[str, str]:
    """The period bounds for a given date, as recorded beside a model."""
    spark = SparkSession.getActiveSession()
    bounds = split_windows(F.lit(train_date).cast("date"))
    return {k: str(v) for k, v in spark.range(1).select(*[c.alias(k) for k, c in bounds.items()]).first().asDict().items()}


def train(
    rows: DataFrame,
    features: list[str],
    model_name: str,
    train_date: str,
    path: str,
    grid: dict[str, list] = modelling.SCHEDULED_GRID,
    draws: int = modelling.DRAWS,
    metric: str = "auc",
    parallelism: int | None = None,
) -> Trained:
    """Search, report and save. ``rows`` should be a stored table: it is read several times."""
    spark = rows.sparkSession
    found = modelling.random_search(
        rows.where(F.col("split") == "train"), features, SPLIT_KEYS, grid, draws, metric=metric, parallelism=parallelism
    )
    modelling.save_model(found.model, path)
    report = modelling.split_report(found.model, rows)
    dates = [str(r.snapshot_date) for r in rows.select("snapshot_date").distinct().orderBy("snapshot_date").collect()]
    registry = modelling.registry_row(spark, model_name, train_date, report, found.best, window_dates(train_date), dates, path)
    return Trained(found.model, report, registry, found.trials)


def run(
    spark: SparkSession,
    mart: Datamart,
    train_date: str,
    model_name: str | None = None,
    source: str = "risk",
    grid: dict[str, list] | None = None,
    draws: int = modelling.DRAWS,
    metric: str = "auc",
    direction: str = "both",
    first_snapshot: str | None = None,
    label_def: str = schemas.LABEL_DEFINITION,
    parallelism: int | None = None,
) -> Trained:
    """Train on the stored label and feature tables and register the model.

    The history starts with the first snapshot of the tables, or with ``first_snapshot``.

    ``source`` is ``risk`` (engagement and financial-risk tables, as the scheduled trainer)
    or ``clickstream`` (silver clickstream, as the laboratory).
    """
    name = model_name or "credit_model_" + train_date.replace("-", "_")
    stored = f"{mart.training_sets}/{name}"

    def store(step: str, table: DataFrame) -> DataFrame:
        path = f"{stored}-{step}"
        table.write.mode("overwrite").parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    if source == "clickstream":
        w = window_dates(train_date)
        labels, clicks = (
            snapshot_between(read_all(spark, path), w["train_test_start"], w["oot_end"])
            for path in (mart.label_store, mart.feature_silver("clickstream"))
        )
        rows = clickstream_training_set(labels.where(F.col("label_def") == label_def), clicks, train_date, store)
        features = columns_with_prefix(clicks, schemas.CLICKSTREAM_PREFIX)
        grid = grid or modelling.LAB_GRID
    else:
        day = F.col("snapshot_date")
        wanted = day <= F.lit(train_date).cast("date")
        if first_snapshot:
            wanted = wanted & (day >= F.lit(first_snapshot).cast("date"))
        stores = ((mart.label_store, schemas.LABELS), (mart.engagement, schemas.ENGAGEMENT), (mart.risk, schemas.RISK))
        tables = [read_all(spark, path, schema).where(wanted) for path, schema in stores]
        tables[0] = tables[0].where(F.col("label_def") == label_def)
        if not all(is_usable(t) for t in tables):
            raise ValueError(f"no labels or features up to {train_date}")
        rows = training_set(*tables, train_date, direction, store)
        features = schemas.MODEL_FEATURES
        grid = grid or modelling.SCHEDULED_GRID
    # The joined and filled rows are stored once: scaling, search and report all read them.
    rows.write.mode("overwrite").parquet(stored)
    trained = train(spark.read.schema(rows.schema).parquet(stored), features, name, train_date, mart.model(name), grid, draws, metric, parallelism)
    write_snapshots(trained.registry, mart.registry, ["model_name"])
    scores = trained.registry.select(
        "model_name",
        F.lit(train_date).cast("date").alias("snapshot_date"),
        *[F.col("roc_auc")[s].alias(f"auc_{s}") for s in ("train", "test", "oot")],
    )
    # By model and date: two models of one date stand beside each other.
    write_snapshots(scores, mart.training_metrics, ["model_name", "snapshot_date"])
    return trained


