"""Loan ledger to label store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.functions.delinquency import label_definition
from vintagelens.operators import silver
from vintagelens.plans.datamart import Datamart
from vintagelens.sources.feeds import FILE, bronze, read_feed, sort_out
from vintagelens.sources.snapshots import read_all, snapshot_between, write_snapshots


def label_store(ledger: DataFrame, days: int = 30, months_on_book: int = 6) -> DataFrame:
    """Labels of all snapshots in the ledger, one pass and no shuffle."""
    return silver.labels(silver.loans(ledger), days, months_on_book)


def ingest_loans(
    spark: SparkSession, feed: str, mart: Datamart, start: str, end: str, quarantine: bool = False
) -> None:
    """Bronze of a period. With ``quarantine``, rows with text that does not parse go to a side table."""
    if not quarantine:
        write_snapshots(bronze(read_feed(spark, feed), start, end), mart.loan_bronze, period=(start, end))
        return
    kept, held = sort_out(read_feed(spark, feed, with_file=True), schemas.LOAN_TYPES)
    write_snapshots(bronze(kept, start, end).drop(FILE), mart.loan_bronze, period=(start, end))
    # By file, so that a file that comes again replaces its rows. The date may be what is wrong.
    held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(mart.quarantine("lms"))


def write_labels(labels: DataFrame, path: str, definition: str, start: str, end: str) -> None:
    """Replace the labels of one definition in the period; other definitions stay beside them."""
    write_snapshots(labels, path, ["label_def", "snapshot_date"], period=(start, end), within={"label_def": definition})


def run(
    spark: SparkSession,
    feed: str,
    mart: Datamart,
    start: str,
    end: str,
    days: int = 30,
    months_on_book: int = 6,
    quarantine: bool = False,
) -> DataFrame:
    """Bronze, silver and label store of a period; other snapshots stay as they are.

    Each stage reads what the stage before it wrote, so a failed stage restarts alone.
    """
    ingest_loans(spark, feed, mart, start, end, quarantine)
    ledger = snapshot_between(read_all(spark, mart.loan_bronze, schemas.LOAN_BRONZE), start, end)
    write_snapshots(silver.loans(ledger), mart.loan_silver, rebalance=False, period=(start, end))
    loans = snapshot_between(read_all(spark, mart.loan_silver), start, end)
    definition = label_definition(days, months_on_book)
    write_labels(silver.labels(loans, days, months_on_book), mart.label_store, definition, start, end)
    stored = read_all(spark, mart.label_store, schemas.LABELS).where(F.col("label_def") == definition)
    return snapshot_between(stored, start, end)
