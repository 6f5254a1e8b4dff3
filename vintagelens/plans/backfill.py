"""Resumable backfill of the label store: a ledger of what has been done from which input.

For every stage and snapshot the ledger holds a fingerprint of the input: its number of rows and
the sum of their hashes, which no order of rows changes. A restarted period takes up the snapshots
that are not in the ledger or whose input has changed, all of them in one job a stage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens.functions.delinquency import label_definition
from vintagelens.operators import silver
from vintagelens.plans.datamart import Datamart
from vintagelens.sources.feeds import bronze
from vintagelens.sources.snapshots import read_all, snapshot_between, write_snapshots

LEDGER = "fingerprint string, stage string, snapshot_date date"
STAGES = ["bronze", "silver", "labels"]


def fingerprints(rows: DataFrame) -> DataFrame:
    """snapshot_date and fingerprint of the rows of each snapshot, equal for equal rows in any order."""
    columns = [F.col(c) for c in sorted(rows.columns)]
    # A NULL leaves a hash as it was, so the places of NULLs are hashed as well.
    holes = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    total = F.sum(F.xxhash64(holes, *columns).cast("decimal(38,0)")).cast("string")
    return rows.groupBy("snapshot_date").agg(F.concat_ws("-", F.count(F.lit(1)), total).alias("fingerprint"))


def done(spark: SparkSession, path: str, stage: str, start: str, end: str) -> dict[dt.date, str]:
    try:
        ledger = read_all(spark, path, LEDGER)
    except AnalysisException:  # nothing has been done yet
        return {}
    rows = snapshot_between(ledger.where(F.col("stage") == stage), start, end).collect()  # the calendar's dates
    return {r.snapshot_date: r.fingerprint for r in rows}


def run_stage(
    rows: DataFrame, build, path: str, ledger: str, stage: str, start: str, end: str, columns: list[str], within: dict | None = None
) -> list[dt.date]:
    """Brings one stage of a period up to date with its input; the snapshots that had to be done.

    ``rows`` is the stage's input and ``build`` makes its output of them. A snapshot is entered
    in the ledger after its output has been written.
    """
    spark = rows.sparkSession
    have = done(spark, ledger, stage, start, end)
    now = {r.snapshot_date: r.fingerprint for r in fingerprints(rows).collect()}  # the calendar's dates
    todo = sorted(day for day, mark in now.items() if have.get(day) != mark)
    for day in sorted(set(have) - set(now)):  # snapshots whose input has gone
        nothing = rows.where(F.lit(False))
        write_snapshots(build(nothing), path, columns, period=(day, day), within=within)
        empty = spark.createDataFrame([], LEDGER)
        write_snapshots(empty, ledger, ["stage", "snapshot_date"], period=(day, day), within={"stage": stage})
    if todo:
        write_snapshots(build(rows.where(F.col("snapshot_date").isin(todo))), path, columns)
        entries = spark.createDataFrame([(now[day], stage, day) for day in todo], LEDGER)
        write_snapshots(entries, ledger, ["stage", "snapshot_date"])
    return todo


def run(
    raw: DataFrame,
    mart: Datamart,
    start: str,
    end: str,
    days: int = 30,
    months_on_book: int = 6,
    stages: list[str] = STAGES,
) -> dict[str, list[dt.date]]:
    """Bronze, silver and labels of a period, as far as they are not done; what was done by stage.

    ``raw`` holds the loan feed. Fewer ``stages`` stop the backfill early; a later run goes on.
    """
    spark = raw.sparkSession
    definition = label_definition(days, months_on_book)
    arrived = bronze(raw, start, end)
    did = {}
    for stage in stages:
        if stage == "bronze":
            did[stage] = run_stage(arrived, lambda r: r, mart.loan_bronze, mart.ledger, stage, start, end, ["snapshot_date"])
        elif stage == "silver":
            rows = snapshot_between(read_all(spark, mart.loan_bronze, arrived.schema), start, end)
            did[stage] = run_stage(rows, silver.loans, mart.loan_silver, mart.ledger, stage, start, end, ["snapshot_date"])
        else:
            rows = snapshot_between(read_all(spark, mart.loan_silver), start, end)
            columns, within = ["label_def", "snapshot_date"], {"label_def": definition}
            build = lambda r: silver.labels(r, days, months_on_book)
            name = f"labels-{definition}"
            did[stage] = run_stage(rows, build, mart.label_store, mart.ledger, name, start, end, columns, within)
    return did
