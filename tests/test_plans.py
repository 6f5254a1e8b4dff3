"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from checks.queries import QUERIES
from vintagelens import schemas
from vintagelens.operators import drift, fills, splits
from vintagelens.plans import label_store
from vintagelens.sources.derived import derive
from vintagelens.sources.snapshots import read_all, read_listed, read_one, write_snapshots

# Queries that train or store something before they return.
JOBS = {
    "train_gbt", "random_search", "split_auc", "feature_importance", "model_registry",
    "score_snapshot", "score_backfill", "train_pipeline", "score_pipeline", "score_backfill_keys", "split_auc_counts",
    "feature_importance_sum",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_python_rows_and_no_unkeyed_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in text


def test_fill_runs_no_job_before_it_is_asked_to(spark, sf_dir, tmp_path):
    write_snapshots(derive(spark, sf_dir, "cust_fin_risk"), str(tmp_path))
    rows = read_all(spark, str(tmp_path))
    spark.sparkContext.setJobGroup("fill", "fill")
    text = plan(fills.fill_history(rows, schemas.RISK_FEATURES))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("fill")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The window runs over rows that a grouping by customer and date has reduced.
    assert "Window" in text and text.index("Window") < text.index("HashAggregate(keys=[Customer_ID")


def test_label_store_does_not_shuffle_its_ledger(spark, sf_dir, tmp_path):
    write_snapshots(derive(spark, sf_dir, "loan_snapshots"), str(tmp_path))
    assert "Exchange" not in plan(label_store.label_store(read_all(spark, str(tmp_path))))


def test_threshold_split_does_not_shuffle(spark, sf_dir):
    from pyspark.sql import functions as F

    loans = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("label", F.lit(1))
    assert "Exchange" not in plan(splits.hash_split(loans, ["l_orderkey", "l_linenumber"]))


def test_snapshot_reads_prune_partitions_and_columns(spark, sf_dir, tmp_path):
    path = str(tmp_path)
    write_snapshots(derive(spark, sf_dir, "predictions"), path)
    for df in (read_one(spark, path, "2023-02-01"), read_listed(spark, path, ["2023-02-01", "2023-03-01"])):
        text = df.select("model_predictions")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert "PartitionFilters: [isnotnull(snapshot_date" in text or "PartitionFilters: [snapshot_date" in text
        assert "ReadSchema: struct<model_predictions:double>" in text
    split = splits.time_split(read_all(spark, path), "2024-09-01")
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan(split)


def test_drift_counts_its_cells_once(spark, sf_dir, tmp_path):
    write_snapshots(derive(spark, sf_dir, "predictions"), str(tmp_path))
    df = drift.psi_by_snapshot(read_all(spark, str(tmp_path)), ["model_name"])
    df.collect()
    assert "ReusedExchange" in plan(df)
