from __future__ import annotations

import inspect

import pytest
from pyspark.sql import functions as F

from checks import queries
from vintagelens import cli, schemas
from vintagelens.operators import modelling, silver
from vintagelens.plans import feature_store, label_store, monitoring, scoring, training
from vintagelens.plans.datamart import Datamart
from vintagelens.sources.derived import derive
from vintagelens.sources.snapshots import read_all, write_snapshots

GRID = {"n_estimators": [2], "max_depth": [2, 3], "learning_rate": [0.1], "colsample_bytree": [0.6], "gamma": [0, 0.1]}
TRAIN_DATE = "2024-09-01"


@pytest.fixture(scope="module")
def mart(tmp_path_factory):
    return Datamart(str(tmp_path_factory.mktemp("mart")))


@pytest.fixture(scope="module")
def feeds(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    names = {"loans": "loan_feed", "attributes": "attributes_raw", "financials": "financials_raw", "clickstream": "clickstream_raw"}
    for name, table in names.items():
        derive(spark, sf_dir, table).write.option("header", True).csv(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in names}


@pytest.fixture(scope="module")
def model_mart(spark, sf_dir, mart):
    for path, table in ((mart.label_store, "label_store"), (mart.engagement, "engagement"), (mart.risk, "cust_fin_risk")):
        write_snapshots(derive(spark, sf_dir, table), path)
    write_snapshots(silver.clickstream(derive(spark, sf_dir, "clickstream_raw")), mart.feature_silver("clickstream"))
    return mart


def as_set(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_label_store_backfill_equals_single_months(spark, feeds, tmp_path, sf_dir):
    whole, single = Datamart(f"{tmp_path}/whole"), Datamart(f"{tmp_path}/single")
    got = label_store.run(spark, feeds["loans"], whole, "1997-01-01", "1997-03-01", months_on_book=2)
    for month in ("1997-02-01", "1997-01-01", "1997-03-01", "1997-02-01"):
        label_store.run(spark, feeds["loans"], single, month, month, months_on_book=2)
    assert got.count() > 0 and set(got.columns) == set(schemas.LABEL_COLUMNS)
    assert as_set(got, schemas.LABEL_COLUMNS) == as_set(read_all(spark, single.label_store), schemas.LABEL_COLUMNS)
    direct = label_store.label_store(derive(spark, sf_dir, "loan_feed"), months_on_book=2)
    direct = direct.where(F.col("snapshot_date").between("1997-01-01", "1997-03-01"))
    assert as_set(got, schemas.LABEL_COLUMNS) == as_set(direct, schemas.LABEL_COLUMNS)


def test_feature_store(spark, feeds, tmp_path, sf_dir):
    got = feature_store.run(spark, feeds, Datamart(str(tmp_path)), "2023-01-01", "2025-12-01")
    raw = [derive(spark, sf_dir, t) for t in ("attributes_raw", "financials_raw", "clickstream_raw")]
    direct = feature_store.feature_store(*raw)
    assert set(got.columns) == set(direct.columns) and not set(got.columns) & set(schemas.FEATURE_STORE_DROPS)
    assert as_set(got, direct.columns) == as_set(direct, direct.columns)
    assert 0 < got.where("feature_snapshot_date is not null").count() < got.count()


def test_train_score_monitor(spark, model_mart):
    trained = training.run(spark, model_mart, TRAIN_DATE, "m", grid=GRID, draws=2)
    report = {r.split: r for r in trained.report.collect()}
    assert set(report) == {"train", "test", "oot"}
    assert report["train"].roc_auc > 0.5 and report["train"].gini == pytest.approx(2 * report["train"].roc_auc - 1, abs=5e-4)
    assert trained.trials.count() == 2 and trained.trials.where("best").count() == 1

    registry = read_all(spark, model_mart.registry).first()
    assert registry.model_name == "m" and registry.windows["oot_start"] == "2024-07-01"
    assert registry.n_rows["train"] == report["train"].n_rows and registry.params["max_depth"] in ("2", "3")
    metrics = read_all(spark, model_mart.training_metrics).first()
    assert metrics.auc_train == pytest.approx(report["train"].roc_auc)

    # A reloaded model scores as the one in memory does.
    scored = scoring.run(spark, model_mart, "m", "2024-05-01", "2024-10-01")
    again = scoring.score_snapshots(
        trained.model, "m", read_all(spark, model_mart.engagement), read_all(spark, model_mart.risk), "2024-05-01", "2024-10-01"
    )
    assert as_set(scored, schemas.PREDICTION_COLUMNS) == as_set(again, schemas.PREDICTION_COLUMNS)
    risk = read_all(spark, model_mart.risk).where(F.col("snapshot_date").between("2024-05-01", "2024-10-01"))
    assert scored.count() == risk.count()
    assert scored.where("model_predictions is null or model_predictions < 0 or model_predictions > 1").isEmpty()

    # A backfill holds the rows of single runs.
    one = scoring.run(spark, model_mart, "m", "2024-07-01")
    assert as_set(one, schemas.PREDICTION_COLUMNS) == as_set(
        again.where("snapshot_date = '2024-07-01'"), schemas.PREDICTION_COLUMNS
    )

    history = monitoring.run(spark, model_mart, "m", "2024-06-01", "2024-09-01")
    assert [str(r.snapshot_date) for r in history.collect()] == ["2024-06-01", "2024-07-01", "2024-08-01", "2024-09-01"]
    before = as_set(history, schemas.MONITOR_COLUMNS)
    rerun = monitoring.run(spark, model_mart, "m", "2024-08-01")
    assert as_set(rerun, schemas.MONITOR_COLUMNS) == before


def test_clickstream_variant_by_command_line(spark, model_mart, monkeypatch):
    monkeypatch.setattr(modelling, "LAB_GRID", GRID)
    common = ["--datamart", model_mart.root]
    cli.main([*common, "train", "--snapshotdate", TRAIN_DATE, "--source", "clickstream", "--draws", "1", "--modelname", "c", "--metric", "auc_hard"])
    cli.main([*common, "score", "--snapshotdate", "2024-07-01", "--modelname", "c", "--source", "clickstream"])
    predictions = read_all(spark, model_mart.predictions).where("model_name = 'c'")
    clicks = read_all(spark, model_mart.feature_silver("clickstream")).where("snapshot_date = '2024-07-01'")
    assert predictions.count() == clicks.count() > 0


def test_failures_raise(spark, model_mart):
    with pytest.raises(Exception):
        cli.main(["--datamart", model_mart.root, "score", "--snapshotdate", "2024-07-01", "--modelname", "absent"])
    with pytest.raises(ValueError):
        training.run(spark, model_mart, "2022-06-01", draws=1)


def test_grids():
    assert len(modelling.draw_params(modelling.SCHEDULED_GRID, 100)) == 100
    points = modelling.draw_params(modelling.LAB_GRID, 10**6)
    assert len(points) == 192 and len({str(p) for p in points}) == 192
    assert modelling.draw_params(modelling.LAB_GRID, 5) == modelling.draw_params(modelling.LAB_GRID, 5)


def test_importances_are_sorted(spark, sf_dir):
    rows = training.training_set(*[derive(spark, sf_dir, t) for t in ("label_store", "engagement", "cust_fin_risk")], TRAIN_DATE)
    model = modelling.fit(rows, schemas.MODEL_FEATURES, {"n_estimators": 2, "max_depth": 2})
    weights = [r.importance for r in modelling.feature_importance(spark, model, schemas.MODEL_FEATURES).collect()]
    assert len(weights) == 17 and weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1)


def test_rerun_leaves_no_label_that_has_gone(spark, sf_dir, tmp_path):
    labels, path = derive(spark, sf_dir, "label_store"), str(tmp_path)
    days = sorted(r[0] for r in labels.select("snapshot_date").distinct().collect())
    period = (str(days[0]), str(days[-2]))
    label_store.write_labels(labels, path, "30dpd_6mob", str(days[0]), str(days[-1]))
    label_store.write_labels(labels.withColumn("label_def", F.lit("30dpd_3mob")), path, "30dpd_3mob", *map(str, days[::len(days) - 1]))
    fewer = labels.where(~F.col("snapshot_date").isin(days[1], days[-1]))
    label_store.write_labels(fewer, path, "30dpd_6mob", *period)
    left = {(r.label_def, r.snapshot_date) for r in read_all(spark, path).select("label_def", "snapshot_date").distinct().collect()}
    # The last snapshot is outside of the period that was run again.
    assert left == {("30dpd_3mob", d) for d in days} | {("30dpd_6mob", d) for d in days if d != days[1]}


def test_train_pipeline_searches_with_all_draws(spark, sf_dir, monkeypatch):
    """The whole search of the scheduled trainer; no fit is run here."""
    asked = {}

    class Asked(Exception):
        pass

    def train(*args, **more):
        asked.update(inspect.signature(real).bind(*args, **more).arguments)
        raise Asked

    real = training.train
    monkeypatch.setattr(training, "train", train)
    with pytest.raises(Asked):
        queries.QUERIES["train_pipeline"](spark, sf_dir)
    assert asked.get("draws", modelling.DRAWS) == modelling.DRAWS == 100
    assert asked.get("grid", modelling.SCHEDULED_GRID) == modelling.SCHEDULED_GRID
