"""Carried fills, stored baselines, the resumable backfill, quarantine and two-phase writes."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from vintagelens import cli, schemas
from vintagelens.operators import drift, fills
from vintagelens.operators.silver import labels, loans
from vintagelens.plans import backfill, history, label_store, monitoring
from vintagelens.plans.datamart import Datamart
from vintagelens.sources import feeds, snapshots
from vintagelens.sources.derived import derive

MONTHS = [dt.date(2023, m, 1) for m in range(1, 9)]


def as_list(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


def gappy(spark, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(400):
        values = [draw.choice([None, None, 0.0, round(draw.random(), 3)]) for _ in range(2)]
        rows.append((draw.choice(["c1", "c2", "c3", "c4", None]), draw.choice(MONTHS), *values))
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, a double, b double")


@pytest.mark.parametrize("cuts", [[8], [1, 2, 3, 4, 5, 6, 7, 8], [3, 8], [2, 2, 8]])
def test_carried_fill_equals_the_fill_of_the_whole(spark, cuts):
    rows, columns = gappy(spark, 4), ["a", "b"]
    whole = fills.fill_history(rows, columns, "forward")
    state, parts, first = None, [], 0
    for last in cuts:  # a period without snapshots as well
        period = rows.where(F.col("snapshot_date").isin(MONTHS[first:last]) if last > first else F.lit(False))
        filled, state = fills.carry_forward(period, state, columns)
        state = spark.createDataFrame(state.collect(), state.schema)
        parts += filled.collect()
        first = last
    assert sorted(map(str, parts)) == as_list(whole, rows.columns)
    known = fills.fill_history(rows.unionByName(state.select("Customer_ID", F.lit(dt.date(2024, 1, 1)).alias("snapshot_date"), "a", "b")), columns, "forward")
    assert as_list(known.where("snapshot_date = '2024-01-01'"), ["Customer_ID", "a", "b"]) == as_list(state, ["Customer_ID", "a", "b"])


def test_carried_plan_reads_the_month_and_the_state_only(spark, sf_dir, tmp_path):
    mart = Datamart(str(tmp_path))
    engagement, risk = derive(spark, sf_dir, "engagement"), derive(spark, sf_dir, "cust_fin_risk")
    days = sorted(r[0] for r in engagement.select("snapshot_date").distinct().collect())[:4]
    for path, df in ((mart.engagement, engagement), (mart.risk, risk)):
        snapshots.write_snapshots(df.where(F.col("snapshot_date").isin(days)), path)
    got = [history.run(spark, mart, str(day)).collect() for day in days]
    joined = history.model_features(engagement, risk, "engagement").where(F.col("snapshot_date").isin(days))
    whole = fills.fill_history(joined, schemas.MODEL_FEATURES, "forward")
    columns = [*schemas.KEYS, *schemas.MODEL_FEATURES]
    rows = [str(tuple(r[c] for c in columns)) for month in got for r in month]
    assert sorted(rows) == sorted(str(tuple(r)) for r in whole.select(*columns).collect())
    # A rerun of the second month: later states rest on it and are gone.
    history.run(spark, mart, str(days[1]))
    left = snapshots.read_all(spark, mart.fill_state).select("snapshot_date").distinct().collect()
    assert sorted(r[0] for r in left) == days[:2]
    cli.main(["--datamart", mart.root, "fill", "--start", str(days[2]), "--end", str(days[3])])
    assert as_list(snapshots.read_all(spark, mart.filled_features, schemas.JOINED), columns) == as_list(whole, columns)


def test_psi_from_baselines_equals_psi_from_predictions(spark, sf_dir):
    predictions = derive(spark, sf_dir, "predictions")
    flat = F.when(F.col("snapshot_date") == dt.date(2023, 5, 1), 0.5).otherwise(F.col("model_predictions"))
    for rows in (predictions, predictions.withColumn("model_predictions", flat)):
        stored = drift.baselines(rows, ["model_name"])
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        key = lambda r: (r.model_name, r.snapshot_date)
        want = {key(r): r.psi for r in drift.psi_by_snapshot(rows, ["model_name"]).collect()}
        got = {key(r): r.psi for r in drift.psi_from_baselines(rows, stored, ["model_name"]).collect()}
        assert got.keys() == want.keys()
        assert all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-12) for k, v in want.items())


def test_monitoring_reads_no_predictions_of_the_month_before(spark, sf_dir, tmp_path):
    mart = Datamart(str(tmp_path))
    predictions = derive(spark, sf_dir, "predictions")
    snapshots.write_snapshots(derive(spark, sf_dir, "label_store"), mart.label_store, ["label_def", "snapshot_date"])
    snapshots.write_snapshots(predictions, mart.predictions, ["model_name", "snapshot_date"])
    want = {str(r.snapshot_date): r for r in monitoring.run(spark, mart, "m1", "2023-02-01", "2023-07-01").collect()}
    assert len(want) == 6
    # The month before is gone; its baseline is not.
    nothing = predictions.where("false")
    snapshots.write_snapshots(nothing, mart.predictions, ["model_name", "snapshot_date"], period=("2023-04-01", "2023-04-01"))
    snapshots.write_snapshots(predictions.where("false").select("model_name", "snapshot_date", F.lit(0.0).alias("predict_psi")), mart.monitor, ["model_name", "snapshot_date"], period=("2023-05-01", "2023-05-01"))
    again = {str(r.snapshot_date): r for r in monitoring.run(spark, mart, "m1", "2023-05-01").collect()}
    assert again["2023-05-01"] == want["2023-05-01"] and again.keys() == want.keys()


def test_binned_density_is_within_its_bound(spark):
    draw = random.Random(2)
    rows = [(g, draw.gauss(0, s) if g != "two" else float(draw.randrange(2))) for g, s in (("n", 1.0), ("wide", 900.0), ("two", 0)) for _ in range(800)]
    rows += [("one", 0.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    exact = {(r.g, r.point): r for r in drift.score_density(df, ["g"], "x").collect()}
    for per in (50, 1_000):
        got = {(r.g, r.point): r for r in drift.score_density_binned(df, ["g"], "x", per_bandwidth=per).collect()}
        assert got.keys() == exact.keys()
        for key, r in exact.items():
            step = exact[key[0], 1].score - exact[key[0], 0].score
            values = [x for g, x in rows if g == key[0]]
            mean = sum(values) / len(values)
            h = math.sqrt(sum((x - mean) ** 2 for x in values) / (len(values) - 1)) * len(values) ** -0.2
            assert abs(got[key].density - r.density) <= 0.05 / (h * per * per) + 1e-12 and abs(got[key].score - r.score) < 1e-9 * max(1, abs(step))


def test_backfill_goes_on_where_it_stopped(spark, sf_dir, tmp_path, monkeypatch):
    mart, ledger = Datamart(str(tmp_path)), derive(spark, sf_dir, "loan_snapshots").cache()
    start, end = "1997-01-01", "1997-06-01"
    days = [dt.date(1997, m, 1) for m in range(1, 7)]
    assert backfill.run(ledger, mart, start, "1997-03-01", stages=["bronze"]) == {"bronze": days[:3]}

    def dies(rows, *_):
        raise RuntimeError("executor gone")

    with monkeypatch.context() as broken:
        broken.setattr(backfill.silver, "labels", dies)
        with pytest.raises(RuntimeError):
            backfill.run(ledger, mart, start, "1997-04-01")
    assert backfill.run(ledger, mart, start, end) == {"bronze": days[4:], "silver": days[4:], "labels": days}
    assert backfill.run(ledger, mart, start, end) == {"bronze": [], "silver": [], "labels": []}
    # One snapshot arrives anew, one no longer.
    changed = ledger.where(F.col("snapshot_date") != days[4]).withColumn(
        "overdue_amt", F.when(F.col("snapshot_date") == days[1], F.lit(0).cast("float")).otherwise(F.col("overdue_amt"))
    )
    did = backfill.run(changed, mart, start, end)
    assert did["bronze"] == [days[1]] and did["silver"] == [days[1]] and set(did["labels"]) <= {days[1]}
    period = changed.where(F.col("snapshot_date").between(start, end))
    got = snapshots.read_all(spark, mart.label_store, schemas.LABELS)
    assert as_list(got, schemas.LABEL_COLUMNS) == as_list(labels(loans(period)), schemas.LABEL_COLUMNS)


def test_fingerprints(spark):
    rows = [(dt.date(2024, 1, 1), "a", None), (dt.date(2024, 1, 1), None, "a"), (dt.date(2024, 2, 1), "a", None)]
    schema = "snapshot_date date, x string, y string"
    marks = lambda r: {x.snapshot_date: x.fingerprint for x in backfill.fingerprints(spark.createDataFrame(r, schema)).collect()}
    assert marks(rows) == marks(rows[::-1])
    assert marks(rows[:1]) != marks(rows[1:2]) and marks(rows[:1] * 2) != marks(rows[:1])


def test_quarantine_holds_every_row_that_does_not_parse(spark, tmp_path):
    lines = ["loan_id,tenure,due_amt,snapshot_date", "1,10,1.5,2024-01-01", "2,ten,x,2024-01-01", "3,,,2024-01-01", '4,10,2,"2024-13-01"', "5,7,1,"]
    (tmp_path / "feed.csv").write_text("\n".join(lines) + "\n")
    types = {"loan_id": "string", "tenure": "int", "due_amt": "float", "snapshot_date": "date"}
    kept, held = feeds.sort_out(feeds.read_feed(spark, str(tmp_path / "feed.csv"), with_file=True), types)
    assert sorted(r.loan_id for r in kept.collect()) == ["1", "3", "5"]
    found = {r.loan_id: (r.file, r.line, r.reasons) for r in held.collect()}
    assert found == {
        "2": ("feed.csv", "2,ten,x,2024-01-01", ["tenure: ten", "due_amt: x"]),
        "4": ("feed.csv", "4,10,2,2024-13-01", ["snapshot_date: 2024-13-01"]),
    }


def test_quarantine_in_the_plan(spark, sf_dir, tmp_path):
    mart, feed = Datamart(f"{tmp_path}/mart"), f"{tmp_path}/feed"
    raw = derive(spark, sf_dir, "loan_feed")
    raw.write.option("header", True).csv(feed)
    for _ in range(2):  # a second run replaces the rows of the same files
        label_store.ingest_loans(spark, feed, mart, "1980-01-01", "2030-01-01", quarantine=True)
    kept, held = snapshots.read_all(spark, mart.loan_bronze), snapshots.read_all(spark, mart.quarantine("lms"))
    assert kept.count() + held.count() == raw.count() and held.count() > 0
    assert held.where("size(reasons) = 0 or file is null").isEmpty()
    assert set(kept.columns) == set(raw.columns)


COLUMNS = ["model_name", "snapshot_date"]


def table(spark, values):
    rows = [(f"m{m}", dt.date(2024, d, 1), float(v)) for m, d, v in values]
    return spark.createDataFrame(rows, "model_name string, snapshot_date date, x double")


def content(spark, path):
    return sorted((r.model_name, r.snapshot_date.month, r.x) for r in snapshots.read_all(spark, path).collect())


WHOLE = ("2024-01-01", "2024-12-01")


@pytest.mark.parametrize("dies_after", [None, 0, 1, 2, 3])
def test_a_write_that_dies_leaves_no_mixed_period(spark, tmp_path, monkeypatch, dies_after):
    path = str(tmp_path / "table")
    snapshots.write_snapshots(table(spark, [(1, 1, 1), (1, 2, 1), (1, 3, 1), (2, 1, 1)]), path, COLUMNS, period=WHOLE)
    before = content(spark, path)
    new = table(spark, [(1, 1, 2), (1, 4, 2), (1, 5, 2)])
    if dies_after is None:  # before the intent is recorded
        with monkeypatch.context() as broken:
            broken.setattr(snapshots._Files, "write", lambda *a: (_ for _ in ()).throw(OSError("gone")))
            with pytest.raises(OSError):
                snapshots.write_snapshots(new, path, COLUMNS, period=WHOLE, within={"model_name": "m1"})
        assert content(spark, path) == before and snapshots.recover(spark, path) == 0
        assert content(spark, path) == before
        return
    moves = [0]

    def dying(kind):
        real = getattr(snapshots._Files, kind)

        def call(self, *args):
            if args[0].find("snapshot_date=") >= 0 and kind == "replace":
                moves[0] += 1
                if moves[0] > dies_after:
                    raise OSError("gone")
            return real(self, *args)

        return call

    with monkeypatch.context() as broken:
        broken.setattr(snapshots._Files, "replace", dying("replace"))
        if dies_after < 3:
            with pytest.raises(OSError):
                snapshots.write_snapshots(new, path, COLUMNS, period=WHOLE, within={"model_name": "m1"})
        else:
            snapshots.write_snapshots(new, path, COLUMNS, period=WHOLE, within={"model_name": "m1"})
    assert snapshots.recover(spark, path) == (1 if dies_after < 3 else 0)
    assert content(spark, path) == [("m1", 1, 2.0), ("m1", 4, 2.0), ("m1", 5, 2.0), ("m2", 1, 1.0)]
    assert snapshots.recover(spark, path) == 0


def test_the_next_write_finishes_the_last(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshots(table(spark, [(1, 1, 1), (1, 2, 1)]), path, COLUMNS, period=WHOLE)
    snapshots.stage(table(spark, [(1, 1, 2)]), path, COLUMNS, WHOLE)
    snapshots.write_snapshots(table(spark, [(2, 7, 3)]), path, COLUMNS, period=WHOLE, within={"model_name": "m2"})
    assert content(spark, path) == [("m1", 1, 2.0), ("m2", 7, 3.0)]
