from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintagelens.operators import rows
from vintagelens.operators.monitoring import with_history
from vintagelens.sources import feeds, snapshots
from vintagelens.sources.calendar import month_range, month_starts, snapshot_calendar
from vintagelens.sources.derived import derive

FEED = """Customer_ID,value,snapshot_date
007,3_,2023-01-01
8,,2023-02-01
9,"a, b",2023-02-01
10,x,not a date
11,y,2023-04-01
"""


@pytest.fixture
def feed(tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    return str(path)


def test_feed_keeps_text(spark, feed):
    df = feeds.read_feed(spark, feed)
    assert set(dict(df.dtypes).values()) == {"string"}
    assert sorted((r.Customer_ID, r.value) for r in df.collect())[:2] == [("007", "3_"), ("10", "x")]


def test_feed_file_with_other_columns_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_feed(spark, str(tmp_path)).collect()


def test_bronze_period_is_the_union_of_its_snapshots(spark, feed):
    raw = feeds.read_feed(spark, feed)
    period = sorted(map(tuple, feeds.bronze(raw, "2023-01-01", "2023-03-01").collect()), key=str)
    single = [tuple(r) for m in month_range("2023-01-01", "2023-03-01") for r in feeds.bronze(raw, str(m), str(m)).collect()]
    assert period == sorted(single, key=str) and len(period) == 3
    typed = raw.withColumn("snapshot_date", F.lit(dt.date(2023, 1, 1)))
    assert feeds.bronze(typed, "2023-01-01", "2023-01-01").count() == 5


def table(spark, *pairs):
    return spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in pairs], "snapshot_date date, v int")


def test_rerun_replaces_its_snapshots_only(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshots(table(spark, ("2023-01-01", 1), ("2023-02-01", 2)), path)
    for _ in range(2):
        snapshots.write_snapshots(table(spark, ("2023-02-01", 20), ("2023-03-01", 3)), path)
    assert sorted(r.v for r in snapshots.read_all(spark, path).collect()) == [1, 3, 20]
    assert [r.v for r in snapshots.read_one(spark, path, "2023-02-01").collect()] == [20]
    listed = snapshots.read_listed(spark, path, ["2022-12-01", "2023-01-01", "2023-03-01"])
    assert sorted(r.v for r in listed.collect()) == [1, 3]
    assert snapshots.read_listed(spark, path, ["2022-12-01"]).isEmpty()
    schema = table(spark).schema
    assert snapshots.read_all(spark, path, schema).schema["snapshot_date"].dataType == schema["snapshot_date"].dataType


def test_calendar(spark):
    assert len(month_range("2023-01-01", "2024-12-01")) == 24
    assert month_range("2023-01-15", "2023-02-28") == [dt.date(2023, 1, 1), dt.date(2023, 2, 1)]
    gap = snapshot_calendar(table(spark, ("2023-01-15", 1), ("2023-04-01", 2)), "snapshot_date")
    assert [str(r.snapshot_date) for r in gap.collect()] == ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01"]
    none = spark.range(1).select(month_starts(F.lit("2023-03-01").cast("date"), F.lit("2023-01-01").cast("date")).alias("m"))
    assert none.first().m is None


def test_history_replaces_a_rerun(spark):
    old = spark.createDataFrame([("m", "2023-01-01", 0.1), ("m", "2023-02-01", 0.2)], "model_name string, snapshot_date string, predict_psi double")
    new = spark.createDataFrame([("m", "2023-02-01", 0.3, 0.7)], "model_name string, snapshot_date string, predict_psi double, roc_auc double")
    got = sorted(map(tuple, with_history(old, new).collect()))
    assert got == [("m", "2023-01-01", 0.1, None), ("m", "2023-02-01", 0.3, 0.7)]


def test_usable(spark):
    assert not rows.is_usable(None) and not rows.is_usable(table(spark)) and rows.is_usable(table(spark, ("2023-01-01", 1)))


def test_fill_numeric_zero_leaves_text_and_dates(spark):
    df = spark.createDataFrame([(None, None, None, None)], "i int, f float, s string, d date")
    assert tuple(rows.fill_numeric_zero(df).first()) == (0, 0.0, None, None)
    assert rows.fill_numeric_zero(df).dtypes == df.dtypes


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, 2.0), (0, None), (None, 3.0)], "label int, x double")
    assert [tuple(r) for r in rows.drop_incomplete(df).collect()] == [(1, 2.0)]


def test_derived_tables_have_unique_keys(spark, sf_dir):
    for name in ("attributes_raw", "financials_raw", "clickstream_raw", "engagement", "cust_fin_risk", "label_store", "predictions"):
        df = derive(spark, sf_dir, name)
        assert df.count() == df.select("Customer_ID", "snapshot_date").distinct().count() > 0
