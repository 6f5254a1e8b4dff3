from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from vintagelens.operators import scaling, splits


def test_scaler(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("nan"), 5.0)], "a double, k double")
    fitted = {r.feature: (r.mean, r.std) for r in scaling.scaler_fit(train, ["a", "k"]).collect()}
    assert fitted == {"a": (2.0, 1.0), "k": (5.0, 0.0)}
    new = spark.createDataFrame([("x", 4.0, 7.0), ("y", None, 5.0)], "id string, a double, k double")
    assert sorted(map(tuple, scaling.scaler_transform(new, train, ["a", "k"]).collect())) == [("x", 2.0, 2.0), ("y", None, 0.0)]


def test_single_row_scales_to_zero(spark):
    one = spark.createDataFrame([(4.0,)], "a double")
    assert scaling.scaler_transform(one, one, ["a"]).first().a == 0.0


def test_windows(spark):
    w = splits.split_windows(F.lit("2024-09-01").cast("date"))
    got = spark.range(1).select(*[c.alias(n) for n, c in w.items()]).first().asDict()
    assert {k: str(v) for k, v in got.items()} == {
        "oot_start": "2024-07-01", "oot_end": "2024-08-31",
        "train_test_start": "2023-07-01", "train_test_end": "2024-06-30",
    }


def test_time_split_is_complete_and_disjoint(spark):
    days = [dt.date(2023, 6, 30) + dt.timedelta(days=i) for i in range(430)]
    df = spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    got = {r.snapshot_date: r.period for r in splits.time_split(df, "2024-09-01").collect()}
    for d in days:
        inside = dt.date(2023, 7, 1) <= d <= dt.date(2024, 8, 31)
        assert (d in got) == inside
        if inside:
            assert got[d] == ("oot" if d >= dt.date(2024, 7, 1) else "train_test")


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(5000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 5 == 0).cast("int").alias("label"))


def test_exact_split_sizes(labelled):
    got = splits.stratified_split(labelled, "label", ["id"])
    counts = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert counts == {(0, "train"): 3200, (0, "test"): 800, (1, "train"): 800, (1, "test"): 200}


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_exact_split_of_few_rows(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("label"))
    got = splits.stratified_split(df, "label", ["id"])
    assert got.count() == n
    assert got.where("split = 'train'").count() == n - math.ceil(n * 0.2 - 1e-9)


def test_splits_do_not_depend_on_partitioning(labelled):
    for split in (lambda d: splits.stratified_split(d, "label", ["id"]), lambda d: splits.hash_split(d, ["id"])):
        one = {r.id: r.split for r in split(labelled.repartition(1)).collect()}
        many = {r.id: r.split for r in split(labelled.repartition(7)).collect()}
        assert one == many and len(one) == 5000


def test_threshold_split_is_close_and_seeded(labelled):
    got = splits.hash_split(labelled, ["id"])
    for label in (0, 1):
        rows = got.where(F.col("label") == label)
        assert rows.where("split = 'train'").count() / rows.count() == pytest.approx(0.8, abs=0.03)
    other = splits.hash_split(labelled, ["id"], seed=1)
    assert got.join(other.withColumnRenamed("split", "other"), "id").where("split != other").count() > 0


def test_hot_key_stays_on_one_side(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.lit(0).alias("label")
    )
    got = splits.stratified_split(df, "label", ["id"])
    assert got.count() == 300 and got.where("id = 'hot'").select("split").distinct().count() == 1


def test_folds_have_even_counts_of_each_label(spark):
    rows = [(f"k{i}", int(i % 11 == 0)) for i in range(500)] + [("alone", 7)]
    df = spark.createDataFrame(rows, "key string, label int")
    folded = splits.stratified_folds(df, "label", ["key"], 3)
    counts = {}
    for r in folded.groupBy("label", "fold").count().collect():
        counts.setdefault(r.label, {})[r.fold] = r["count"]
    assert set(counts[0]) == set(counts[1]) == {0, 1, 2} and sum(counts[7].values()) == 1
    assert all(max(c.values()) - min(c.values()) <= 1 for k, c in counts.items() if k != 7)
    again = splits.stratified_folds(df.repartition(5), "label", ["key"], 3)
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, again.collect()))


def test_rows_of_a_label_do_not_meet_in_one_task(spark):
    rows = spark.range(0, 40_000, 1, 8).selectExpr("id", "cast(id % 2 as int) as label", "repeat(cast(id as string), 20) as wide")
    tagged = splits.stratified_folds(rows, "label", ["id"], 3).persist()
    try:
        sizes = [r["count"] for r in tagged.groupBy(F.spark_partition_id()).count().collect()]
        counts = {(r.label, r.fold): r["count"] for r in tagged.groupBy("label", "fold").count().collect()}
    finally:
        tagged.unpersist()
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * 40_000 / 8
    assert len(counts) == 6 and set(counts.values()) <= {6_666, 6_667}
