from __future__ import annotations

from pyspark.sql import functions as F

from vintagelens.operators import impute, silver


def test_age_takes_the_median_of_its_snapshot(spark):
    rows = [("a", "20"), ("a", "30"), ("a", "40"), ("a", "50_"), ("a", "8698"), ("a", None), ("b", "60"), ("b", "-500"), ("c", "17"), ("c", None)]
    month = {"a": "2023-01-01", "b": "2023-02-01", "c": "2023-03-01"}
    raw = spark.createDataFrame([(str(i), age, "x", "_____", month[s]) for i, (s, age) in enumerate(rows)],
                                "Customer_ID string, Age string, SSN string, Occupation string, snapshot_date string")
    got = {int(r.Customer_ID): r.Age for r in silver.attributes(raw).collect()}
    assert [got[i] for i in range(10)] == [20, 30, 40, 50, 30, 30, 60, 60, None, None]
    quality = {str(r.snapshot_date): r for r in silver.attribute_quality(raw).collect()}
    assert quality["2023-01-01"].n_age_out_of_range == 1 and quality["2023-01-01"].n_ssn_malformed == 6
    assert quality["2023-03-01"].n_occupation_unknown == 2


def test_median_is_close_on_many_values(spark):
    n = 200_001
    df = spark.range(n).select(F.lit("s").alias("snapshot_date"), ((F.col("id") * 7919) % n).alias("v"))
    median = impute.snapshot_median(df, "v").first().median
    assert abs(median - n // 2) <= n / impute.ACCURACY + 1


def test_limit_is_rounded(spark):
    df = spark.createDataFrame([("s", 3.45), ("s", None), ("s", 9.999), ("t", None)], "snapshot_date string, Changed_Credit_Limit float")
    got = sorted(impute.impute_limit(df).collect(), key=str)
    assert [(r.snapshot_date, r.Changed_Credit_Limit) for r in got] == [("s", 10.0), ("s", 3.45), ("s", 3.45), ("t", None)]
