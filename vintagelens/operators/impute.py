"""Per-snapshot medians and the imputation that uses them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rank error of a median is at most 1 in ACCURACY of the rows.
ACCURACY = 10_000


def snapshot_median(df: DataFrame, value: str, valid: Column | None = None, by: str = "snapshot_date") -> DataFrame:
    """Median element of the valid values of each snapshot.

    The sketch is built map-side, so a snapshot with most of the rows costs one small
    buffer per task, not one big group.
    """
    rows = df.where(F.col(value).isNotNull() if valid is None else valid)
    return rows.groupBy(by).agg(
        F.percentile_approx(value, 0.5, ACCURACY).alias("median"), F.count(F.lit(1)).alias("n_valid")
    )


def with_median(df: DataFrame, value: str, valid: Column | None = None, by: str = "snapshot_date") -> DataFrame:
    """``df`` plus the ``median`` of its snapshot, NULL where the snapshot has no valid value.

    The medians have one row per value of ``by``; Spark broadcasts them where their measured
    size allows it.
    """
    medians = snapshot_median(df, value, valid, by).select(by, "median")
    return df.join(medians, by, "left")


def impute_age(df: DataFrame, lowest: int = 18, highest: int = 100) -> DataFrame:
    """Ages that are missing or out of range take the snapshot's median valid age."""
    in_range = F.col("Age").between(lowest, highest)
    age = F.when(in_range, F.col("Age")).otherwise(F.col("median").cast("int"))
    return with_median(df, "Age", in_range).withColumn("Age", age).drop("median")


def impute_limit(df: DataFrame, column: str = "Changed_Credit_Limit") -> DataFrame:
    """Missing limits take the snapshot's median; all are rounded to two places."""
    filled = F.coalesce(F.col(column).cast("double"), F.col("median").cast("double"))
    return with_median(df, column).withColumn(column, F.round(filled, 2)).drop("median")
