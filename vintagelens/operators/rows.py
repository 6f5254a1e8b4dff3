"""Row-level operators: projections, filters, fills and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """0 for NULL in every numeric column; text and dates are left alone."""
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, NumericType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def select_by_prefix(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, *columns_with_prefix(df, prefix))


def drop_incomplete(df: DataFrame, label: str = "label", subset: list[str] | None = None) -> DataFrame:
    """Labelled rows without any NULL (in ``subset``, if given)."""
    return df.where(F.col(label).isNotNull()).na.drop("any", subset=subset)


def rows_at_instalment(df: DataFrame, instalment: int) -> DataFrame:
    return df.where(F.col("installment_num") == instalment)


def snapshot_counts(stages: dict[str, DataFrame], by: str = "snapshot_date") -> DataFrame:
    """Rows per stage and snapshot."""
    counts = [df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("stage", F.lit(s)) for s, df in stages.items()]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total.select("stage", by, "n_rows")


def counts_where(df: DataFrame, checks: dict[str, Column], by: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot, and how many of them meet each named check, in one aggregation."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(check).alias(name) for name, check in checks.items()]
    )


def top_rows(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """The first ``n`` rows of a stated order, for inspection."""
    return df.orderBy(*order).limit(n)


def is_usable(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def bad_rate_curve(silver: DataFrame, started_before: str, days: int = 30) -> DataFrame:
    """Share of past-due rows per month on book, over loans that started early enough."""
    flag = F.when(F.col("dpd") >= days, 1).otherwise(0)
    return (
        silver.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
        .groupBy("mob")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(flag).alias("n_bad"), F.avg(flag).alias("bad_rate"))
        .orderBy("mob")
    )
