"""Standard scaling with population deviation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scaler_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with ``mean_<c>`` and ``std_<c>`` per column; NULLs and NaNs are ignored."""
    present = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    return df.agg(
        *[F.avg(v).alias(f"mean_{c}") for c, v in present.items()],
        *[F.stddev_pop(v).alias(f"std_{c}") for c, v in present.items()],
    )


def scaler_fit(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same parameters, one row per column."""
    row = scaler_row(df, columns)
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"))
        for c in columns
    ]
    return row.select(F.inline(F.array(*entries)))


def scaled(value: Column, mean: Column, std: Column) -> Column:
    """``(value - mean) / std``; a column that was constant in training is only centred."""
    return (value - mean) / F.when(std == 0, 1.0).otherwise(std)


def scaler_transform(df: DataFrame, fitted_on: DataFrame, columns: list[str]) -> DataFrame:
    """Scale ``columns`` by the parameters of ``fitted_on``; NULLs pass through.

    The parameters, two numbers per column, enter as a scalar subquery.
    """
    parameters = scaler_row(fitted_on, columns)
    packed = parameters.select(F.struct(*parameters.columns)).scalar()
    p = F.col("_scaler")
    return df.withColumn("_scaler", packed).select(
        *[
            scaled(F.col(c), p[f"mean_{c}"], p[f"std_{c}"]).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )
