"""The monthly snapshot calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_starts(start: Column, end: Column) -> Column:
    """Array of first-of-month dates from the month of ``start`` up to ``end`` inclusive.

    NULL if ``end`` lies before the month of ``start``.
    """
    first = F.trunc(start, "MM")
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))


def snapshot_calendar(df: DataFrame, date_column: str) -> DataFrame:
    """Every month the table covers, one row each, whether or not it has rows."""
    bounds = df.agg(F.min(date_column).cast("date").alias("lo"), F.max(date_column).cast("date").alias("hi"))
    return bounds.select(F.explode(month_starts(F.col("lo"), F.col("hi"))).alias("snapshot_date"))


def month_range(start: str, end: str) -> list[dt.date]:
    """The same calendar as a list, for a run over a given period."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [dt.date(m // 12, m % 12 + 1, 1) for m in months]
