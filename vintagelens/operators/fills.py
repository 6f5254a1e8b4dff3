"""Forward and backward fill of a customer's history.

One plan for every size: the rows are reduced to one per customer and date, the window runs
over these, and the result is joined back to the rows. A window partition then has at most one
row per date of the calendar, and the two joins and groupings are by customer and date, whose
hot values AQE splits. The input is read twice, so it should be a stored table.

A forward fill can also be carried: a state with the last known values of every customer stands
for the whole history before a period, and the period's rows give the state after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_history(
    df: DataFrame,
    columns: list[str],
    direction: str = "both",
    key: str = "Customer_ID",
    order: str = "snapshot_date",
) -> DataFrame:
    """Fill NULLs from the customer's nearest earlier value, else from the nearest later one.

    ``direction`` is ``both``, ``forward`` or ``backward``; ``forward`` uses no future values.
    Values that are present, 0 included, never change. Rows that share a customer and a date
    share the date's highest value as the one they are filled from, so the order of the rows
    does not matter. Rows without a customer are one history.
    """
    dates = df.groupBy(key, order).agg(*[F.max(c).alias(c) for c in columns])
    carried = dates.select(key, order, *[_nearest(c, direction, key, order).alias(c) for c in columns])
    return _filled_from(df, carried, columns, key, order)


def fill_within_date(
    df: DataFrame, columns: list[str], key: str = "Customer_ID", order: str = "snapshot_date"
) -> DataFrame:
    """Fill NULLs from rows of the same customer and date only: no other snapshot is used."""
    dates = df.groupBy(key, order).agg(*[F.max(c).alias(c) for c in columns])
    return _filled_from(df, dates, columns, key, order)


def carry_forward(
    rows: DataFrame,
    state: DataFrame | None,
    columns: list[str],
    key: str = "Customer_ID",
    order: str = "snapshot_date",
) -> tuple[DataFrame, DataFrame]:
    """Rows of a period filled forward from each other and from ``state``, and the state after them.

    The state has one row per customer: the last known value of each column. The result equals
    ``fill_history(..., "forward")`` of the whole history, of which only the period is read.
    ``rows`` are read three times, so they should be a stored table.
    """
    dates = rows.groupBy(key, order).agg(*[F.max(c).alias(c) for c in columns]).withColumn("_now", F.lit(1))
    if state is not None:
        before = state.select(key, F.lit(None).cast(dates.schema[order].dataType).alias(order), *columns, F.lit(0).alias("_now"))
        dates = dates.unionByName(before)
    frame = Window.partitionBy(key).orderBy("_now", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = [F.last(c, ignorenulls=True).over(frame).alias(c) for c in columns]
    carried = dates.select(key, order, "_now", *known).where("_now = 1").drop("_now")
    latest = [F.expr(f"max_by({c}, struct(_now, {order})) filter (where {c} is not null)").alias(c) for c in columns]
    return _filled_from(rows, carried, columns, key, order), dates.groupBy(key).agg(*latest)


def _filled_from(df: DataFrame, dates: DataFrame, columns: list[str], key: str, order: str) -> DataFrame:
    values = dates.select(F.col(key).alias("_key"), F.col(order).alias("_order"), *[F.col(c).alias(f"_{c}") for c in columns])
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_order"))
    joined = df.join(values, same, "left")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def _nearest(column: str, direction: str, key: str, order: str) -> Column:
    """Nearest value at or before the row, at or after it, or the first of these two.

    Looking ahead is written as looking back in descending order: a frame that runs to the
    end of the partition would be evaluated anew for every row. Both orders share a shuffle.
    """

    def latest(ordering: Column) -> Column:
        frame = Window.partitionBy(key).orderBy(ordering).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last(column, ignorenulls=True).over(frame)

    earlier, later = latest(F.asc(order)), latest(F.desc(order))
    return {"forward": earlier, "backward": later, "both": F.coalesce(earlier, later)}[direction]
