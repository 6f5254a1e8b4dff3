"""Days past due and the default label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: some months more, and the date type overflows. Longer arrears count as this long.
LONGEST_ARREARS_MONTHS = 70_000_000
LARGEST_INT = 2**31 - 1


def installments_missed(overdue: str = "overdue_amt", due: str = "due_amt") -> Column:
    """Overdue amount in instalments, rounded up; NULL where nothing is due.

    A number beyond the type's range is its largest or smallest value.
    """
    number = F.ceil(F.try_divide(F.col(overdue).cast("double"), F.col(due).cast("double")))
    # The least of a NULL and a number would be the number.
    within = F.greatest(F.least(number, F.lit(LARGEST_INT)), F.lit(-LARGEST_INT))
    return F.when(number.isNotNull(), within).cast("int")


def first_missed_date(missed: str = "installments_missed", snapshot: str = "snapshot_date") -> Column:
    months = F.least(F.col(missed), F.lit(LONGEST_ARREARS_MONTHS))
    return F.when(F.col(missed) > 0, F.add_months(F.col(snapshot), -months))


def days_past_due(
    overdue: str = "overdue_amt", first_missed: str = "first_missed_date", snapshot: str = "snapshot_date"
) -> Column:
    """0 where nothing is overdue, NULL where something is but no instalment is due."""
    days = F.date_diff(F.col(snapshot), F.col(first_missed))
    return F.when(F.col(overdue) > 0, days).otherwise(0).cast("int")


def past_due_flag(days: int, dpd: str = "dpd") -> Column:
    """1 from ``days`` past due on; unknown days count as not past due."""
    return F.when(F.col(dpd) >= days, 1).otherwise(0)


def label_definition(days: int, months_on_book: int) -> str:
    return f"{days}dpd_{months_on_book}mob"
