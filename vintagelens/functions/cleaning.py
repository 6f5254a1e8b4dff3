"""Cleaning of raw text columns.

Raw feeds are read as strings, so every number and date passes through one of these
expressions. Under ANSI mode a plain cast of dirty text aborts the job; here text that
does not parse becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# The characters each class of column loses before its cast.
UNDERSCORES = "_"
NON_DIGITS = "[^0-9]"
NON_DECIMALS = "[^0-9.]"

# Recognised shapes.
SSN_SHAPE = r"^\d{3}-\d{2}-\d{4}$"
PLACEHOLDER_OCCUPATION = r"^_{3,}$"
BEHAVIOUR_SHAPE = r"^[A-Za-z_]+$"
YEARS_TEXT = r"(\d+)\s*Years?"
MONTHS_TEXT = r"(\d+)\s*Months?"


def lenient_int(column: Column | str) -> Column:
    """Whole number from text; a fraction is cut off and unparsable text gives NULL."""
    return _column(column).try_cast("double").try_cast("int")


def lenient_float(column: Column | str) -> Column:
    return _column(column).try_cast("float")


def strip_cast(column: Column | str, unwanted: str, to: str) -> Column:
    """Remove the unwanted characters, then cast."""
    stripped = F.regexp_replace(_column(column), unwanted, "")
    return lenient_int(stripped) if to == "int" else stripped.try_cast(to)


def parse_date(column: Column | str) -> Column:
    return F.try_to_date(_column(column), "yyyy-MM-dd")


def occupation(column: Column | str) -> Column:
    """Underscore placeholders become Unknown; NULL stays NULL."""
    c = _column(column)
    return F.when(c.rlike(PLACEHOLDER_OCCUPATION), UNKNOWN).otherwise(c)


def credit_mix(column: Column | str) -> Column:
    """The one-underscore placeholder becomes Unknown; NULL stays NULL."""
    c = _column(column)
    return F.when(c == "_", UNKNOWN).otherwise(c)


def payment_behaviour(column: Column | str) -> Column:
    """Anything but letters and underscores, NULL included, becomes Unknown."""
    c = _column(column)
    return F.when(c.rlike(BEHAVIOUR_SHAPE), c).otherwise(UNKNOWN)


def duration_months(column: Column | str) -> Column:
    """Months in a text such as ``22 Years and 1 Months``.

    A part that is absent counts as zero, so text without any part is 0; only NULL is NULL.
    """
    c = _column(column)

    def part(pattern: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("int"), F.lit(0))

    return F.when(c.isNotNull(), part(YEARS_TEXT) * 12 + part(MONTHS_TEXT)).cast("int")


def listed_loans(types: Column | str) -> Column:
    """Number of comma-separated entries in the loan type text, 0 for NULL."""
    c = _column(types)
    return F.when(c.isNotNull(), F.size(F.split(c, ","))).otherwise(0)


def loan_count(stated: Column | str, types: Column | str, highest: int = 50) -> Column:
    """Stated number of loans, or the listed one where the stated one is missing or absurd."""
    digits = strip_cast(stated, NON_DIGITS, "int")
    return F.when(digits.between(0, highest), digits).otherwise(listed_loans(types))


def loan_types(count: Column | str, types: Column | str) -> Column:
    """``No Loan`` where there is none, NULL for blank text."""
    return F.when(_column(count) == 0, "No Loan").otherwise(F.nullif(_column(types), F.lit("")))


def credit_limit(column: Column | str) -> Column:
    """Changed credit limit, NULL where it is negative or does not parse."""
    value = lenient_float(column)
    return F.when(value >= 0, value)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient rounded to three places; NULL for a zero denominator."""
    return F.round(F.try_divide(_column(numerator), _column(denominator)), 3)


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
