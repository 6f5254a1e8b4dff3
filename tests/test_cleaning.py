from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintagelens.functions import cleaning as c


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "unwanted, to, pairs",
    [
        (c.NON_DIGITS, "int", {"": None, "_": None, "3_": 3, "-100": 100, "3.0": 30, "99999999999": None}),
        (c.NON_DECIMALS, "float", {"": None, "1.2.3": None, "__10000__": 10000.0, "-3.25": 3.25, "1234.5_": 1234.5}),
        (c.UNDERSCORES, "int", {"23_": 23, "-500": -500, "_": None, "3.7": 3}),
    ],
)
def test_strip_cast(spark, unwanted, to, pairs):
    assert values(spark, [*pairs, None], lambda x: c.strip_cast(x, unwanted, to)) == [*pairs.values(), None]


def test_lenient_int(spark):
    pairs = {"3.7": 3, " 3 ": 3, "": None, "_": None, "99999999999": None, "-1.5": -1, "10.0": 10}
    assert values(spark, [*pairs, None], c.lenient_int) == [*pairs.values(), None]


def test_parse_date(spark):
    texts = ["2023-01-31", "2023-13-01", "2023-02-30", "", "n/a", None]
    assert values(spark, texts, c.parse_date) == [dt.date(2023, 1, 31), None, None, None, None, None]


def test_duration_months(spark):
    pairs = {"22 Years and 1 Months": 265, "1 Year": 12, "7 Months": 7, "NA": 0, "": 0}
    assert values(spark, [*pairs, None], c.duration_months) == [*pairs.values(), None]


def test_placeholders(spark):
    assert values(spark, ["_______", "__", "Lawyer", None], c.occupation) == ["Unknown", "__", "Lawyer", None]
    assert values(spark, ["_", "__", "Good", None], c.credit_mix) == ["Unknown", "__", "Good", None]
    assert values(spark, ["!@9#%8", "Low_spent", "", None], c.payment_behaviour) == ["Unknown", "Low_spent", "Unknown", "Unknown"]


def test_credit_limit(spark):
    assert values(spark, ["_", "-3.25", "0", "4.5", "x", None], c.credit_limit) == [None, None, 0.0, 4.5, None, None]


def test_loans(spark):
    rows = [
        (0, "4", "Auto Loan"),
        (1, "967", "Auto Loan, Student Loan, and Payday Loan"),
        (2, None, None),
        (3, "0", "Auto Loan"),
        (4, "-100", "Auto Loan"),
        (5, "3_", ""),
        (6, "51", ""),
    ]
    df = spark.createDataFrame(rows, "i int, n string, t string")
    count = c.loan_count("n", "t")
    got = df.select("i", count.alias("n"), c.loan_types(count, "t").alias("t")).orderBy("i").collect()
    assert [r.n for r in got] == [4, 3, 0, 0, 1, 3, 1]
    assert [r.t for r in got] == ["Auto Loan", rows[1][2], "No Loan", "No Loan", "Auto Loan", None, None]


def test_ratio(spark):
    df = spark.createDataFrame([(0, 1.0, 3.0), (1, 1.0, 0.0), (2, None, 2.0)], "i int, a float, b float")
    assert [r.q for r in df.select("i", c.ratio("a", "b").alias("q")).orderBy("i").collect()] == [0.333, None, None]
