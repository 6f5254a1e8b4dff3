from __future__ import annotations

import datetime as dt

from vintagelens import schemas
from vintagelens.operators import silver

COLUMNS = "loan_id string, due_amt float, overdue_amt float, installment_num int, snapshot_date date"


def ledger(spark, rows):
    df = spark.createDataFrame([(i, d, o, n, dt.date.fromisoformat(s)) for i, d, o, n, s in rows], COLUMNS)
    missing = [f"cast(null as {t}) {c}" for c, t in schemas.LOAN_TYPES.items() if c not in df.columns]
    return df.selectExpr("*", *missing).select(*schemas.LOAN_TYPES)


def silver_by_id(spark, rows):
    return {r.loan_id: r for r in silver.loans(ledger(spark, rows)).collect()}


def test_days_past_due(spark):
    got = silver_by_id(
        spark,
        [
            ("nothing due", 0.0, 50.0, 6, "2023-03-01"),
            ("due unknown", None, 50.0, 6, "2023-03-01"),
            ("overdue unknown", 100.0, None, 6, "2023-03-01"),
            ("on time", 100.0, 0.0, 6, "2023-03-01"),
            ("one exactly", 100.0, 100.0, 6, "2023-03-01"),
            ("just over one", 100.0, 100.01, 6, "2023-03-01"),
            ("long month", 100.0, 100.0, 6, "2023-02-01"),
            ("month end", 100.0, 100.0, 6, "2024-03-31"),
            ("negative due", -100.0, 50.0, 6, "2023-03-01"),
        ],
    )
    assert {k: (r.installments_missed, r.first_missed_date and str(r.first_missed_date), r.dpd) for k, r in got.items()} == {
        "nothing due": (0, None, None),
        "due unknown": (0, None, None),
        "overdue unknown": (0, None, 0),
        "on time": (0, None, 0),
        "one exactly": (1, "2023-02-01", 28),
        "just over one": (2, "2023-01-01", 59),
        "long month": (1, "2023-01-01", 31),
        "month end": (1, "2024-02-29", 31),
        "negative due": (0, None, None),
    }
    assert got["due unknown"].due_amt == 0.0 and got["overdue unknown"].overdue_amt == 0.0
    assert got["on time"].loan_amt == 0.0 and got["on time"].loan_start_date is None


def test_longest_arrears_stay_the_worst(spark):
    """Dates before the first year do not reach Python: the days are what counts."""
    rows = [("65 million months", 1e-5, 650.0, 6, "2023-03-01"), ("beyond the dates", 1e-30, 5000.0, 6, "2023-03-01")]
    loans = silver.loans(ledger(spark, rows))
    got = {r.loan_id: (r.installments_missed, r.dpd) for r in loans.select("loan_id", "installments_missed", "dpd").collect()}
    assert 64_999_000 < got["65 million months"][0] < 65_001_000 and got["65 million months"][1] > 1_978_000_000
    assert got["beyond the dates"][0] == 2**31 - 1 and got["beyond the dates"][1] > got["65 million months"][1]
    assert [r.label for r in silver.labels(loans).collect()] == [1, 1]


def test_labels(spark):
    rows = [
        ("28 days", 100.0, 100.0, 6, "2023-03-01"),
        ("31 days", 100.0, 100.0, 6, "2023-02-01"),
        ("unknown", 0.0, 100.0, 6, "2023-02-01"),
        ("month 5", 100.0, 100.0, 5, "2023-02-01"),
        ("month unknown", 100.0, 100.0, None, "2023-02-01"),
    ]
    labels = silver.labels(silver.loans(ledger(spark, rows)))
    assert labels.columns == schemas.LABEL_COLUMNS
    assert {r.loan_id: r.label for r in labels.collect()} == {"28 days": 0, "31 days": 1, "unknown": 0}
    assert {r.label_def for r in labels.collect()} == {"30dpd_6mob"}
    at_zero = silver.labels(silver.loans(ledger(spark, rows)), months_on_book=0)
    assert [r.loan_id for r in at_zero.collect()] == ["month unknown"]


def test_label_limit(spark):
    rows = [("dpd 31", 1.0, 1.0, 6, "2023-02-01"), ("dpd 30", 1.0, 1.0, 6, "2023-05-01"), ("dpd 28", 1.0, 1.0, 6, "2023-03-01")]
    loans = silver.loans(ledger(spark, rows))
    for days, expected in ((28, 3), (29, 2), (30, 2), (31, 1), (32, 0)):
        assert sum(r.label for r in silver.labels(loans, days=days).collect()) == expected
