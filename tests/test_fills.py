from __future__ import annotations

import random

import pytest

from vintagelens.operators import fills

COLUMNS = ["a", "b"]


def history(seed, customers=12, months=9):
    r = random.Random(seed)
    value = lambda: r.choice([None, None, 0.0, 1.0, 2.5])
    return [(f"c{c}", m, value(), value()) for c in range(customers) for m in range(months) if r.random() < 0.8]


def frame(spark, rows):
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date int, a double, b double")


def result(df):
    return {(r.Customer_ID, r.snapshot_date): (r.a, r.b) for r in df.collect()}


@pytest.mark.parametrize("direction", ["both", "forward", "backward"])
def test_equals_brute_force(spark, direction):
    rows = history(3)
    expected = brute(rows, direction)
    df = frame(spark, rows)
    assert result(fills.fill_history(df, COLUMNS, direction)) == expected


def brute(rows, direction):
    by_customer = {}
    for row in rows:
        by_customer.setdefault(row[0], []).append(row)
    out = {}
    for customer, own in by_customer.items():
        own.sort(key=lambda x: x[1])
        for i, row in enumerate(own):
            filled = []
            for k in (2, 3):
                past = [x[k] for x in own[: i + 1] if x[k] is not None]
                ahead = [x[k] for x in own[i:] if x[k] is not None]
                earlier, later = (past[-1] if past else None), (ahead[0] if ahead else None)
                both = later if earlier is None else earlier
                filled.append({"forward": earlier, "backward": later, "both": both}[direction])
            out[(customer, row[1])] = tuple(filled)
    return out


def test_fill_is_idempotent_and_keeps_values(spark):
    df = frame(spark, history(5))
    once = fills.fill_history(df, COLUMNS)
    assert result(fills.fill_history(once, COLUMNS)) == result(once)
    before, after = result(df), result(once)
    assert all(o is None or o == n for k in before for o, n in zip(before[k], after[k]))


def test_rows_that_share_a_date_and_null_keys(spark):
    rows = [("h", 1, None, 1.0), ("h", 1, 4.0, None), ("h", 2, None, None), (None, 1, 7.0, None), (None, 2, None, 3.0)]
    got = sorted(fills.fill_history(frame(spark, rows), COLUMNS, "both").collect(), key=str)
    assert len(got) == 5
    assert all((r.a, r.b) == ((4.0, 1.0) if r.Customer_ID else (7.0, 3.0)) for r in got)


def test_rows_that_share_a_date_in_any_order(spark):
    rows = [("h", 1, None, None), ("h", 1, 4.0, None), ("h", 2, 1.0, None), ("h", 2, 9.0, None), ("h", 3, None, None)]
    for own in (rows, rows[::-1]):
        got = sorted((r.snapshot_date, r.a) for r in fills.fill_history(frame(spark, own), COLUMNS, "forward").collect())
        assert got == [(1, 4.0), (1, 4.0), (2, 1.0), (2, 9.0), (3, 9.0)]


def test_fill_within_a_date(spark):
    rows = [("h", 1, None, 2.0), ("h", 1, 4.0, None), ("h", 2, None, None), ("g", 1, None, 1.0)]
    got = sorted(str((r.Customer_ID, r.snapshot_date, r.a, r.b)) for r in fills.fill_within_date(frame(spark, rows), COLUMNS).collect())
    assert got == ["('g', 1, None, 1.0)", "('h', 1, 4.0, 2.0)", "('h', 1, 4.0, 2.0)", "('h', 2, None, None)"]


def test_edges(spark):
    rows = [("all null", 1, None, None), ("all null", 2, None, None), ("single", 1, 5.0, None), ("head", 1, None, 0.0), ("head", 2, 3.0, None)]
    got = result(fills.fill_history(frame(spark, rows), COLUMNS))
    assert got == {
        ("all null", 1): (None, None), ("all null", 2): (None, None), ("single", 1): (5.0, None),
        ("head", 1): (3.0, 0.0), ("head", 2): (3.0, 0.0),
    }
