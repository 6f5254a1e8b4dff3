from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest

from vintagelens.operators import drift


def frame(spark, values, group="g"):
    return spark.createDataFrame([(group, float(v)) for v in values], "g string, v double")


def brute_psi(expected, actual, floor=1e-6):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, 11)))
    shares = [
        pd.cut(pd.Series(x), edges, include_lowest=True).value_counts(normalize=True, sort=False).to_numpy()
        for x in (expected, actual)
    ]
    e, a = (np.where(s == 0, floor, s) for s in shares)
    return float(((a - e) * np.log(a / e)).sum())


def samples(seed, shift=0.0, n=800):
    r = random.Random(seed)
    return [min(1.0, max(0.0, r.gauss(0.4 + shift, 0.2))) for _ in range(n)]


def test_psi_of_identical_samples_is_zero(spark):
    df = frame(spark, samples(1))
    assert drift.psi(df, df, ["g"], "v").first().psi == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("shift, groups", [(0.05, ["g"]), (0.4, ["g"]), (0.1, [])])
def test_psi_equals_brute_force(spark, shift, groups):
    expected, actual = samples(2), samples(3, shift)
    got = drift.psi(frame(spark, expected), frame(spark, actual), groups, "v").first().psi
    assert got == pytest.approx(brute_psi(expected, actual), abs=1e-9) and got > 0


def test_empty_bin(spark):
    expected, actual = [i / 100 for i in range(101)], [i / 100 for i in range(80)]
    df_e, df_a = frame(spark, expected), frame(spark, [*actual, 5.0, -1.0])
    finite = drift.psi(df_e, df_a, ["g"], "v").first().psi
    assert finite == pytest.approx(brute_psi(expected, actual), abs=1e-9)
    assert drift.psi(df_e, df_a, ["g"], "v", floor=None).first().psi == math.inf
    assert drift.psi(df_e, df_e, ["g"], "v", floor=None).first().psi == pytest.approx(0.0)


def test_constant_sample_is_an_error(spark):
    df = frame(spark, [0.5] * 10)
    with pytest.raises(Exception, match="too few distinct values"):
        drift.psi(df, df, ["g"], "v").collect()


def test_one_constant_month_leaves_the_others(spark):
    days = {"2023-01-01": samples(1), "2023-02-01": [0.5] * 20, "2023-03-01": samples(3), "2023-04-01": samples(4)}
    rows = [("m", dt.date.fromisoformat(day), v) for day, values in days.items() for v in values]
    df = spark.createDataFrame(rows, "model_name string, snapshot_date date, model_predictions double")
    got = {str(r.snapshot_date): r.psi for r in drift.psi_by_snapshot(df, ["model_name"]).collect()}
    assert set(got) == {"2023-02-01", "2023-03-01", "2023-04-01"} and got["2023-03-01"] is None
    assert got["2023-04-01"] == pytest.approx(brute_psi(days["2023-03-01"], days["2023-04-01"]), abs=1e-9)
    with pytest.raises(Exception, match="too few distinct values"):
        drift.psi_by_snapshot(df, ["model_name"], strict=True).collect()


def test_group_without_counterpart_is_left_out(spark):
    assert drift.psi(frame(spark, samples(1)), frame(spark, samples(1), "other"), ["g"], "v").count() == 0


def test_psi_by_snapshot_pairs_calendar_months(spark):
    days = {"2023-01-31": 1, "2023-02-28": 2, "2023-03-28": 3, "2023-03-31": 4, "2023-05-01": 5}
    data = {day: samples(seed, 0.02 * seed) for day, seed in days.items()}
    rows = [("m", dt.date.fromisoformat(day), v) for day, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "model_name string, snapshot_date date, model_predictions double")
    got = {str(r.snapshot_date): r.psi for r in drift.psi_by_snapshot(df, ["model_name"]).collect()}
    # Going back a month from 28 February gives 28 January, which is not a snapshot here.
    before = {"2023-03-28": "2023-02-28", "2023-03-31": "2023-02-28"}
    assert got == {day: pytest.approx(brute_psi(data[b], data[day]), abs=1e-9) for day, b in before.items()}


def test_density_equals_brute_force(spark):
    values = [0.1, 0.1, 0.2, 0.25, 0.7, 0.9, 0.9]
    rows = drift.score_density(frame(spark, [*values]), ["g"], "v").orderBy("point").collect()
    x, n = np.array(values), len(values)
    h = x.std(ddof=1) * n**-0.2
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
    density = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    assert np.allclose([r.score for r in rows], grid) and np.allclose([r.density for r in rows], density, atol=1e-12)
    assert np.trapezoid(density, grid) == pytest.approx(1, abs=0.01)


def test_density_of_a_narrow_kernel(spark):
    """Many rows on few scores: most grid points lie outside a kernel's reach."""
    df = spark.range(100_000).selectExpr("'g' g", "case when id = 0 then 1000.0D else (id % 2) / 1000.0D end v")
    got = {r.point: r.density for r in drift.score_density(df, ["g"], "v").collect()}
    x = np.array([1000.0] + [(i % 2) / 1000 for i in range(1, 100_000)])
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
    for point in (0, 1, 2, 3, 100, 198, 199):
        density = np.exp(-0.5 * ((grid[point] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert got.get(point, 0.0) == pytest.approx(density, abs=1e-12)
    assert sorted(got) == list(range(200))
