from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagelens.operators import ranking


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def auc_of(spark, pairs, transform=lambda c: c):
    df = spark.createDataFrame([(y, s) for y, s in pairs], "label int, score double").select(
        "label", transform(F.col("score")).alias("score"), F.lit("g").alias("g")
    )
    return ranking.auc(df, ["g"]).first().roc_auc


def random_pairs(seed, n=600, levels=40):
    r = random.Random(seed)
    return [(int(r.random() < 0.3), r.randrange(levels) / levels if r.random() < 0.7 else r.random()) for _ in range(n)]


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], 1.0),
        ([(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)], 0.0),
        ([(1, 0.5), (0, 0.5), (0, 0.5)], 0.5),
        ([(1, 0.5), (1, 0.7)], None),
        ([(None, 0.5), (1, 0.7), (0, 0.6), (0, None), (1, float("nan"))], 1.0),
    ],
)
def test_auc_edges(spark, pairs, expected):
    assert auc_of(spark, pairs) == expected


def test_auc_equals_brute_force_and_its_symmetries(spark):
    pairs = random_pairs(1)
    expected = brute_auc(pairs)
    assert auc_of(spark, pairs) == pytest.approx(expected, abs=1e-12)
    assert auc_of(spark, pairs, lambda c: F.exp(5 * c) - 3) == pytest.approx(expected, abs=1e-12)
    assert auc_of(spark, [(1 - y, s) for y, s in pairs]) == pytest.approx(1 - expected, abs=1e-12)


def test_auc_per_group_with_one_large_group_and_a_null_group(spark):
    groups = {"big": random_pairs(2, 2000), "small": random_pairs(3, 30), None: random_pairs(4, 50)}
    rows = [(g, y, s) for g, pairs in groups.items() for y, s in pairs]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r.g: r.roc_auc for r in ranking.auc(df, ["g"]).collect()}
    assert got == {g: pytest.approx(brute_auc(p), abs=1e-12) for g, p in groups.items()}


def test_auc_when_one_score_holds_most_rows(spark):
    """The pair counts exceed 64 bits; the exact result is known."""
    n = 3_000_000
    df = spark.range(n).select(
        F.lit("g").alias("g"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") < 2_000_000, 0.5).otherwise(F.col("id") / n).alias("score"),
    )
    # Ties give a half; above them each positive beats every negative except higher ones.
    m = 500_000
    expected = (0.5 * 1_000_000**2 + m * 1_000_000 + m * (m + 1) / 2) / (1_500_000**2)
    assert ranking.auc(df, ["g"]).first().roc_auc == pytest.approx(expected, rel=1e-14)


@pytest.mark.parametrize("n", [1, 2, 11, 500])
def test_percentiles_equal_numpy(spark, n):
    r = random.Random(n)
    values = [r.choice([0.25, 0.5, r.random()]) for _ in range(n)]
    probabilities = [i / 10 for i in range(11)] + [0.333]
    df = spark.createDataFrame([("g", v) for v in [*values, None, float("nan")]], "g string, v double")
    row = ranking.percentiles(df, ["g"], "v", probabilities).first()
    assert row.n == n
    assert np.allclose(row.percentiles, np.quantile(values, probabilities), rtol=0, atol=1e-15)


def test_percentiles_per_group(spark):
    r = random.Random(9)
    rows = [(f"g{i % 3}" if i % 7 else None, r.gauss(i % 3, 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v double")
    for row in ranking.percentiles(df, ["g"], "v", [0.0, 0.1, 0.5, 1.0]).collect():
        own = [v for g, v in rows if g == row.g]
        assert row.n == len(own) and np.allclose(row.percentiles, np.quantile(own, [0.0, 0.1, 0.5, 1.0]), atol=1e-12)


@pytest.mark.parametrize("most_values", [5, 40])
def test_full_ranges_are_cut_again(spark, monkeypatch, most_values):
    """Results do not change, and no window partition holds more than the stated number of values."""
    pairs = {"big": random_pairs(7, 3_000, 400), "small": random_pairs(8, 40), None: random_pairs(9, 200)}
    rows = [(g, y, s) for g, found in pairs.items() for y, s in found]
    df = spark.createDataFrame(rows, "g string, label int, score double").cache()
    monkeypatch.setattr(ranking, "BASE", 4)  # 16 ranges a cut
    monkeypatch.setattr(ranking, "MOST_VALUES", most_values)
    monkeypatch.setattr(ranking, "CUTS", 2)
    got = {r.g: r.roc_auc for r in ranking.auc(df, ["g"]).collect()}
    assert got == {g: pytest.approx(brute_auc(p), abs=1e-12) for g, p in pairs.items()}
    exact = {r.g: r.percentiles for r in ranking.percentiles(df, ["g"], "score", [0.0, 0.1, 0.5, 0.93, 1.0]).collect()}
    for g, found in pairs.items():
        assert exact[g] == pytest.approx(np.percentile([s for _, s in found], [0, 10, 50, 93, 100]).tolist(), abs=1e-12)
    ranged = ranking._ranged(df, ["g"], "score", [])
    cells = ranged.groupBy("g", "_range", "_value").agg(F.count(F.lit(1)).alias("_n"))
    split = ranking.split_full_ranges(cells, ["g"], ["_n"])
    sizes = [r["count"] for r in split.groupBy("g", "_range").count().collect()]
    assert max(sizes) <= most_values and sum(sizes) == cells.count()
    bounds = split.groupBy("g", "_range").agg(F.min("_value").alias("lo"), F.max("_value").alias("hi")).collect()
    for g in pairs:
        own = sorted((r["_range"], r.lo, r.hi) for r in bounds if r.g == g)
        assert all(a[2] < b[1] for a, b in zip(own, own[1:]))


def test_windows_run_over_refined_ranges(spark):
    df = spark.createDataFrame([("a", 1, 0.5)], "g string, label int, score double")
    for query in (ranking.auc(df, ["g"]), ranking.percentiles(df, ["g"], "score", [0.5])):
        plan = query._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("percentile_approx") >= 1 + ranking.CUTS
