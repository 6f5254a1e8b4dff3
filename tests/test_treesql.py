"""Compiled trees: equal to the library's transformation, exact thresholds, one search for many lengths."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vintagelens.operators import modelling
from vintagelens.operators.treesql import Ensemble, Scale, last_passing, number, parse_trees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    data = []
    for i in range(1_500):
        a, b, c = draw.gauss(1e6, 3), round(draw.random(), 1), float(draw.randrange(4))
        y = int(draw.random() < 1 / (1 + math.exp(-(a - 1e6) / 2 - 3 * b + c)))
        data.append((i, y, a, b, c))
    df = spark.createDataFrame(data, "k int, label int, a double, b double, c double")
    return df.repartition(3, "k").cache()


def gaps(rows):
    """The same rows with missing and extreme values."""
    odd = F.when(F.col("k") % 7 == 0, F.lit(None)).when(F.col("k") % 7 == 1, float("nan")).when(F.col("k") % 11 == 2, float("inf"))
    return rows.withColumn("a", odd.otherwise(F.col("a"))).withColumn("b", F.when(F.col("k") % 5 > 0, F.col("b")))


@pytest.mark.parametrize("params", [{"n_estimators": 3, "max_depth": 2}, {"n_estimators": 75, "max_depth": 5, "subsample": 0.6, "colsample_bytree": 0.6}])
def test_equal_to_the_transformation(spark, rows, params):
    model = modelling.fit(rows, FEATURES, params)
    trees = modelling.ensemble(model)
    assert trees.features == FEATURES and len(trees.trees) == params["n_estimators"]
    for df in (rows, gaps(rows)):
        both = trees.with_margin(trees.with_score(model.transform(df), "s"), "m")
        both = both.select("s", "m", "prediction", vector_to_array("probability")[1].alias("p")).collect()
        assert all(abs(r.s - r.p) < 1e-12 and (r.m > 0) == (r.prediction == 1) for r in both)


def test_the_same_text_runs_elsewhere(spark, rows):
    trees = modelling.ensemble(modelling.fit(rows, FEATURES, {"n_estimators": 10, "max_depth": 3}))
    odd = gaps(rows)
    ours = {r.k: r.s for r in trees.with_score(odd, "s").select("k", "s").collect()}
    elsewhere = odd.toPandas()
    elsewhere["b"] = elsewhere["b"].astype(float)
    connection = duckdb.connect()
    nulls = ", ".join(f"case when isnan({c}) then null else {c} end as {c}" for c in FEATURES)
    theirs = connection.execute(f"select k, {trees.score_sql()} from (select k, {nulls} from elsewhere) t").fetchall()
    known = odd.selectExpr("k", *[f"nullif({c}, cast('NaN' as double)) as {c}" for c in FEATURES])
    text = {r.k: r.s for r in known.selectExpr("k", f"{trees.score_sql()} as s").collect()}
    assert text.keys() == ours.keys() and all(abs(text[k] - s) < 1e-15 for k, s in ours.items())
    assert len(theirs) == len(ours) and all(abs(ours[k] - s) < 1e-15 for k, s in theirs)


def test_thresholds_are_exact():
    draw = random.Random(1)
    for _ in range(500):
        scale = Scale(draw.choice([0.0, 1e9, -3.7, draw.gauss(0, 1e3)]), draw.choice([1.0, 1e-7, 12.5, draw.random() + 1e-3]))
        t = draw.choice([0.0, -0.0, draw.gauss(0, 1), -scale.mean / scale.std])
        at = last_passing(scale, t)
        assert scale.passes(at, t) and not scale.passes(math.nextafter(at, math.inf), t)
    assert last_passing(Scale(0.0, 1.0), math.inf) > 1e308


@pytest.mark.parametrize("value", [0.1, -2.5, 1e-300, 5e-324, 1.7976931348623157e308, 3.0, -0.0])
def test_numbers_read_back(spark, value):
    assert spark.sql(f"select {number(value)} as x").first().x == value
    assert duckdb.sql(f"select {number(value)}::double").fetchall()[0][0] == value


def test_printed_trees():
    text = """Model
  Tree 0 (weight 1.0):
    If (feature 2 <= -0.5)
     Predict: 1.5
    Else (feature 2 > -0.5)
     If (feature 0 <= 1.0E-4)
      Predict: -2.0
     Else (feature 0 > 1.0E-4)
      Predict: 0.25
  Tree 1 (weight 0.1):
    Predict: 4.0
"""
    assert parse_trees(text) == [(2, -0.5, 1.5, (0, 1e-4, -2.0, 0.25)), 0.4]
    with pytest.raises(ValueError):
        parse_trees("Tree 0 (weight 1.0):\n If (feature 2 in {1.0})\n Predict: 1.0")
    with pytest.raises(ValueError):
        Ensemble(["a b"], [Scale(0.0, 1.0)], [1.0])


GRID = {"n_estimators": [2, 5, 9], "max_depth": [2, 3], "learning_rate": [0.1, 0.5], "colsample_bytree": [0.6, 1.0]}


def test_points_share_runs():
    points = modelling.draw_params(modelling.SCHEDULED_GRID, 100)
    runs = modelling.shared_runs(points)
    assert sorted(p for places in runs.values() for p in places) == list(range(100))
    whole = modelling.shared_runs(modelling.draw_params(GRID, 10**6))
    assert len(whole) == 8 and all(len(places) == 3 for places in whole.values())


def test_a_long_run_begins_with_the_short_one(rows):
    prepared = modelling.preparation(rows, FEATURES)
    vectors = prepared.transform(rows).select(F.col("label").cast("double").alias("label"), "features").coalesce(1).cache()
    point = {"max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.6, "min_child_weight": 3}
    short, long = (parse_trees(modelling.classifier({**point, "n_estimators": n}).fit(vectors).toDebugString) for n in (7, 20))
    assert long[:7] == short


@pytest.mark.parametrize("metric", ["auc", "auc_hard"])
def test_search_equals_separate_fits(spark, rows, metric):
    found = modelling.random_search(rows, FEATURES, ["k"], GRID, draws=6, metric=metric)
    points = modelling.draw_params(GRID, 6)
    prepared = modelling.preparation(rows, FEATURES)
    folded = modelling.stratified_folds(rows, "label", ["k"], 3, modelling.SEARCH_SEED)
    vectors = prepared.transform(folded).select("label", "features", "fold").coalesce(1).cache()
    averages = []
    for point in points:
        scores = []
        for fold in range(3):
            model = modelling.classifier(point).fit(vectors.where(F.col("fold") != fold).withColumn("label", F.col("label").cast("double")))
            scored = model.transform(vectors.where(F.col("fold") == fold))
            value = vector_to_array("rawPrediction")[1] if metric == "auc" else F.col("prediction")
            pairs = scored.select("label", value.alias("s")).collect()
            good, bad = np.array([r.s for r in pairs if r.label == 0]), np.array([r.s for r in pairs if r.label == 1])
            scores.append(((bad[:, None] > good) + 0.5 * (bad[:, None] == good)).mean())
        averages.append(sum(scores) / 3)
    rows_ = sorted(found.trials.collect(), key=lambda r: r.trial)
    assert np.allclose([r[metric] for r in rows_], averages, atol=1e-9)
    assert found.best == points[int(np.argmax(averages))]
    assert len(modelling.ensemble(found.model).trees) == found.best["n_estimators"]
