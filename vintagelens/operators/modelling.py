"""Gradient-boosted default classifier: fit, random search, report, scoring, registry.

Trees of the distributed library take no NULL and have no L1/L2 leaf terms. Training uses
complete rows; in scoring a missing feature is put at its training mean, so that every
row is scored. The leaf terms are left out of the grids.

The search boosts once for all drawn points that differ in the number of trees only: the first
trees of a long run are those of a shorter one. Runs are compiled to column expressions, of the
first 25, 50 or 75 trees, and each is evaluated on the fold that its run has not seen.
"""

from __future__ import annotations

import itertools
import math
import random
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from vintagelens.functions.scores import gini
from vintagelens.operators.ranking import auc
from vintagelens.operators.scaling import scaler_row
from vintagelens.operators.splits import SEED, split_stats, stratified_folds
from vintagelens.operators.treesql import Ensemble, Scale, parse_trees
from vintagelens.session import shared_dir

# The search spaces of the laboratory and of the scheduled trainer.
LAB_GRID = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
}
SCHEDULED_GRID = {**LAB_GRID, "n_estimators": [25, 50, 75], "max_depth": [2, 3, 5]}
DRAWS = 100
FOLDS = 3
SEARCH_SEED = 42
# Training rows that one task reads: fewer rows make fewer tasks, and more runs go side by side.
ROWS_PER_TASK = 100_000
MOST_RUNS_AT_A_TIME = 16
# Also where one run fills the cluster: the tasks of one run while the driver plans the next level of another.
FEWEST_RUNS_AT_A_TIME = 4
LENGTH = "n_estimators"

# How the names of the grid map to parameters of the classifier.
PARAMETER_NAMES = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
}

_SCALED = "_scaled"
_TERM = re.compile(r"\(`([^`]+)` - double\('([^']+)'\)\) / double\('([^']+)'\)")


@dataclass
class SearchResult:
    model: PipelineModel
    best: dict
    trials: DataFrame


def preparation(train: DataFrame, features: list[str]) -> PipelineModel:
    """Scaling and assembly with the parameters of ``train``, as a saveable pipeline.

    Only two numbers per feature reach the driver.
    """
    p = scaler_row(train, features).first()
    if any(p[f"mean_{c}"] is None for c in features):
        raise ValueError("a feature has no training value: " + ", ".join(c for c in features if p[f"mean_{c}"] is None))

    def term(c: str) -> str:
        std = p[f"std_{c}"] or 1.0
        value = f"(`{c}` - double('{p[f'mean_{c}']!r}')) / double('{std!r}')"
        return f"nanvl(coalesce({value}, 0D), 0D) AS `{c}{_SCALED}`"

    statement = "SELECT *, " + ", ".join(term(c) for c in features) + " FROM __THIS__"
    assembler = VectorAssembler(inputCols=[c + _SCALED for c in features], outputCol="features")
    return Pipeline(stages=[SQLTransformer(statement=statement), assembler]).fit(train)


def classifier(params: dict | None = None, label: str = "label", seed: int = SEED) -> GBTClassifier:
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed)
    return gbt.copy(_param_map(gbt, params or {}))


def fit(train: DataFrame, features: list[str], params: dict | None = None, label: str = "label") -> PipelineModel:
    """Scale, assemble and boost; the result holds all three steps."""
    prepared = preparation(train, features)
    vectors = prepared.transform(train).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shared_dir(train.sparkSession)
        model = classifier(params, label).fit(vectors)
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[*prepared.stages, model])


def draw_params(grid: dict[str, list], draws: int, seed: int = SEARCH_SEED) -> list[dict]:
    """Distinct points of the grid, drawn without replacement."""
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(points, min(draws, len(points)))


def shared_runs(points: list[dict]) -> dict[tuple, list[int]]:
    """Places of the points that one boosting run serves: all but the number of trees is equal."""
    runs: dict[tuple, list[int]] = {}
    for place, point in enumerate(points):
        runs.setdefault(tuple((k, v) for k, v in point.items() if k != LENGTH), []).append(place)
    return runs


def random_search(
    train: DataFrame,
    features: list[str],
    keys: list[str],
    grid: dict[str, list] = SCHEDULED_GRID,
    draws: int = DRAWS,
    folds: int = FOLDS,
    metric: str = "auc",
    label: str = "label",
    parallelism: int | None = None,
) -> SearchResult:
    """Cross-validated random search, then a refit of the best point on all of ``train``.

    ``metric`` is ``auc`` (on probabilities) or ``auc_hard`` (on predicted classes, which
    is balanced accuracy). Folds hold even counts of each label; they follow a hash of the key
    and do not move between runs. The metric uses every distinct score. As many runs go at a
    time as fill the cluster, or ``parallelism``.
    """
    spark = train.sparkSession
    prepared = preparation(train, features)
    folded = stratified_folds(train, label, keys, folds, SEARCH_SEED)
    vectors = prepared.transform(folded).select(F.col(label).cast("double").alias(label), "features", "fold", *features)
    points = draw_params(grid, draws)
    runs = list(shared_runs(points).values())
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="score", metricName="areaUnderROC", numBins=0)
    shared_dir(spark)
    stored = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    tasks = max(1, math.ceil(stored.count() / ROWS_PER_TASK))
    compact = stored.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held_out = [compact.where(F.col("fold") == k) for k in range(folds)]
        learned = [compact.where(F.col("fold") != k).select(label, "features") for k in range(folds)]

        def run(job: tuple[list[int], int]) -> list[tuple[int, float]]:
            places, fold = job
            longest = max((points[p] for p in places), key=lambda point: point.get(LENGTH, 0))
            model = classifier(longest, label).fit(learned[fold])
            trees = Ensemble(features, scales(prepared, features), parse_trees(model.toDebugString))
            found = []
            for place in places:
                scored = trees.with_margin(held_out[fold].drop("features", "fold"), "score", points[place].get(LENGTH))
                if metric == "auc_hard":
                    scored = scored.withColumn("score", (F.col("score") > 0).cast("double"))
                found.append((place, evaluator.evaluate(scored)))
            return found

        jobs = [(places, fold) for places in runs for fold in range(folds)]
        at_a_time = parallelism or min(MOST_RUNS_AT_A_TIME, max(FEWEST_RUNS_AT_A_TIME, spark.sparkContext.defaultParallelism // tasks))
        with ThreadPoolExecutor(at_a_time) as pool:
            found = [x for part in pool.map(inheritable_thread_target(spark)(run), jobs) for x in part]
        averages = [math.fsum(m for p, m in found if p == place) / folds for place in range(len(points))]
        best = max(range(len(points)), key=lambda i: averages[i])
        model = classifier(points[best], label).fit(compact.select(label, "features"))
    finally:
        compact.unpersist()
        stored.unpersist()
    trials = spark.createDataFrame(
        [(i, _text(p), float(m), i == best) for i, (p, m) in enumerate(zip(points, averages))],
        f"trial int, params map<string,string>, {metric} double, best boolean",
    )
    return SearchResult(PipelineModel(stages=[*prepared.stages, model]), points[best], trials)


def scales(prepared: PipelineModel, features: list[str]) -> list[Scale]:
    """Mean and deviation of every feature, read from the scaling step of a fitted pipeline."""
    found = {m[0]: Scale(float(m[1]), float(m[2])) for m in _TERM.findall(prepared.stages[0].getStatement())}
    return [found[c] for c in features]


def ensemble(model: PipelineModel) -> Ensemble:
    """Scaling and trees of a fitted or loaded pipeline as column expressions."""
    features = [c.removesuffix(_SCALED) for c in model.stages[1].getInputCols()]
    return Ensemble(features, scales(model, features), parse_trees(booster(model).toDebugString))


def score(model: PipelineModel | Ensemble, features: DataFrame, model_name: str) -> DataFrame:
    """Probability of default of every row, with its key. One snapshot or many.

    A projection on the features as they are: no vectors and no ML stage.
    """
    trees = model if isinstance(model, Ensemble) else ensemble(model)
    scored = trees.with_score(features.select("Customer_ID", "snapshot_date", *trees.features), "model_predictions")
    return scored.select("Customer_ID", "snapshot_date", F.lit(model_name).alias("model_name"), "model_predictions")


def split_report(model: PipelineModel, split_rows: DataFrame, label: str = "label") -> DataFrame:
    """Rows, label mean, AUC and Gini per split (train, test, oot)."""
    trees = ensemble(model)
    scored = trees.with_score(split_rows.select("split", label, *trees.features), "score")
    quality = auc(scored, ["split"], label, "score")
    return (
        split_stats(split_rows, label)
        .join(quality, "split", "left")
        .select("split", "n_rows", "n_bad", "label_mean", "roc_auc", gini("roc_auc").alias("gini"))
    )


def feature_importance(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """Importances of the fitted trees, highest first; one row per feature."""
    weights = booster(model).featureImportances.toArray().tolist()
    ranked = spark.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature")


def booster(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def registry_row(
    spark: SparkSession,
    model_name: str,
    train_date: str,
    report: DataFrame,
    params: dict,
    windows: dict,
    dates: list[str],
    path: str,
) -> DataFrame:
    """What is kept beside a model: data windows and snapshots, split statistics, results and parameters."""
    by_split = {r.split: r for r in report.collect()}  # one row per split

    def column(name: str) -> dict:
        return {s: _finite(r[name]) for s, r in by_split.items()}

    return spark.createDataFrame(
        [
            (
                model_name,
                train_date,
                {k: str(v) for k, v in windows.items()},
                dates,
                {s: r.n_rows for s, r in by_split.items()},
                column("label_mean"),
                column("roc_auc"),
                column("gini"),
                _text(params),
                path,
            )
        ],
        "model_name string, train_date string, windows map<string,string>, data_dates array<string>, n_rows map<string,bigint>, "
        "label_mean map<string,double>, roc_auc map<string,double>, gini map<string,double>, "
        "params map<string,string>, model_path string",
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _param_map(gbt: GBTClassifier, params: dict) -> dict:
    kinds = {"featureSubsetStrategy": str, "minInfoGain": float, "stepSize": float, "subsamplingRate": float}
    named = {PARAMETER_NAMES[k]: v for k, v in params.items()}
    return {gbt.getParam(k): kinds.get(k, int)(v) for k, v in named.items()}


def _text(params: dict) -> dict[str, str]:
    return {k: str(v) for k, v in params.items()}


def _finite(value: float | None) -> float | None:
    return None if value is None or math.isnan(value) else float(value)
