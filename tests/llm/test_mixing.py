from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from vintagelens.llm import mixing
from vintagelens.llm.common import table


def water(sizes, weights, most):
    """Targets by resharing the excess of the sources above their cap."""
    names, capped, total = list(sizes), set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weights[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weights[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_and_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "Z": 400, None: 30}
    order = ["Z", "a", "b", "c", None]
    docs = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(docs).collect()}
    wanted = water({s: sizes[s] for s in order}, dict(zip(order, (5, 2, 1, 5, 2), strict=True)), 3)
    assert all(abs(found[s] - wanted[s]) < 1e-6 for s in order)


def test_mix_is_near_its_targets_and_repeatable(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7), cell_rows=20_000).collect()
    assert len(rows) == docs.count()
    assert {(r.doc_id, r.copies) for r in rows} == {(r.doc_id, r.copies) for r in again}
    sums = {}
    for r in rows:
        assert r.taken == r.size * r.copies and r.copies <= 3
        taken, target, largest = sums.get(r.source, (0, r.target, 0))
        sums[r.source] = (taken + r.taken, target, max(largest, r.size))
    assert all(abs(taken - target) <= largest for taken, target, largest in sums.values())
    assert abs(sum(s[0] for s in sums.values()) / sum(s[1] for s in sums.values()) - 1) < 0.02


def test_tree_of_residuals(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 17), f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, cell_rows=10, fan_in=3).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 17 for r in rows)


def test_rounding_keeps_words_and_chances():
    size, sums = np.array([9, 7, 5, 3, 2, 1]), np.zeros(6)
    for seed in range(4_000):
        x, held = mixing.round_pairs(size, np.full(6, 0.4), np.random.default_rng(seed).random(6))
        assert abs((x * size).sum() - 0.4 * size.sum()) < 1e-6
        assert all(v in (0, 1) or i == held for i, v in enumerate(x))
        y, left = mixing.round_pool(size, 0.4, np.random.default_rng(seed).random(6))
        assert abs((y * size).sum() - 0.4 * size.sum()) < 1e-6 and all(v in (0, 1) or i == left for i, v in enumerate(y))
        sums += y
    assert np.allclose(sums / 4_000, 0.4, atol=0.04)


def test_awkward_rows(spark):
    rows = mixing.mix(awkward(spark)).collect()
    assert len(rows) == 10 and all(r.copies == 0 for r in rows if r.size == 0)
    assert mixing.mix(empty(spark)).count() == 0


def test_a_large_document_left_over_is_made_up_for():
    rng = np.random.default_rng(4)
    for _ in range(300):
        size = np.sort(rng.integers(1, 60, 40))[::-1].copy()
        size[0] = rng.integers(100, 900)
        x = rng.integers(0, 2, 40).astype(float)
        x[0] = rng.uniform(0.01, 0.99)
        before, held = (x * size).sum(), mixing.settle(size, x, 0, rng.random())
        assert abs((x * size).sum() - before) < 1e-6
        assert all(v in (0, 1) or i == held for i, v in enumerate(x))
        # Only if all smaller documents together could not make up for it, it stays.
        assert held != 0 or min((1 - x[0]) * size[0] - (x * size)[1:].sum(), x[0] * size[0] - ((1 - x) * size)[1:].sum()) > 0


def test_every_source_meets_its_target(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows, by_source = mixing.mix(docs).collect(), {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    for own in by_source.values():
        small = sorted(r.size for r in own if r.size)[: max(1, len(own) // 10)][-1]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(small, 0.005 * own[0].target)


def test_equal_rows_spread_and_runs_agree(spark):
    rows = [(None, "one two three", "a")] * 25_000 + [(i, "w " * (i % 9), "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    count = lambda df: sorted(map(str, df.groupBy("doc_id", "source", "copies").count().collect()))
    once, again = mixing.mix(docs.repartition(3)), mixing.mix(docs.repartition(11))
    assert count(once) == count(again) and once.count() == len(rows)
    for r in once.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 3
