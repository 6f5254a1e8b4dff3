from __future__ import annotations

import math

import numpy as np
import pytest

from vintagelens.llm import whitening
from vintagelens.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, key long, x string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 7, "x") for i, v in zip(ids, vectors, strict=True)]
    return prepare(spark).createDataFrame(rows, SCHEMA)


def brute(vectors, components):
    """(whitened up to sign, deviations, explained) of whole vectors, from a full eigenproblem."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    distinct = [list(v) for v in sorted({tuple(v) for v in x})]
    n, sums = len(distinct), [sum(column) for column in zip(*distinct, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centre = lambda rows: np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in rows])
    fit = centre(distinct)
    covariance = fit.T @ fit / n
    values, found = np.linalg.eigh(covariance)
    values, found = values[::-1][:components], found[:, ::-1][:, :components]
    return centre(x) @ found / np.sqrt(values), deviation, values / np.trace(covariance), n


def check(spark, vectors, components=16, ids=None, tolerance=1e-9):
    ids = list(range(len(vectors))) if ids is None else ids
    white, deviation, explained, n = brute(vectors, components)
    rows = whitening.whiten(frame(spark, vectors, ids), components, block_rows=64).collect()
    wide = white.shape[1]
    assert len(rows) == len(vectors) * wide
    got = {}
    for r in rows:
        got.setdefault((str(r.vec_id), r.component), []).append(r)
    for c in range(wide):
        ours = np.array([got[str(i), c + 1][0].whitened for i in ids])
        sign = 1 if np.abs(ours - white[:, c]).max() < np.abs(ours + white[:, c]).max() else -1
        assert np.abs(ours * sign - white[:, c]).max() < tolerance
    for k, i in enumerate(ids):
        assert {r.deviation for r in got[str(i), 1]} == {deviation[k]}
    for r in rows:
        assert r.n == n and abs(r.explained / explained[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-9


def test_equals_a_full_eigenproblem(spark):
    draw = np.random.default_rng(1)
    check(spark, draw.normal(size=(700, 24)) * np.linspace(3, 0.5, 24))


def test_fewer_dimensions_than_components_and_repeated_vectors(spark):
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(90, 5))
    check(spark, np.vstack([vectors, vectors[:60], np.repeat(vectors[:1], 40, axis=0)]))


def test_entries_of_large_magnitude_stay_exact(spark):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(60, 4)) * 1e9
    rows = whitening.whiten(frame(spark, vectors), 4).where("component = 1").collect()
    _, deviation, _, _ = brute(vectors, 4)
    assert {r.vec_id: r.deviation for r in rows} == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}


def test_rows_that_take_no_part(spark):
    draw = np.random.default_rng(4)
    good = draw.normal(size=(40, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, math.nan, 2.0], [math.inf, 0.0, 0.0], [1e200, 0.0, 0.0], [1.0, 2.0]]
    rows = whitening.whiten(frame(spark, good + bad, [*range(40), *range(100, 107)]), 3).collect()
    assert {r.vec_id for r in rows} == set(range(40)) and {r.n for r in rows} == {40}
    same = whitening.whiten(frame(spark, [*good, good[0]], [*range(40), None]), 3).where("vec_id is null").collect()
    assert len(same) == 3


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten_gives_no_rows(spark, vectors):
    assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_a_component_without_variance_is_left_out(spark):
    draw = np.random.default_rng(5)
    flat = np.hstack([draw.normal(size=(50, 2)), np.ones((50, 2))])
    rows = whitening.whiten(frame(spark, flat)).collect()
    assert {r.component for r in rows} == {1, 2} and max(r.identity_error for r in rows) < 1e-9


@pytest.mark.parametrize("size", [1, 2, 17, 64, 300, 700])
def test_jacobi_davidson_reaches_rounding(size):
    draw = np.random.default_rng(size)
    turn, _ = np.linalg.qr(draw.normal(size=(size, size)))
    values = np.sort(draw.uniform(0.1, 1, size) ** 3)[::-1]
    matrix = (turn * values) @ turn.T
    passes = []

    def product(columns):
        passes.append(columns.shape[1])
        return matrix @ columns

    got, vectors = whitening.jacobi_davidson(product, size, 16)
    wanted = min(16, size)
    assert np.abs(got - values[:wanted]).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * got, axis=0).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    assert max(passes) <= max(20, size if size <= 128 else 20)


def test_equal_eigenvalues():
    matrix = np.diag([5.0] * 6 + [1.0] * 94)
    got, vectors = whitening.jacobi_davidson(lambda c: matrix @ c, 100, 4)
    assert np.abs(got - 5).max() < 1e-12 and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_projected_correction_equation_is_solved():
    draw = np.random.default_rng(6)
    matrix = draw.normal(size=(30, 30))
    matrix = matrix + matrix.T
    against, _ = np.linalg.qr(draw.normal(size=(30, 3)))
    project = lambda c: c - against @ (against.T @ c)
    shifts, right = np.array([0.3, -0.7]), project(draw.normal(size=(30, 2)))
    x = whitening.minres(lambda c: matrix @ c, project, shifts, right, 60)
    assert np.linalg.norm(project(matrix @ x - x * shifts) - right) < 1e-8
