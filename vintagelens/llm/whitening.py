"""Embedding whitening: leading components of a covariance by Jacobi-Davidson.

The covariance is never formed. Its product with a few vectors is one distributed pass over
the fit list, which lies in packed blocks of centred vectors. A search space on the driver, as
wide as a few dozen columns of the dimension, holds what has been found: Rayleigh-Ritz in it
gives estimates and residuals, converged ones are locked, and the projected correction
equations of the others are solved together by MINRES, one pass an inner step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens.llm.common import stored

COMPONENTS = 16
# An entry c becomes the whole number floor(SCALE * c) + OFFSET.
SCALE = 64
OFFSET = 1_000_000
# Entries beyond this cannot become a whole number of 64 bits with room for sums.
MOST_ENTRY = 2.0**52
BLOCK_ROWS = 4_096
# Columns of the search space beyond the wanted, after which it is cut back to them.
SPACE = 32
INNER_STEPS = 6
OUTER_STEPS = 200
# Residuals relative to the largest eigenvalue, in units of the rounding of doubles.
ROUNDING = 8
# Eigenvalues below this share of the largest are zero: their components cannot be whitened.
ZERO = 1e-12
# Tasks whose sums the driver adds up itself; more are added in a layer between.
FEW_TASKS = 64


def minres(product: Callable, project: Callable, shifts: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Solutions of project (A - shift) project x = right, one column each, all columns a pass.

    Lanczos vectors and plane rotations are kept per column; a column that is solved stands still.
    """
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, v_before = right / start, np.zeros_like(right)
    w, w_before = np.zeros_like(right), np.zeros_like(right)
    c, s, c_before, s_before = np.ones(len(shifts)), np.zeros(len(shifts)), np.ones(len(shifts)), np.zeros(len(shifts))
    eta, beta_now, alive = beta.copy(), np.zeros(len(shifts)), beta > 0
    for _ in range(steps):
        if not alive.any():
            break
        turned = project(product(v) - v * shifts) - v_before * beta_now
        alpha = (turned * v).sum(axis=0)
        turned -= v * alpha
        beta_next = np.linalg.norm(turned, axis=0)
        low = c * alpha - c_before * s * beta_now
        root = np.hypot(low, beta_next)
        above = s * alpha + c_before * c * beta_now
        far = s_before * beta_now
        alive &= root > 0
        safe = np.where(alive, root, 1.0)
        c_next, s_next = np.where(alive, low / safe, 1.0), np.where(alive, beta_next / safe, 0.0)
        w, w_before = (v - w_before * far - w * above) / safe, w
        x += np.where(alive, c_next * eta, 0.0) * w
        eta = -s_next * eta
        alive &= beta_next > 1e-14 * start
        v, v_before = turned / np.where(beta_next > 0, beta_next, 1.0) * alive, v
        beta_now, c_before, s_before, c, s = beta_next, c, s, c_next, s_next
    return x


def _orthonormal(columns: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Columns made orthonormal to the space and to each other; those that hold nothing new go."""
    kept = []
    for column in columns.T:
        size = np.linalg.norm(column)
        if not np.isfinite(size) or size == 0:
            continue
        column = column / size
        basis = np.column_stack([space, *kept]) if kept else space
        for _ in range(3):
            column = column - basis @ (basis.T @ column)
        size = np.linalg.norm(column)
        if size > 1e-8:
            column = column / size
            column = column - basis @ (basis.T @ column)
            kept.append((column / np.linalg.norm(column))[:, None])
    return np.hstack(kept) if kept else np.zeros((len(columns), 0))


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray],
    size: int,
    wanted: int,
    inner_steps: int = INNER_STEPS,
    most_columns: int = SPACE,
    seed: int = 5,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric operator.

    ``product`` applies it to the columns of a matrix. Ends when every residual is at the level
    of rounding; raises if that is not reached.
    """
    wanted = min(wanted, size)
    block = min(size, wanted + 4)
    none = np.zeros((size, 0))
    space = _orthonormal(np.random.default_rng(seed).normal(size=(size, block)), none)
    turned = product(space)
    locked, locked_values = none, np.zeros(0)
    for _ in range(OUTER_STEPS):
        inner = space.T @ turned
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        ritz, ritz_turned = space @ vectors, turned @ vectors
        residuals = ritz_turned - ritz * values
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        largest = max([abs(values[0]) if len(values) else 0.0, *np.abs(locked_values)])
        enough = ROUNDING * np.finfo(float).eps * math.sqrt(size) * largest
        missing = wanted - locked.shape[1]
        open_ = np.flatnonzero(sizes[:missing] > enough)
        done = int(open_[0]) if len(open_) else min(missing, len(sizes))
        locked = np.hstack([locked, ritz[:, :done]])
        locked_values = np.concatenate([locked_values, values[:done]])
        if locked.shape[1] >= wanted:
            falling = np.argsort(-locked_values, kind="stable")
            return locked_values[falling], locked[:, falling]
        # What is left of the space is orthogonal to what is locked; a wide one is cut back.
        space, turned, values, residuals, sizes = (
            ritz[:, done:], ritz_turned[:, done:], values[done:], residuals[:, done:], sizes[done:],
        )
        missing -= done
        if space.shape[1] > most_columns + missing:
            space, turned = space[:, : missing + 4], turned[:, : missing + 4]
        asked = np.flatnonzero(sizes[:missing] > enough)
        if not len(asked) or space.shape[1] + locked.shape[1] >= size:
            # The whole space is searched: what remains is the rounding of the stored products.
            fresh = _orthonormal(np.hstack([space, np.eye(size)]), locked)[:, : size - locked.shape[1]]
            space, turned = fresh, product(fresh)
            inner = space.T @ turned
            values, vectors = np.linalg.eigh((inner + inner.T) / 2)
            missing = wanted - locked.shape[1]
            last = np.hstack([locked, (space @ vectors[:, ::-1])[:, :missing]])
            found = np.concatenate([locked_values, values[::-1][:missing]])
            falling = np.argsort(-found, kind="stable")
            return found[falling], last[:, falling]
        against = np.hstack([locked, space[:, :missing]])

        def project(columns: np.ndarray, against=against) -> np.ndarray:
            return columns - against @ (against.T @ columns)

        steps = minres(product, project, values[asked], -project(residuals[:, asked]), inner_steps)
        fresh = _orthonormal(project(steps), np.hstack([locked, space]))
        if not fresh.shape[1]:  # nothing new from the corrections: go on with other directions
            more = np.random.default_rng(locked.shape[1] + space.shape[1]).normal(size=(size, missing))
            fresh = _orthonormal(more, np.hstack([locked, space]))
        space, turned = np.hstack([space, fresh]), np.hstack([turned, product(fresh)])
    raise ArithmeticError("residuals did not reach the level of rounding")


def whole_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """key and x (array of long) of the rows that take part, and the number of dimensions."""
    values = F.col(column).cast("array<double>")
    unusable = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= MOST_ENTRY))
    rows = vectors.select(F.col(key).cast("long").alias("key"), values.alias("values"))
    rows = rows.where(F.col("values").isNotNull() & (F.size("values") > 0)).where(~unusable)
    common = rows.groupBy(F.size("values").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return rows.select("key", F.lit(None).cast("array<long>").alias("x")), 0
    x = F.transform("values", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return rows.where(F.size("values") == common["size"]).select("key", x.alias("x")), common["size"]


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, bool]:
    """n * x - sums of whole vectors: exact 64-bit numbers, or Python's where those do not reach."""
    own, rest = x - OFFSET, [s - n * OFFSET for s in sums]
    reach = n * int(np.abs(own).max(initial=0)) + max(map(abs, rest))
    if reach < 1 << 62:
        return n * own - np.array(rest, np.int64), True
    return n * own.astype(object) - np.array(rest, object), False


BLOCK_ARROW = pa.schema([("vectors", pa.binary())])


def fit_list(rows: DataFrame, size: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every distinct vector once, in stored blocks: packed whole numbers, one row a block."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_matrix(batch.column(0), size))
            if sum(map(len, held)) >= block_rows:
                yield pa.RecordBatch.from_pylist([{"vectors": np.concatenate(held).tobytes()}], schema=BLOCK_ARROW)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist([{"vectors": np.concatenate(held).tobytes()}], schema=BLOCK_ARROW)

    return stored(rows.select("x").distinct().mapInArrow(pack, "vectors binary"), "whitening-blocks")


class FitList:
    """Sums over the stored blocks of distinct vectors; each is one distributed pass."""

    def __init__(self, blocks: DataFrame, size: int):
        self.blocks, self.size = blocks.persist(), size
        found = self.blocks.mapInArrow(_whole_sums(size), "place int, sum string").groupBy("place")
        sums = {r.place: int(r.sum) for r in found.agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).collect()}
        self.n, self.sums = sums.get(-1, 0), [sums.get(i, 0) for i in range(size)]
        self.tasks = self.blocks.select(F.spark_partition_id().alias("task")).distinct().count()

    def total(self, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of what ``of_block`` makes of a block's centred vectors."""
        n, sums, size = self.n, self.sums, self.size

        def add(batches: Iterable[pa.RecordBatch], block=True) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    if block:
                        whole, _ = centred(np.frombuffer(raw, np.int64).reshape(-1, size), n, sums)
                        total = total + of_block(whole.astype(np.float64) / n).ravel()
                    else:
                        total = total + np.frombuffer(raw)
            if not np.isscalar(total):
                yield pa.RecordBatch.from_pylist([{"vectors": total.tobytes()}], schema=BLOCK_ARROW)

        added = self.blocks.mapInArrow(add, "vectors binary")
        if self.tasks > FEW_TASKS:
            added = added.repartition(math.isqrt(self.tasks)).mapInArrow(lambda b: add(b, False), "vectors binary")
        return np.sum([np.frombuffer(r.vectors) for r in added.collect()], axis=0)

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times the columns."""
        return self.total(lambda own: own.T @ (own @ columns)).reshape(columns.shape) / self.n


def _whole_sums(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                x = np.frombuffer(raw, np.int64).reshape(-1, size)
                fits = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
                n, total = n + len(x), total + (x if fits else x.astype(object)).sum(axis=0).astype(object)
        rows = [(-1, str(n)), *((i, str(s)) for i, s in enumerate(total.tolist()))] if n else []
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([s for _, s in rows], pa.string())], names=["place", "sum"])

    return run


OUT_TYPE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
OUT_ARROW = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])


def _whiten(n: int, sums: list[int], matrix: np.ndarray, explained: np.ndarray, error: float):
    size, wide = matrix.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, small = centred(_matrix(batch.column("x"), size).astype(np.int64), n, sums)
            if not small or size * int(np.abs(whole).max(initial=0)) ** 2 >= 1 << 62:
                exact = [sum(v * v for v in row) for row in whole.astype(object).tolist()]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array((whole * whole).sum(axis=1))
            found = (whole.astype(np.float64) / n) @ matrix
            again = pa.array(np.repeat(np.arange(batch.num_rows), wide))
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(again), pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(again), n)), deviation.take(again), pa.array(found.ravel()),
                pa.array(np.tile(explained, batch.num_rows)), pa.array(np.full(len(again), error)),
            ], schema=OUT_ARROW)

    return run


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Entries become whole numbers; the covariance is that of the distinct whole vectors, n of
    them. ``deviation`` is the sum of (n * x - S) ** 2 over the dimensions, exact, and null where
    it exceeds a long. Vectors that are null, empty, hold null, non-finite or (after scaling)
    entries of 2 ** 52 or more, or are not of the most frequent length take no part. Each row
    is whitened by itself, also rows that repeat a vector or an id, or have no id. Components
    without variance are left out, so one distinct vector, or no rows, give no rows. Other
    columns are left out.
    """
    rows, size = whole_vectors(vectors, key, column)
    spark = vectors.sparkSession
    if not size:
        return spark.createDataFrame([], OUT_TYPE)
    fit = FitList(fit_list(rows, size, block_rows), size)
    try:
        trace = float(fit.total(lambda own: np.array([(own * own).sum()]))[0]) / fit.n
        if trace <= 0:
            return spark.createDataFrame([], OUT_TYPE)
        values, found = jacobi_davidson(fit.product, size, components)
        real = values > ZERO * values[0]
        values, found = values[real], found[:, real]
        matrix = found / np.sqrt(values)

        def moments(own: np.ndarray) -> np.ndarray:
            white = own @ matrix
            return np.vstack([white.sum(axis=0), white.T @ white])

        sums = fit.total(moments).reshape(-1, len(values)) / fit.n
    finally:
        fit.blocks.unpersist()
    error = float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(len(values))).max())
    return rows.mapInArrow(_whiten(fit.n, fit.sums, matrix, values / trace, error), OUT_TYPE)
