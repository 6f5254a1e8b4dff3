"""Nearest vectors by inner product: randomly rotated one-bit codes, error bounds, exact rerank.

A vector keeps the signs of its randomly rotated coordinates as packed bits, its length and
its alignment with those signs. The inner product with a query is estimated from the bits and
corrected by the alignment; a bound on the error follows from the alignment as well. In each
block of vectors, those whose upper bound reaches the k-th highest lower bound are reranked by
exact inner products in double precision. All vectors are indexed; nothing is fitted.

Codes lie in blocks of fixed size, queries in groups of fixed size: each group of the stated
query set meets each block once, and sends on at most k rows a query. A block is read once for
many groups, which stream past it: what a task holds is one block and one group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Vectors of one block, and queries of one group.
BLOCK_ROWS = 16_384
GROUP_ROWS = 1_024
# Groups that a block meets in one go, fewer only where there would be less than one go a task.
MEETING_GROUPS = 64
# Width of the error bound in standard deviations of the estimate.
SURENESS = 2.5
SEED = 11
# Vectors shorter than this share of the block's longest are always reranked.
SHORT = 1e-30


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and lengths as shares of the longest; no magnitude of doubles overflows."""
    largest = np.abs(vectors).max(axis=1)
    powers = np.frexp(largest)[1]
    # In two steps, as 2 ** -1074 and its inverse are beyond the doubles.
    reduced = np.ldexp(np.ldexp(vectors, -(powers // 2)[:, None]), -(powers - powers // 2)[:, None])
    lengths = np.sqrt((reduced * reduced).sum(axis=1))
    shares = np.ldexp(lengths, np.maximum(powers - powers.max(initial=0), -1000))
    return reduced / lengths[:, None], shares / shares.max(initial=1e-300)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, lengths, and alignments (inner product of the unit vector with its code)."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / lengths[:, None]) @ turn.T
    return np.packbits(turned > 0, axis=1), lengths, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def estimate(bits, lengths, alignments, queries: np.ndarray, turn: np.ndarray, sureness: float):
    """Estimated inner products (queries x vectors) and the bound on their errors."""
    size = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1
    turned = (queries @ turn.T).astype(np.float32)
    found = turned @ signs.T * (lengths / alignments / np.sqrt(size)).astype(np.float32)
    spread = np.sqrt(np.maximum(0, 1 - alignments**2)) / alignments * lengths / np.sqrt(max(1, size - 1))
    return found, sureness * np.sqrt((queries * queries).sum(axis=1))[:, None] * spread[None, :]


def usable(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, int, int]:
    """key and values (array of double) of the vectors that take part, their length and number."""
    values = F.col(column).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(values, lambda x: x == 0)
    rows = vectors.select(F.col(key).cast("long").alias("key"), values.alias("values"))
    rows = rows.where(F.col("key").isNotNull() & F.col("values").isNotNull()).where(~bad & ~zero)
    sizes = rows.groupBy(F.size("values").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        return rows, 0, 0
    return rows.where(F.size("values") == common["size"]), common["size"], common.n


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    column: str = "embedding",
    sureness: float = SURENESS,
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
    meeting_groups: int = MEETING_GROUPS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query, without itself.

    Ties go to the smaller vec_id. Scores are sums of products in double precision, also where
    these overflow; one that is not a number counts as the lowest. Vectors that are null, zero, hold null or non-finite parts,
    have no id, or are not of the most frequent length take no part, neither as candidates nor
    as queries. A repeated id is a candidate once a row. No vectors, or one, give no rows. Other
    columns are left out.
    """
    rows, size, n = usable(vectors, key, column)
    asked, asked_size, n_asked = usable(queries, key, column)
    out = "query_id long, vec_id long, score double"
    if not n or asked_size != size:
        empty = vectors.sparkSession.createDataFrame([], out)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    blocks, groups = -(-n // block_rows), -(-n_asked // group_rows)
    packed_type = "block int, ids binary, bits binary, lengths binary, alignments binary, vectors binary"

    def pack(chunk: pa.Table) -> pa.Table:
        order = np.argsort(chunk["key"].to_numpy(), kind="stable")
        matrix = _matrix(chunk["values"], size)[order]
        # Only the order counts, so lengths are shares of the block's longest.
        unit, lengths = units(matrix)
        bits, _, alignments = encode(unit, rotation(size))
        row = {
            "block": chunk["block"][0].as_py(), "ids": chunk["key"].to_numpy()[order].astype(np.int64).tobytes(),
            "bits": bits.tobytes(), "lengths": lengths.tobytes(), "alignments": alignments.tobytes(), "vectors": matrix.tobytes(),
        }
        names = ["ids", "bits", "lengths", "alignments", "vectors"]
        return pa.Table.from_pylist([row], schema=pa.schema([("block", pa.int32()), *[(x, pa.binary()) for x in names]]))

    def pack_queries(chunk: pa.Table) -> pa.Table:
        ids, matrix = chunk["key"].to_numpy().astype(np.int64), _matrix(chunk["values"], size)
        row = {"part": chunk["block"][0].as_py(), "asked": ids.tobytes(), "questions": matrix.tobytes()}
        return pa.Table.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("asked", pa.binary()), ("questions", pa.binary())]))

    def near_in_block(block: tuple, asked_ids: np.ndarray, questions: np.ndarray):
        ids, matrix, bits, lengths, alignments, turn = block
        middle, error = estimate(bits, lengths, alignments, units(questions)[0], turn, sureness)
        # Where single precision cannot tell, the exact step does.
        error[:, ~(lengths >= SHORT)] = np.inf
        error[~np.isfinite(middle)] = np.inf
        middle[~np.isfinite(middle)] = 0
        found = []
        for i, own in enumerate(asked_ids):
            other = ids != own
            lower = (middle[i] - error[i])[other]
            least = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else -np.inf
            near = np.flatnonzero(other & (middle[i] + error[i] >= least))
            with np.errstate(over="ignore", invalid="ignore"):
                exact = (matrix[near] * questions[i]).sum(axis=1)
            exact[np.isnan(exact)] = -np.inf
            best = np.lexsort((ids[near], -exact))[:k]
            found.append((np.full(len(best), own), ids[near][best], exact[best]))
        return [np.concatenate(x) for x in zip(*found, strict=True)]

    def meet(batches):
        """Rows come sorted: each block, then the groups of queries that meet it."""
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        turn, block, number = rotation(size), None, -1
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["ids"] is not None:
                    ids, matrix = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(-1, size)
                    bits = np.frombuffer(row["bits"], np.uint8).reshape(len(ids), -1)
                    number, block = row["block"], (ids, matrix, bits, np.frombuffer(row["lengths"]), np.frombuffer(row["alignments"]), turn)
                if row["ids"] is not None or row["block"] != number:  # no vector was dealt to such a block
                    continue
                asked_ids, questions = np.frombuffer(row["asked"], np.int64), np.frombuffer(row["questions"]).reshape(-1, size)
                for first in range(0, len(asked_ids), 64):
                    found = near_in_block(block, asked_ids[first : first + 64], questions[first : first + 64])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    def dealt(df: DataFrame, parts: int):
        return df.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))

    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meetings = min(groups, max(-(-groups // meeting_groups), -(-tasks // blocks)))
    codes = dealt(rows, blocks).groupBy("block").applyInArrow(pack, packed_type)
    asked = dealt(asked, groups).groupBy("block").applyInArrow(pack_queries, "part int, asked binary, questions binary")
    asked = asked.withColumn("meeting", F.pmod("part", F.lit(meetings))).drop("part")
    sent = codes.withColumn("meeting", F.explode(F.sequence(F.lit(0), F.lit(meetings - 1))))
    asking = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = sent.unionByName(asking, allowMissingColumns=True)
    met = both.repartition(tasks, "block", "meeting").sortWithinPartitions("block", "meeting", F.col("ids").isNull())
    met = met.mapInArrow(meet, out)
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(nearest_first))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
