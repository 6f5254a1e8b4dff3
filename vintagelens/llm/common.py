"""Shared pieces: stored tables, Arrow text buffers, words and 64-bit hashes on numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import vintagelens

from vintagelens.session import apply_settings, new_table_path

# Functions travel to the workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(vintagelens)

# Text bytes that one numpy step works on; a longer text is one step of its own.
STEP_BYTES = 1 << 21
# Rows per Arrow batch: at 100 KB a text, a batch stays near 50 MB.
BATCH_ROWS = 512

# White space of the word pattern [^\x20\x09-\x0D]+.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[SPACE_BYTES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def prepare(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    # The limit serves the scoring of boosted trees; plans here are measured without it.
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_table_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """As ``stored``, dealt by ``key``: a later grouping or join by it needs no shuffle of the rows."""
    path = new_table_path(df.sparkSession, name)
    called = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.write.option("compression", "zstd").option("path", path).bucketBy(parts, key)
    writer.format("parquet").saveAsTable(called)
    return df.sparkSession.table(called)


def empty_text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``STEP_BYTES`` of text, or one row if that is longer."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + STEP_BYTES, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            own = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
            first = last


def steps_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of texts on the driver, step by step: numpy's working arrays stay small."""
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    return ((data, offsets) for _, data, offsets in steps([batch], "text"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int = 1) -> np.ndarray:
    """n pseudo-random 64-bit values that depend on the seed and the place only."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


BYTE_VALUE = stream(256, 977)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word of a step; words never cross rows."""
    solid = ~IS_SPACE[data]
    if not solid.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each of the given spans, which ascend and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    factor = stream(int(lengths.max()), 31 + seed) | np.uint64(1)
    with np.errstate(over="ignore"):
        values = BYTE_VALUE[data[within + np.repeat(starts, lengths)]] * factor[within]
        return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def per_row(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of the rows in an array whose entries carry their ascending row number."""
    return np.searchsorted(row, np.arange(n_rows + 1))
