"""Source divergence audit: token-start pointers, sorted in shards, whose equal runs are counted.

Scan tasks gather texts into shards of Arrow buffers and set a pointer at every start of a
term. Pointers, not terms, are sorted, by a multikey quicksort that compares eight bytes of
the buffer at a time: large slices are parted around pivots into less, equal and greater, small
ones are sorted at once, and only runs of equal keys go on eight bytes deeper. Equal runs are
the distinct terms of the shard; each yields its occurrences and documents by (lang, source).
Spark adds up the runs of all shards, keeps the frequent terms and compares the sources.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.llm.common import LOWER, empty_text, steps, stored

# Bytes of terms, [^\x00-\x40\x5B-\x60\x7B-\x7F]+.
IN_TERM = np.ones(256, bool)
IN_TERM[0x00:0x41] = IN_TERM[0x5B:0x61] = IN_TERM[0x7B:0x80] = False
# Text bytes of a shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20
# Pointers that are sorted at once; larger slices are parted first.
SLICE = 1 << 16
KEY = 8
# A term is kept if so many documents of its language have it.
LEAST_DOCUMENTS = 30
# Shares are in parts of SCALE, with SMOOTHING occurrences more of each kept term.
SCALE = 1_000_000_000
SMOOTHING = 5
MOST_TERMS = 50
# Terms of a language that one task compares, and sources on either side of a comparison.
SLICE_TERMS = 2_048
BLOCK_SOURCES = 128


def pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of every term; terms never cross rows."""
    inside = IN_TERM[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1 - starts, np.searchsorted(offsets, starts, "right") - 1


def keys_at(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each term from ``depth`` on as one number, zeros after the term's end.

    ``padded`` has eight bytes more than the text.
    """
    windows = np.lib.stride_tricks.sliding_window_view(padded, KEY)
    left = np.clip(lengths - depth, 0, KEY)
    at = np.minimum(starts + depth, len(padded) - KEY)
    keys = np.ascontiguousarray(windows[at]).view(">u8").ravel().astype(np.uint64)
    keep = np.uint64(8) * np.minimum(KEY - left, KEY - 1).astype(np.uint64)
    return np.where(left > 0, keys >> keep << keep, np.uint64(0))


def parted(keys: np.ndarray, size: int = SLICE) -> Iterator[np.ndarray]:
    """Places of the keys in slices that ascend: at most ``size`` places, or all of one key."""
    todo = [np.arange(len(keys))]
    while todo:
        own = todo.pop()
        found = keys[own]
        if len(own) <= size or found.min() == found.max():
            if len(own):
                yield own
            continue
        pivot = np.sort(found[[0, len(found) // 2, -1]])[1]
        less, equal = found < pivot, found == pivot
        todo += [own[~(less | equal)], own[equal], own[less]]


def sort_slice(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, own: np.ndarray):
    """Pointers of a slice in the order of their terms, stable, and where runs of equal terms begin."""
    order, first = own.copy(), np.zeros(len(own), bool)
    place, run, depth = np.arange(len(own)), np.zeros(len(own), np.int64), 0
    while len(place):
        own = order[place]
        keys = keys_at(padded, starts[own], lengths[own], depth)
        by_key = np.lexsort((keys, run))
        order[place], keys = own[by_key], keys[by_key]
        change = np.concatenate([[True], (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])])
        first[place] |= change
        run = np.cumsum(change) - 1
        # A key that ends in a zero byte holds the end of its term; a pointer alone is sorted.
        deeper = (keys & np.uint64(255) != 0) & (np.bincount(run)[run] > 1)
        place, run, depth = place[deeper], run[deeper], depth + KEY
    return order, first


def equal_runs(data: np.ndarray, offsets: np.ndarray, size: int = SLICE):
    """Pointers sorted by term: start and length of each run's term, then run and row of every pointer."""
    starts, lengths, rows = pointers(data, offsets)
    padded = np.concatenate([data, np.zeros(KEY, np.uint8)])
    found = [sort_slice(padded, starts, lengths, own) for own in parted(keys_at(padded, starts, lengths, 0), size)]
    order = np.concatenate([np.zeros(0, np.int64), *[x for x, _ in found]])
    first = np.concatenate([np.zeros(0, bool), *[x for _, x in found]])
    heads = order[first]
    return starts[heads], lengths[heads], np.cumsum(first) - 1, rows[order]


COUNTED_TYPE = "lang string, source string, term string, n long, docs long"
COUNTED_ARROW = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()),
])


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)])
    flat = data[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
    buffers = [None, pa.py_buffer(np.ascontiguousarray(ends.astype(np.int64))), pa.py_buffer(flat)]
    return pa.Array.from_buffers(pa.large_string(), len(starts), buffers)


def _shard(slices: list[pa.RecordBatch], data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    data = LOWER[data]
    rows = pa.Table.from_batches(slices)
    groups = pa.StructArray.from_arrays([rows["lang"].combine_chunks(), rows["source"].combine_chunks()], ["lang", "source"])
    numbers: dict[tuple, int] = {}
    of_row = np.array([numbers.setdefault((g["lang"], g["source"]), len(numbers)) for g in groups.to_pylist()], np.int64)
    starts, lengths, run, row = equal_runs(data, offsets)
    cell = run * len(numbers) + of_row[row]
    cells, n = np.unique(cell, return_counts=True)
    # Rows ascend inside a run, so a document's pointers in a run are neighbours.
    fresh = np.concatenate([[True], (run[1:] != run[:-1]) | (row[1:] != row[:-1])])[: len(run)]
    docs = np.bincount(np.searchsorted(cells, cell[fresh]), minlength=len(cells))
    names, terms = list(numbers), _strings(data, starts, lengths)
    group = pa.array(cells % len(numbers))
    return pa.RecordBatch.from_arrays([
        pa.array([lang for lang, _ in names], pa.string()).take(group), pa.array([s for _, s in names], pa.string()).take(group),
        terms.take(pa.array(cells // len(numbers))).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64)),
    ], schema=COUNTED_ARROW)


def _count(shard_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, data, offsets, size = [], [], [np.zeros(1, np.int64)], 0
        for batch, own, own_offsets in steps(batches, "text"):
            slices.append(batch)
            data.append(own)
            offsets.append(own_offsets[1:] + size)
            size += len(own)
            if size >= shard_bytes:
                yield _shard(slices, np.concatenate(data), np.concatenate(offsets))
                slices, data, offsets, size = [], [], [np.zeros(1, np.int64)], 0
        if size:
            yield _shard(slices, np.concatenate(data), np.concatenate(offsets))

    return run


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(empty_text("lang").alias("lang"), empty_text("source").alias("source"), empty_text().alias("text"))


def term_counts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it), of all terms.

    Reads text, lang and source, where null is ''; other columns are left out. Each row is a
    document, also if it repeats another.
    """
    runs = _plain(docs).mapInArrow(_count(shard_bytes), COUNTED_TYPE)
    return runs.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, size: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (size + SMOOTHING * terms)) in whole numbers; null without terms."""
    above = f"cast({n} + {SMOOTHING} as decimal(20,0)) * {SCALE}"
    return F.expr(f"1 + ({above}) div nullif({size} + {SMOOTHING} * terms, 0)").cast("long")


def kept_terms(counts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``counts`` of the terms that enough documents of their language have, and the language's ``total``."""
    in_lang = Window.partitionBy("lang", "term")
    summed = counts.withColumns({"total": F.sum("n").over(in_lang), "in_docs": F.sum("docs").over(in_lang)})
    return summed.where(F.col("in_docs") >= least_documents).select("lang", "source", "term", "n", "total")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Of every (lang, source): size and the language's size (occurrences of kept terms), terms, place in the language."""
    groups = _plain(docs).select("lang", "source").distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    once = kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
    langs = once.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_size"))
    joined = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return joined.withColumn("place", place)


def term_part(shares: DataFrame, most_terms: int = MOST_TERMS) -> DataFrame:
    """The terms whose share in the group is most above that in the language."""
    ahead = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    largest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return ahead.withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= most_terms)


PAIR_TYPE = "lang string, a int, b int, value long"
PAIR_ARROW = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


def _distances(terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of |p - q| over the terms of a slice for each source of one block with each of another."""
    keys = sources if sources.num_rows else terms
    lang, i, j = (keys[name][0].as_py() for name in ("lang", "i", "j"))
    place, none = sources["place"].to_numpy(), sources["p0"].to_numpy()
    by_place = np.argsort(place)
    place, none = place[by_place], none[by_place]
    column = terms["term"].combine_chunks().dictionary_encode()
    shares = np.repeat(none[:, None], max(1, len(column.dictionary)), axis=1)
    if len(column.dictionary):
        shares[np.searchsorted(place, terms["place"].to_numpy()), column.indices.to_numpy()] = terms["p"].to_numpy()
    else:
        shares[:] = 0
    block = place // BLOCK_SOURCES
    right = np.flatnonzero(block == j)
    found_a, found_b, found = [], [], []
    for a in np.flatnonzero(block == i).tolist():
        others = right[place[right] > place[a]]
        found.append(np.abs(shares[others] - shares[a]).sum(axis=1))
        found_a.append(np.full(len(others), place[a]))
        found_b.append(place[others])
    arrays = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (found_a, found_b, found)]
    a, b, value = pa.array(arrays[0].astype(np.int32)), pa.array(arrays[1].astype(np.int32)), pa.array(arrays[2])
    return pa.Table.from_arrays([pa.array([lang] * len(a), pa.string()), a, b, value], schema=PAIR_ARROW)


def pair_part(shares: DataFrame, sizes: DataFrame, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """Every two sources of a language: the sum of |p - q| over its kept terms.

    The terms of a language are dealt into slices and its sources into blocks; a slice of two
    blocks is compared as one matrix, and slices add up.
    """
    slices = F.ceil(F.col("terms") / slice_terms).cast("int")
    block = F.floor(F.col("place") / BLOCK_SOURCES).cast("int")
    blocks = F.floor((F.col("sources") - 1) / BLOCK_SOURCES).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks)).alias("other")
    keys = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    left = shares.withColumns({"slice": F.pmod(F.xxhash64("term"), slices).cast("int"), "block": block})
    left = left.select("lang", "slice", "block", "term", "place", "p", other).select("lang", "slice", *keys, "term", "place", "p")
    right = sizes.where("terms > 0").withColumns({"block": block, "p0": _share("0", "size")})
    right = right.select("*", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    right = right.select("lang", "slice", "block", "place", "p0", other).select("lang", "slice", *keys, "place", "p0")
    cell = ["lang", "slice", "i", "j"]
    parts = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_distances, PAIR_TYPE)
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one = sizes.select("lang", "source", F.col("place").alias("own"))
    two = sizes.select("lang", F.col("source").alias("item"), F.col("place").alias("others"))
    pairs = one.join(two, "lang").where("own <> others")
    pairs = pairs.withColumns({"a": F.least("own", "others"), "b": F.greatest("own", "others")})
    pairs = pairs.join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    farthest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(farthest))


def audit(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    most_terms: int = MOST_TERMS,
    shard_bytes: int = SHARD_BYTES,
    slice_terms: int = SLICE_TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of a language differ, and in which terms.

    Part ``pair`` has every other source of the language, part ``term`` the ``most_terms`` terms
    that the source has most above the language. Ranks go by value, then by item in UTF-8.
    Reads text, lang and source, where null is ''; other columns are left out. Repeated rows
    count as often as they are there. A group without kept terms has the shares that smoothing
    gives; a language without kept terms has pairs of value 0. No rows give no rows.
    """
    kept = stored(kept_terms(term_counts(docs, shard_bytes), least_documents), "divergence-terms")
    sizes = group_sizes(docs, kept)
    in_lang = Window.partitionBy("lang")
    sizes = stored(sizes.withColumn("sources", F.count(F.lit(1)).over(in_lang)), "divergence-groups")
    shares = kept.join(sizes, ["lang", "source"]).withColumns({"p": _share("n", "size"), "q": _share("total", "lang_size")})
    shares = stored(shares, "divergence-shares")
    parts = [("pair", pair_part(shares, sizes, slice_terms)), ("term", term_part(shares, most_terms))]
    found = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in parts]
    return found[0].unionByName(found[1])
