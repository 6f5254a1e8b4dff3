"""Repeated substrings across documents: common-prefix intervals of an enhanced suffix array.

A string of ``LENGTH`` bytes is told by an anchor: the position of the least of its first
``WINDOW`` hashed grams. Equal strings have their anchor at one offset, so all places of a
string start suffixes of equal prefix at their anchors. Each start in a text belongs to one
anchor; an anchor stands for the starts of one run, and for the bytes these cover.

1. Anchors are counted by the hash of the bytes that all strings of an anchor share, and by the
   hash of all bytes it stands for. An anchor whose whole context is there again is repeated.
2. Where anchors share the former but not the latter, the contexts of one anchor per class are
   compared. Their suffixes are sorted, the common-prefix lengths of neighbours are scanned
   with a stack, and each interval is a repeat with all its places. The bytes on the left of the
   places, sorted as well, tell which of them differ there (a maximal repeat) and how far the
   repeat reaches to the left. Reaches that add up to LENGTH are repeated.
3. Very large groups take another exact way: all their strings are hashed and counted.

Texts lie in buckets and do not move: what is wanted of them, and the spans found, go to their chunks.

Passages of ``WORDS`` words may have fewer bytes than LENGTH. They are found beside the strings,
with hashed words in place of bytes: anchors of words whose whole context another document has are
shared, and where only the part that all strings of an anchor share is there, its strings are counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens.llm.common import BYTE_VALUE, empty_text, hash_spans, mix, per_row, steps, stored, stored_in_buckets, word_spans

LENGTH = 400
GRAM = 32
WINDOW = 256
# Classes of one group that a task compares; beyond, strings are counted by hash.
GROUP_CLASSES = 50_000
PLACE_BITS = 28  # texts up to 256 MB
CHUNK_BITS = 9  # of a document's number: 512 documents a chunk, as many as an Arrow batch has
# Passages: over 50 words.
WORDS = 51
WORD_WINDOW = 32
WORD_GRAM = 16
BASE = np.uint64(0x9E6C63D0676A9A99)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def byte_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def word_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a step as 64-bit hashes, and the offsets of its rows in them."""
    starts, ends, rows = word_spans(data, offsets)
    return hash_spans(data, starts, ends), per_row(rows, len(offsets) - 1)


class Hashes:
    """Hashes of any substrings of a step, of bytes or of hashed words, by prefix sums."""

    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, seed: int = 0):
        if len(Hashes.powers) <= len(data):
            size = len(data) + 1
            Hashes.powers, Hashes.inverses = np.full(size, BASE), np.full(size, INVERSE)
            Hashes.powers[0] = Hashes.inverses[0] = 1
            Hashes.powers, Hashes.inverses = np.cumprod(Hashes.powers), np.cumprod(Hashes.inverses)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        own = np.uint64(seed)
        values = mix(BYTE_VALUE + own)[data] if data.dtype == np.uint8 else mix(data + own)
        np.cumsum(values * Hashes.powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * Hashes.inverses[starts] + (ends - starts).astype(np.uint64))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, window: int = WINDOW, gram: int = GRAM):
    """Row, place, first start and last start of every anchor of a step of bytes or hashed words.

    ``window`` and ``gram`` are powers of two with window + gram <= length.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes, size = BYTE_VALUE[data] if data.dtype == np.uint8 else data, 1
    factor = BASE
    with np.errstate(over="ignore"):
        while size < gram:
            hashes = hashes[:-size] * factor + hashes[size:]
            factor, size = factor * factor, size * 2
    least = (mix(hashes) >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS)
    least |= np.arange(len(least), dtype=np.uint64)
    size = 1
    while size < window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + length <= ends)
    if not len(starts):
        return none, none, none, none
    place = (least[starts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    rows = np.searchsorted(offsets, starts[first], "right") - 1
    return rows, place[first], starts[first], starts[last]


def prefix_intervals(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(depth, from, to) of all common-prefix intervals; common[i] is that of suffixes i and i + 1.

    A stack holds the open intervals; children come before parents.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*common.tolist(), 0]):
        start = i
        while stack and stack[-1][0] > depth:
            inner, start = stack.pop()
            yield inner, start, i
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, start))


def shared_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


class _Least:
    """Range minima of an array by doubling."""

    def __init__(self, values: np.ndarray):
        self.rows, size = [values], 1
        while size * 2 <= len(values):
            self.rows.append(np.minimum(self.rows[-1][:-size], self.rows[-1][size:]))
            size *= 2

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Minima of [start, end), none of them empty."""
        depth = np.floor(np.log2(ends - starts)).astype(int)
        out = np.empty(len(starts), np.int64)
        for d in np.unique(depth):
            own = depth == d
            out[own] = np.minimum(self.rows[d][starts[own]], self.rows[d][ends[own] - (1 << int(d))])
        return out


def repeats(lefts: list[bytes], rights: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Maximal repeat groups: depth to the right, the places, and each place's reach to the left.

    The reach is the most bytes before the place that another place of the group shares. Groups
    are left-diverse: an interval whose places all share the byte on the left is reported too,
    with a reach that says so, since a place may reach further with some of the others.
    """
    order = np.array(sorted(range(len(rights)), key=rights.__getitem__))
    common = np.array([shared_prefix(rights[a], rights[b]) for a, b in zip(order[:-1], order[1:], strict=True)], np.int64)
    reversed_ = [x[::-1] for x in lefts]
    by_left = sorted(range(len(lefts)), key=reversed_.__getitem__)
    rank = np.empty(len(lefts), np.int64)
    rank[by_left] = np.arange(len(lefts))
    near = np.array([shared_prefix(reversed_[a], reversed_[b]) for a, b in zip(by_left[:-1], by_left[1:], strict=True)], np.int64)
    least = _Least(near)
    for depth, first, last in prefix_intervals(common):
        places = order[first : last + 1]
        ranks = rank[places]
        sort = np.argsort(ranks)
        between = least.of(ranks[sort][:-1], ranks[sort][1:])
        reach = np.zeros(len(places), np.int64)
        reach[sort[1:]] = between
        reach[sort[:-1]] = np.maximum(reach[sort[:-1]], between)
        yield depth, places, reach


def reaches(lefts: list[bytes], rights: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes to the left and right of each place that a repeat of at least ``length`` covers."""
    left, right = np.zeros(len(lefts), np.int64), np.zeros(len(lefts), np.int64)
    if len(lefts) == 2:  # one interval
        a, b = shared_prefix(lefts[0][::-1], lefts[1][::-1]), shared_prefix(rights[0], rights[1])
        if a + b >= length:
            left[:], right[:] = a, b
        return left, right
    for depth, places, reach in repeats(lefts, rights):
        enough = reach + depth >= length
        own = places[enough]
        left[own] = np.maximum(left[own], reach[enough])
        right[own] = np.maximum(right[own], depth)
    return left, right


SPOT_FIELDS = [("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("head", pa.int64()), ("whole", pa.int64())]
SPOT_TYPE = "place int, low int, high int, head long, whole long"
CONTEXT_TYPE = "kind int, key long, key2 long, doc long, twin long, place int, low int, context binary"
CONTEXT_ARROW = pa.schema([
    ("kind", pa.int32()), ("key", pa.int64()), ("key2", pa.int64()), ("doc", pa.int64()), ("twin", pa.int64()),
    ("place", pa.int32()), ("low", pa.int32()), ("context", pa.binary()),
])
SPAN_ARROW = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
SPAN_TYPE = "doc long, start int, end int"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _find_anchors(length: int, window: int, gram: int, keys: list[str], letters=byte_letters):
    """Anchors of the texts, with the columns ``keys`` of their rows."""
    schema, always = pa.schema([*((k, pa.int64()) for k in keys), *SPOT_FIELDS]), length - window + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches, "text"):
            data, offsets = letters(data, offsets)
            rows, place, low, high = anchors(data, offsets, length, window, gram)
            if not len(rows):
                continue
            hashes, base = Hashes(data), offsets[rows]
            head = hashes.of(place, place + always)
            shape = mix(((place - low) << 20 | (place - high)).astype(np.uint64))
            whole = mix(hashes.of(low, high + length) + shape)
            own = [batch.column(k).take(pa.array(rows)) for k in keys]
            numbers = [pa.array((x - base).astype(np.int32)) for x in (place, low, high)]
            yield pa.RecordBatch.from_arrays([*own, *numbers, _signed(head), _signed(whole)], schema=schema)

    return run


def _word_strings(text: bytes, doc: int, twin: int, passages: list[dict], words: int) -> pa.RecordBatch:
    """Hashes of the strings of word anchors: kind 2, or 3 where two documents are known to have them."""
    raw = np.frombuffer(text, np.uint8)
    letters, _ = word_letters(raw, np.array([0, len(raw)]))
    starts = np.concatenate([np.arange(a["low"], a["high"] + 1) for a in passages])
    kinds = np.repeat([2 + a["shared"] for a in passages], [a["high"] + 1 - a["low"] for a in passages])
    return _strings(kinds, [Hashes(letters, seed).of(starts, starts + words) for seed in (0, 1)], doc, twin, starts)


def _strings(kinds: np.ndarray, keys: list[np.ndarray], doc: int, twin: int, starts: np.ndarray) -> pa.RecordBatch:
    n = len(starts)
    own = [pa.repeat(pa.scalar(x, pa.int64()), n) for x in (doc, twin)]
    columns = [pa.array(kinds.astype(np.int32)), *map(_signed, keys), *own, pa.array(starts.astype(np.int32))]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=CONTEXT_ARROW)


def _contexts(length: int, group_classes: int, words: int):
    """Contexts of anchors to compare (kind 0), or the hashes of their strings (kind 1; of words, kinds 2 and 3)."""

    def run(chunk: pa.Table, wanted: pa.Table) -> pa.Table:
        by_doc: dict[int, list[dict]] = {}
        for a in wanted.to_pylist():
            by_doc.setdefault(a["doc"], []).append(a)
        out, plain = [], []
        for doc, twin, text in zip(chunk["doc"].to_pylist(), chunk["twin"].to_pylist(), chunk["text"], strict=True):
            own = by_doc.get(doc)
            if not own:
                continue
            text = text.as_py().encode()
            passages = [a for a in own if a["shared"] is not None]
            if passages:
                out.append(_word_strings(text, doc, twin, passages, words))
            found = [a for a in own if a["shared"] is None]
            for a in found:
                if a["classes"] <= group_classes:
                    context = text[a["low"] : a["high"] + length]
                    plain.append((0, a["head"], 0, doc, twin, a["place"], a["low"], context))
            many = [np.arange(a["low"], a["high"] + 1) for a in found if a["classes"] > group_classes]
            if many:
                data, starts = np.frombuffer(text, np.uint8), np.concatenate(many)
                keys = [Hashes(data, seed).of(starts, starts + length) for seed in (0, 1)]
                out.append(_strings(np.ones(len(starts)), keys, doc, twin, starts))
        if plain:
            columns = [pa.array(x, field.type) for x, field in zip(zip(*plain, strict=True), CONTEXT_ARROW, strict=True)]
            out.append(pa.RecordBatch.from_arrays(columns, schema=CONTEXT_ARROW))
        return pa.Table.from_batches(out, schema=CONTEXT_ARROW).combine_chunks()

    return run


def _compare(length: int):
    """Spans of the anchors of each group; groups follow each other by key."""

    def spans(group: list[dict]) -> list[dict]:
        lefts = [r["context"][: r["place"] - r["low"]] for r in group]
        rights = [r["context"][r["place"] - r["low"] :] for r in group]
        left, right = reaches(lefts, rights, length)
        return [
            {"doc": r["doc"], "start": r["place"] - a, "end": r["place"] + b}
            for r, a, b in zip(group, left.tolist(), right.tolist(), strict=True)
            if a + b >= length
        ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if group and group[0]["key"] != row["key"]:
                    found += spans(group) if len(group) > 1 else []
                    group = []
                group.append(row)
            yield pa.RecordBatch.from_pylist(found, schema=SPAN_ARROW)
        yield pa.RecordBatch.from_pylist(spans(group) if len(group) > 1 else [], schema=SPAN_ARROW)

    return run


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of spans that overlap or touch."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _numbered(docs: DataFrame) -> DataFrame:
    """The texts with the number of their row, that of its chunk, and a hash that rows alike in doc_id and text share."""
    texts = docs.select(F.col("doc_id").cast("long"), empty_text().alias("text"), F.monotonically_increasing_id().alias("doc"))
    twin = F.xxhash64("doc_id", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored_in_buckets(texts.select(_chunk(), "doc", twin.alias("twin"), "doc_id", "text"), "repeat-texts", "chunk", parts)


def _chunk():
    return F.shiftright("doc", CHUNK_BITS).alias("chunk")


def _word_anchors(texts: DataFrame, words: int, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Spans, in words, of anchors whose whole context another document has; anchors to count strings of.

    The latter share their head with another document. Those with ``shared`` stand for a class
    that two documents have, so that its strings are known to be shared.
    """
    # Words and the blanks between them.
    longer = texts.where(F.octet_length("text") >= 2 * words - 1).select("doc", "twin", "text")
    find = _find_anchors(words, window, gram, ["doc", "twin"], word_letters)
    # Where an anchor lies among its starts is not asked again.
    found = stored(longer.mapInArrow(find, f"doc long, twin long, {SPOT_TYPE}").drop("place"), "passage-anchors")
    heads = stored(found.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("head"), "passage-heads")
    again = stored(found.join(heads, "head"), "passage-groups")
    place = F.struct("doc", "low")
    classes = again.groupBy("head", "whole").agg(F.min("twin").alias("least"), F.max("twin").alias("most"), F.min(place).alias("one"))
    classes = stored(classes, "passage-classes")
    groups = classes.groupBy("head").agg(
        F.count(F.lit(1)).alias("classes"), F.min("least").alias("first"), F.max("most").alias("last")
    )
    groups = stored(groups.where("first <> last").drop("first", "last"), "passage-counts")
    shared = (F.col("least") != F.col("most")).cast("int").alias("shared")
    known = stored(classes.join(groups, "head").select("head", "whole", "one", "classes", shared), "passage-known")
    counted = (F.col("classes") > 1) & ((F.col("shared") == 0) | place.eqNullSafe(F.col("one")))
    members = again.join(known, ["head", "whole"]).select("doc", "low", "high", "shared", counted.alias("counted"))
    members = stored(members, "passage-members")
    spans = members.where("shared = 1").select("doc", F.col("low").alias("start"), (F.col("high") + words).alias("end"))
    return spans, members.where("counted").select("doc", "low", "high", "shared")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, window: int = WINDOW, gram: int = GRAM, group_classes: int = GROUP_CLASSES
) -> DataFrame:
    """doc_id, h (hash of the text), start, end in bytes: spans that repeated strings cover.

    Spans of one text may overlap.
    """
    texts = _numbered(docs)
    spans = _spans(texts, length, window, gram, group_classes)[0]
    own = texts.select("doc", "doc_id", F.xxhash64("text").alias("h"))
    return spans.join(own, "doc").select("doc_id", "h", "start", "end")


def _spans(
    texts: DataFrame, length: int, window: int, gram: int, group_classes: int, words: int = 0, word_window: int = 0, word_gram: int = 0
) -> tuple[DataFrame, DataFrame | None]:
    """Spans of repeated strings, in bytes, and of passages, in words, if ``words`` are given."""
    longer = texts.where(F.octet_length("text") >= length)
    find = _find_anchors(length, window, gram, ["doc"])
    found = stored(longer.select("doc", "text").mapInArrow(find, f"doc long, {SPOT_TYPE}"), "repeat-anchors")
    groups = found.groupBy("head").agg(
        F.count(F.lit(1)).alias("n"), F.min("whole").alias("least"), F.max("whole").alias("most")
    )
    # Stored, so that the join has a plain shuffle on either side and hot groups can be split.
    groups = stored(groups.where("n > 1").drop("n"), "repeat-heads")
    again = stored(found.join(groups, "head"), "repeat-groups")
    covered = lambda df: df.select("doc", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    alike = covered(again.where("least = most"))

    mixed = again.where("least < most").drop("least", "most")
    classes = mixed.groupBy("head", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "place")).alias("one"))
    counts = classes.groupBy("head").agg(F.count(F.lit(1)).alias("classes"))
    known = stored(classes.join(stored(counts, "repeat-counts"), "head"), "repeat-known")
    mixed = stored(mixed.join(known, ["head", "whole"]), "repeat-classes")
    repeated = covered(mixed.where("n > 1"))
    is_one = F.struct("doc", "place").eqNullSafe(F.col("one"))
    picked = mixed.where(is_one).select("doc", "place", "low", "high", "head", "classes")
    picked = picked.withColumn("shared", F.lit(None).cast("int"))
    if words:
        shared, counted = _word_anchors(texts, words, word_window, word_gram)
        picked = picked.unionByName(counted, allowMissingColumns=True)
        longer = texts.where(F.octet_length("text") >= min(length, 2 * words - 1))
    asked = longer.select("chunk", "doc", "twin", "text").groupBy("chunk").cogroup(picked.withColumn("chunk", _chunk()).groupBy("chunk"))
    contexts = stored(asked.applyInArrow(_contexts(length, group_classes, words), CONTEXT_TYPE), "repeat-contexts")

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = contexts.where("kind = 0").select("key", "doc", "place", "low", "context")
    compared = once.repartition(parts, "key").sortWithinPartitions("key", "doc", "place")
    compared = compared.mapInArrow(_compare(length), SPAN_TYPE)
    strings = contexts.where("kind = 1").select("key", "key2", "doc", F.col("place").alias("start"))
    twice = strings.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hashed = strings.join(twice, ["key", "key2"]).select("doc", "start", (F.col("start") + length).alias("end"))
    spans = alike.unionByName(repeated).unionByName(compared).unionByName(hashed)
    if not words:
        return spans, None

    strings = contexts.where("kind > 1").select("key", "key2", "doc", "twin", "kind", F.col("place").alias("start"))
    twice = strings.groupBy("key", "key2").agg(F.min("twin").alias("least"), F.max("twin").alias("most"), F.max("kind").alias("kind"))
    twice = stored(twice.where("least <> most or kind = 3").select("key", "key2"), "passage-strings")
    hashed = strings.where("kind = 2").select("key", "key2", "doc", "start").join(twice, ["key", "key2"])
    hashed = hashed.select("doc", "start", (F.col("start") + words).alias("end"))
    return spans, shared.unionByName(hashed)


KEPT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
    *((name, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))) for name in ("removed", "passages")),
])
KEPT_TYPE = "doc_id long, n_bytes long, kept binary, removed array<struct<start: int, end: int>>, passages array<struct<start: int, end: int>>"


def _remove(chunk: pa.Table, spans: pa.Table) -> pa.Table:
    found: dict[tuple, list[tuple[int, int]]] = {}
    for doc, words, start, end in zip(*(spans[c].to_pylist() for c in ("doc", "words", "start", "end")), strict=True):
        found.setdefault((doc, words), []).append((start, end))
    out = []
    for key, doc, text in zip(chunk["doc_id"].to_pylist(), chunk["doc"].to_pylist(), chunk["text"], strict=True):
        raw = text.as_py().encode()
        runs, passages = (merge_spans(found.get((doc, words), [])) for words in (False, True))
        edges = [0, *[x for run in runs for x in run], len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if runs else raw
        lists = {k: [{"start": a, "end": b} for a, b in v] for k, v in (("removed", runs), ("passages", passages))}
        out.append({"doc_id": key, "n_bytes": len(raw), "kept": kept, **lists})
    return pa.Table.from_pylist(out, schema=KEPT_ARROW)


def remove(
    docs: DataFrame,
    length: int = LENGTH,
    window: int = WINDOW,
    gram: int = GRAM,
    group_classes: int = GROUP_CLASSES,
    words: int = WORDS,
    word_window: int = WORD_WINDOW,
    word_gram: int = WORD_GRAM,
) -> DataFrame:
    """doc_id, n_bytes, kept (bytes), removed (maximal runs of removed bytes) of every text, and passages.

    Every byte that a string of ``length`` bytes covers is removed if that string starts at
    another place too, in any text, the same one included. Strings are judged on the input. A
    null text is empty; texts shorter than ``length`` keep all. Rows that repeat a text repeat
    its strings. Passages are the maximal runs of words that a run of ``words`` words covers
    which another document has too, whatever blanks part them: reported with the numbers of
    their words, and not removed for it. Rows alike in doc_id and text are one document there.
    Reads doc_id and text, other columns are left out. No rows give no rows.
    """
    texts = _numbered(docs)
    spans, passages = _spans(texts, length, window, gram, group_classes, words, word_window, word_gram)
    spans = spans.withColumn("words", F.lit(False)).unionByName(passages.withColumn("words", F.lit(True)))
    by_chunk = texts.select("chunk", "doc", "doc_id", "text").groupBy("chunk")
    return by_chunk.cogroup(spans.withColumn("chunk", _chunk()).groupBy("chunk")).applyInArrow(_remove, KEPT_TYPE)
