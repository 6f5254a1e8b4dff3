"""Byte-level BPE encoding and decoding, each distinct word encoded once for the whole corpus.

A word here is a run of whole pre-tokens: the text is cut before every blank that a character
other than white space follows. No match of the pattern crosses such a place, and no match
depends on what lies before it, so the pre-tokens of the words are those of the text.

1. Scan tasks cut their documents into words and number the distinct words of a chunk of
   documents; a chunk keeps its documents as word numbers, in the order of their positions,
   and its distinct words, dealt into parts by the hash of the word.
2. One shuffle brings equal words of all chunks together: each is encoded once and its ids go
   back to every chunk that has it.
3. The chunk's documents meet the ids of its words and are put together by position.

Decoding looks ids up in the table of token bytes, whose size the vocabulary file bounds.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens.llm.common import stored_in_buckets

# Text bytes whose words one chunk numbers.
CHUNK_BYTES = 32 << 20
# The most frequent words of a chunk are numbered by frequency, which makes the numbers compress.
FREQUENT = 1 << 16
# Longer pre-tokens are merged by a heap instead of a scan for the lowest rank.
SCAN_BYTES = 48

BLANK_RUN = re.compile(r" \s| $")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with one base64 token and rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def words_of(text: str) -> list[str]:
    """The text cut before each blank that something other than white space follows."""
    first, *rest = text.split(" ")
    if not BLANK_RUN.search(text):
        words = [" " + piece for piece in rest]
        return [first, *words] if first else words
    words = [first]
    for piece in rest:
        if piece and not piece[0].isspace():
            words.append(" " + piece)
        else:
            words[-1] += " " + piece
    return words if words[0] else words[1:]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of a pre-token: the neighbours of lowest joint rank merge first, the left one on ties."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > SCAN_BYTES:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    ends = list(range(1, len(piece) + 1))  # end of the part that starts here
    before = list(range(-1, len(piece) - 1))
    alive = [True] * len(piece)
    queue: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = ends[start]
        if middle < len(piece):
            rank = ranks.get(piece[start : ends[middle]])
            if rank is not None:
                heapq.heappush(queue, (rank, start, ends[middle]))

    for start in range(len(piece)):
        offer(start)
    while queue:
        _, start, end = heapq.heappop(queue)
        middle = ends[start]
        if not alive[start] or middle >= len(piece) or ends[middle] != end:
            continue
        alive[middle], ends[start] = False, end
        if end < len(piece):
            before[end] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    return [ranks[piece[s : ends[s]]] for s in range(len(piece)) if alive[s]]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, compressed by byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


CHUNK_TYPE = (
    "chunk long, keys array<long>, counts binary, codes binary, frequent binary,"
    " words array<struct<part: int, lengths: binary, bytes: binary>>"
)
CHUNK_ARROW = pa.schema([
    ("chunk", pa.int64()), ("keys", pa.list_(pa.int64())), ("counts", pa.binary()), ("codes", pa.binary()), ("frequent", pa.binary()),
    ("words", pa.list_(pa.struct([("part", pa.int32()), ("lengths", pa.binary()), ("bytes", pa.binary())]))),
])


def _part(word: bytes, parts: int) -> int:
    # Without closing marks, so that " word" and " word," meet and share the pre-token's merges.
    return zlib.crc32(word.rstrip(b".,;:!?") or word) % parts


def _chunk_row(number: int, keys: list, codes: list[np.ndarray], words: _Numbers, parts: int) -> pa.RecordBatch:
    dealt: list[list[tuple[bytes, int]]] = [[] for _ in range(parts)]
    for word, code in words.items():
        raw = word.encode()
        dealt[_part(raw, parts)].append((raw, code))
    place, packed, at = np.zeros(len(words), np.uint32), [], 0
    for part, entries in enumerate(dealt):
        if entries:
            entries.sort()
            raws, old = zip(*entries, strict=True)
            place[list(old)] = np.arange(at, at + len(old))
            at += len(old)
            lengths = pack(np.fromiter(map(len, raws), np.int64, len(raws)))
            packed.append({"part": part, "lengths": lengths, "bytes": zstandard.compress(b"".join(raws), 9)})
    flat = np.concatenate([np.zeros(0, np.uint32), *codes]).astype(np.int64)
    frequent = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")[:FREQUENT]
    number_of = place + np.uint32(FREQUENT)
    number_of[frequent] = np.arange(len(frequent))
    row = {
        "chunk": number, "keys": keys, "counts": pack(np.array([len(c) for c in codes])),
        "codes": pack(number_of[flat]), "frequent": pack(place[frequent]), "words": packed,
    }
    return pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)


def _cut(parts: int, chunk_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        keys, codes, words, size = [], [], _Numbers(), 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                cut = words_of(text)
                keys.append(key)
                codes.append(np.fromiter(map(words.__getitem__, cut), np.uint32, len(cut)))
                size += len(text)
                if size >= chunk_bytes:
                    yield _chunk_row(number, keys, codes, words, parts)
                    number, keys, codes, words, size = number + 1, [], [], _Numbers(), 0
        if keys:
            yield _chunk_row(number, keys, codes, words, parts)

    return run


IDS_TYPE = "chunk long, part int, counts binary, ids binary"
IDS_ARROW = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary())])


def _encode_words(ranks, pattern: str):
    """Equal words are in one task: the first sight of a word encodes it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, matches = ranks.value, regex.compile(pattern).findall
        known: dict[bytes, list[int]] = {}
        pieces: dict[str, list[int]] = {}

        def encode(word: bytes) -> list[int]:
            ids: list[int] = []
            for piece in matches(word.decode()):
                if piece not in pieces:
                    pieces[piece] = merge(piece.encode(), table)
                ids += pieces[piece]
            return ids

        for batch in batches:
            for row in batch.to_pylist():
                raw, ends = zstandard.decompress(row["bytes"]), np.cumsum(unpack(row["lengths"])).tolist()
                counts, flat, start = [], [], 0
                for end in ends:
                    word = raw[start:end]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encode(word)
                    counts.append(len(ids))
                    flat += ids
                    start = end
                out = {"chunk": row["chunk"], "part": row["part"], "counts": pack(np.array(counts)), "ids": pack(np.array(flat))}
                yield pa.RecordBatch.from_pylist([out], schema=IDS_ARROW)

    return run


ENCODED_TYPE = "doc_id long, ids array<int>"
ENCODED_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _assemble(chunk: pa.Table, words: pa.Table) -> pa.Table:
    out = []
    parts = sorted(words.to_pylist(), key=lambda r: r["part"])
    sizes = np.concatenate([np.zeros(0, np.uint32), *[unpack(r["counts"]) for r in parts]]).astype(np.int64)
    ids = np.concatenate([np.zeros(0, np.uint32), *[unpack(r["ids"]) for r in parts]]).astype(np.int32)
    begins = np.cumsum(sizes) - sizes
    for row in chunk.to_pylist():
        codes, counts = unpack(row["codes"]).astype(np.int64), unpack(row["counts"]).astype(np.int64)
        frequent = np.zeros(FREQUENT, np.int64)
        listed = unpack(row["frequent"])
        frequent[: len(listed)] = listed
        codes = np.where(codes < FREQUENT, frequent[np.minimum(codes, FREQUENT - 1)], codes - FREQUENT)
        edges = np.concatenate([[0], np.cumsum(counts)])
        step = max(1, len(row["keys"]) // 16)
        for first in range(0, len(row["keys"]), step):
            last = min(first + step, len(row["keys"]))
            own = codes[edges[first] : edges[last]]
            n = sizes[own]
            ends = np.concatenate([[0], np.cumsum(n)])
            flat = ids[np.repeat(begins[own] - ends[:-1], n) + np.arange(ends[-1])]
            offsets = ends[edges[first : last + 1] - edges[first]].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            out.append(pa.RecordBatch.from_arrays([pa.array(row["keys"][first:last], pa.int64()), lists], schema=ENCODED_ARROW))
    return pa.Table.from_batches(out, schema=ENCODED_ARROW)


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, parts: int | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, special tokens never used.

    Reads doc_id and text; other columns are left out. A null or empty text has no ids. Each
    row is encoded by itself, so repeated rows come out repeated, also under one doc_id. No
    rows give no rows. ``parts`` deals the distinct words: by default the session's number of
    shuffle partitions, each of which must hold its share of the distinct words in memory.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(parts, chunk_bytes), CHUNK_TYPE)
    chunks = stored_in_buckets(chunks, "bpe-chunks", "chunk", parts)
    shared = spark.sparkContext.broadcast(ranks)
    words = chunks.select("chunk", F.explode("words").alias("w")).select("chunk", "w.*").repartition(parts, "part")
    ids = words.mapInArrow(_encode_words(shared, pattern), IDS_TYPE)
    by_chunk = chunks.select("chunk", "keys", "counts", "codes", "frequent").groupBy("chunk")
    return by_chunk.cogroup(ids.groupBy("chunk")).applyInArrow(_assemble, ENCODED_TYPE)


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens in the order of their ids, and where each begins."""
    by_id = [b""] * (max(ranks.values()) + 1 if ranks else 0)
    for token, rank in ranks.items():
        by_id[rank] = token
    begins = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
    return np.frombuffer(b"".join(by_id), np.uint8), begins


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids and the decoded ``bytes``. Null or no ids give no bytes; an unknown id fails."""
    spark: SparkSession = encoded.sparkSession
    shared = spark.sparkContext.broadcast(token_bytes(ranks))
    schema = pa.schema([*ENCODED_ARROW, ("bytes", pa.large_binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, begins = shared.value
        sizes = np.diff(begins)
        for batch in batches:
            lists = batch.column(1)
            if lists.null_count:
                lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            n = sizes[ids]
            ends = np.concatenate([[0], np.cumsum(n)])
            flat = data[np.repeat(begins[ids] - ends[:-1], n) + np.arange(ends[-1])]
            offsets = pa.py_buffer(np.ascontiguousarray(ends[edges]))
            column = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, offsets, pa.py_buffer(flat)])
            keys = batch.column(0)
            yield pa.RecordBatch.from_arrays([keys, lists.cast(pa.list_(pa.int32())), column], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, f"{ENCODED_TYPE}, bytes binary")
