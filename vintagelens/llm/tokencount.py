"""Token counts without ids: pieces are counted once per distinct pre-token of the corpus.

For tokenizers that drop white space: their pre-tokens lie inside words, which are told apart
by blanks, and a word always has the same pre-tokens.

1. Scan tasks turn chunks of documents into per-document pre-token frequencies: for each
   document the numbers of its distinct pre-tokens and how often it has them. A chunk keeps its
   distinct pre-tokens in the order of a hash.
2. One shuffle brings equal pre-tokens of all chunks together, in parts that hold a bounded
   number of them. There the pieces of each distinct pre-token are counted once.
3. Counts go back to the chunks, which lie in buckets and do not move: a document's tokens are
   the sum of frequency times pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vintagelens.llm.bpe import pack, unpack
from vintagelens.llm.common import WORD, stored_in_buckets

# Text characters whose pre-tokens one chunk numbers; a longer text is a chunk of its own.
CHUNK_CHARS = 16 << 20
# Pre-tokens of all chunks that one part counts, and so the most it can have to remember.
PART_WORDS = 500_000
# Words that one call of the tokenizer cuts.
CALL_WORDS = 1_000


class Pieces:
    """Pre-tokens of words, and the number of tokens of a pre-token.

    A string of an added token is one token, as by the library's default. It stands among the
    pre-tokens behind a blank, which no other pre-token has.
    """

    def __init__(self, definition: str):
        tokenizer = Tokenizer.from_str(definition)
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("added tokens must be plain strings of the raw text")
        self.added = sorted((t.content for t in added), key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")").split
        self.model, self.splitter, self.normalizer = tokenizer.model, tokenizer.pre_tokenizer, tokenizer.normalizer
        if [p for p, _ in self._pre_tokens("b c\td")[0]] != [p for w in "bcd" for p, _ in self._pre_tokens(w)[0]]:
            raise ValueError("the tokenizer keeps white space; its pre-tokens are not parts of words")

    def _pre_tokens(self, text: str) -> tuple[list, str]:
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        return self.splitter.pre_tokenize_str(text), text

    def cut(self, words: list[str]) -> list[list[str]]:
        """Pre-tokens of each word."""
        out: list[list[str]] = [[] for _ in words]
        together = []
        for i, word in enumerate(words):
            if any(a in word for a in self.added) or word.split() != [word]:
                for k, piece in enumerate(self.split_added(word) if self.added else [word]):
                    out[i] += [" " + piece] if k % 2 else [p for p, _ in self._pre_tokens(piece)[0]]
            else:
                together.append(i)
        for first in range(0, len(together), CALL_WORDS):
            block = together[first : first + CALL_WORDS]
            found, text = self._pre_tokens(" ".join([words[i] for i in block]))
            ends = np.cumsum([len(w) + 1 for w in text.split(" ")])
            if len(ends) != len(block):
                raise ValueError("the tokenizer's normalizer adds or removes blanks")
            starts = np.array([start for _, (start, _) in found], np.int64)
            for (piece, _), at in zip(found, np.searchsorted(ends, starts, "right").tolist(), strict=True):
                out[block[at]].append(piece)
        return out

    def count(self, piece: str) -> int:
        return 1 if piece.startswith(" ") else len(self.model.tokenize(piece))


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


CHUNK_TYPE = (
    "chunk long, keys array<long>, sizes array<long>, distinct binary, numbers binary, times binary,"
    " n_words long, lengths binary, bytes binary"
)
CHUNK_ARROW = pa.schema([
    ("chunk", pa.int64()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("distinct", pa.binary()),
    ("numbers", pa.binary()), ("times", pa.binary()), ("n_words", pa.int64()), ("lengths", pa.binary()), ("bytes", pa.binary()),
])


def frequencies(rows: list[np.ndarray], members: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of word numbers: how many distinct pre-tokens each has, their numbers, how often each.

    ``members`` are the pre-token numbers of each word. Numbers ascend inside a row.
    """
    flat = np.concatenate([np.zeros(0, np.int64), *rows])
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    sizes = np.fromiter(map(len, members), np.int64, len(members))
    inner = np.fromiter((p for m in members for p in m), np.int64, int(sizes.sum()))
    width = int(inner.max()) + 1 if len(inner) else 1
    n = sizes[flat]
    begins = (np.cumsum(sizes) - sizes)[flat]
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    cells, times = np.unique(np.repeat(row * width, n) + inner[np.repeat(begins, n) + within], return_counts=True)
    return np.bincount(cells // width, minlength=len(rows)), cells % width, times


def deltas(numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Steps between the ascending numbers of each row; the first of a row stands by itself."""
    steps = np.diff(numbers, prepend=0)
    first = (np.cumsum(counts) - counts)[counts > 0]
    steps[first] = numbers[first]
    return steps


def undo_deltas(steps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    sums = np.concatenate([[0], np.cumsum(steps)])
    return sums[1:] - np.repeat(sums[ends - counts], counts)


def _chunk_row(number: int, keys: list, sizes: list, rows: list[np.ndarray], words: _Numbers, pieces: Pieces) -> pa.RecordBatch:
    found = _Numbers()
    members = [[found[p] for p in own] for own in pieces.cut(list(words))]
    raws = [p.encode() for p in found]
    order = np.argsort(np.fromiter(map(zlib.crc32, raws), np.int64, len(raws)), kind="stable")
    place = np.zeros(len(raws), np.int64)
    place[order] = np.arange(len(raws))
    place = place.tolist()
    distinct, numbers, times = frequencies(rows, [[place[p] for p in own] for own in members])
    raws = [raws[i] for i in order.tolist()]
    row = {
        "chunk": number, "keys": keys, "sizes": sizes, "distinct": pack(distinct), "numbers": pack(deltas(numbers, distinct)),
        "times": pack(times), "n_words": len(raws), "lengths": pack(np.fromiter(map(len, raws), np.int64, len(raws))),
        "bytes": zstandard.compress(b"".join(raws), 9),
    }
    return pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)


def _cut(definition, chunk_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, pieces, words_of = TaskContext.get(), Pieces(definition.value), re.compile(WORD).findall
        number = (task.partitionId() if task else 0) << 32
        keys, sizes, rows, words, held = [], [], [], _Numbers(), 0
        for batch in batches:
            for key, size, text in zip(*[batch.column(i).to_pylist() for i in (0, 1)], batch.column(2), strict=True):
                text = text.as_py() or ""
                cut = words_of(text)
                keys.append(key)
                sizes.append(size)
                rows.append(np.fromiter(map(words.__getitem__, cut), np.int32, len(cut)))
                held += len(text)
                if held >= chunk_chars:
                    yield _chunk_row(number, keys, sizes, rows, words, pieces)
                    number, keys, sizes, rows, words, held = number + 1, [], [], [], _Numbers(), 0
        if keys:
            yield _chunk_row(number, keys, sizes, rows, words, pieces)

    return run


DEALT_TYPE = "part long, chunk long, lengths binary, bytes binary"
DEALT_ARROW = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("lengths", pa.binary()), ("bytes", pa.binary())])


def _deal(parts: int):
    """The pre-tokens of a chunk lie in hash order, so each part is a slice of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw, lengths = zstandard.decompress(row["bytes"]), unpack(row["lengths"]).astype(np.int64)
                ends = np.cumsum(lengths)
                hashes = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                part = (np.array(hashes, np.uint64) * np.uint64(parts)) >> np.uint64(32)
                edges = [0, *(np.flatnonzero(np.diff(part.astype(np.int64))) + 1).tolist(), len(part)] if len(part) else [0]
                begins = np.concatenate([[0], ends])
                for first, last in zip(edges[:-1], edges[1:], strict=True):
                    own = raw[begins[first] : begins[last]]
                    out = {"part": int(part[first]), "chunk": row["chunk"], "lengths": pack(lengths[first:last]), "bytes": zstandard.compress(own, 9)}
                    yield pa.RecordBatch.from_pylist([out], schema=DEALT_ARROW)

    return run


COUNTED_TYPE = "chunk long, part long, counts binary"
COUNTED_ARROW = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("counts", pa.binary())])


def _count(definition):
    """Rows come by part; what has been counted is forgotten when the part ends."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part, known = None, None, {}
        for batch in batches:
            pieces = pieces or Pieces(definition.value)
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, known = row["part"], {}
                raw, start, counts = zstandard.decompress(row["bytes"]), 0, []
                for end in np.cumsum(unpack(row["lengths"]).astype(np.int64)).tolist():
                    word = raw[start:end]
                    if word not in known:
                        known[word] = pieces.count(word.decode())
                    counts.append(known[word])
                    start = end
                out = {"chunk": row["chunk"], "part": part, "counts": pack(np.array(counts))}
                yield pa.RecordBatch.from_pylist([out], schema=COUNTED_ARROW)

    return run


TOTAL_TYPE = "doc_id long, n_bytes long, n_tokens long"
TOTAL_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _total(chunk: pa.Table, counted: pa.Table) -> pa.Table:
    dealt = sorted(counted.select(["part", "counts"]).to_pylist(), key=lambda r: r["part"])
    pieces = np.concatenate([np.zeros(0, np.int64), *[unpack(r["counts"]).astype(np.int64) for r in dealt]])
    out = []
    for row in chunk.to_pylist():
        distinct = unpack(row["distinct"]).astype(np.int64)
        numbers = undo_deltas(unpack(row["numbers"]).astype(np.int64), distinct)
        sums = np.concatenate([[0], np.cumsum(unpack(row["times"]).astype(np.int64) * pieces[numbers])])
        ends = np.cumsum(distinct)
        columns = [pa.array(row["keys"], pa.int64()), pa.array(row["sizes"], pa.int64()), pa.array(sums[ends] - sums[ends - distinct])]
        out.append(pa.RecordBatch.from_arrays(columns, schema=TOTAL_ARROW))
    return pa.Table.from_batches(out, schema=TOTAL_ARROW)


def count(docs: DataFrame, path: str, limit: int = 2048, chunk_chars: int = CHUNK_CHARS, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every whole text.

    ``path`` is a definition of the ``tokenizers`` library whose pre-tokens hold no white space;
    others raise. Its truncation, padding and added begin or end tokens are not applied, and
    strings of added tokens inside a text are one token each. Reads doc_id and text; other
    columns are left out. A null or empty text has no tokens. Each row is counted by itself, so
    repeated rows come out repeated, also under one or no doc_id. No rows give no rows.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as file:
        text = file.read()
    Pieces(text)
    definition = spark.sparkContext.broadcast(text)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    rows = docs.select(F.col("doc_id").cast("long"), size, "text")
    chunks = stored_in_buckets(rows.mapInArrow(_cut(definition, chunk_chars), CHUNK_TYPE), "token-chunks", "chunk", parts)
    all_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(parts, -(-all_words // part_words))
    dealt = chunks.select("chunk", "lengths", "bytes").mapInArrow(_deal(parts), DEALT_TYPE)
    counted = dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_count(definition), COUNTED_TYPE)
    by_chunk = chunks.select("chunk", "keys", "sizes", "distinct", "numbers", "times").groupBy("chunk")
    totals = by_chunk.cogroup(counted.groupBy("chunk")).applyInArrow(_total, TOTAL_TYPE)
    return totals.withColumn("over_limit", F.col("n_tokens") > limit)
