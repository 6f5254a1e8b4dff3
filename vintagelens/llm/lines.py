"""Line dedup by log templates: a tree of fixed depth over token count and leading tokens.

A line goes to the leaf of its token count and its first tokens, where a token with a digit is
a field. In a leaf, lines that agree in enough tokens form a template; tokens in which they
differ become fields. A template that recurs, in at least two documents, stays in its first
document, that of the smallest doc_id, and its lines are dropped from all others. Lines of few
tokens, and lines of templates with few constant ones, say too little for a template: they are
dropped as copies, if an earlier document has the same tokens, digits included. A line of under
``SHORT_BYTES`` bytes in few tokens must stand in ``SHORT_REPEATS`` documents for that. Blank
lines have no tokens and stay.

Only leaves that two documents share can hold a recurring template: counting leaves comes
first, and only their lines travel. Equal masked lines are one row before templates are formed,
and templates are formed in salted parts of a leaf, as many as its lines ask for, before the parts
of a leaf are merged. A leaf with more local templates than one part holds is merged in rounds:
each round deals them by another share of their tokens, as templates that agree in most tokens
are equal in one of the shares, and deals hot cells of a round to several parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens.llm.common import IS_SPACE, empty_text, hash_spans, mix, steps, stored, word_spans

LEADING = 3
FEWEST_TOKENS = 6
FEWEST_CONSTANTS = 5
# Lines of few tokens and fewer bytes are copies from so many documents on.
SHORT_BYTES = 16
SHORT_REPEATS = 3
SIMILARITY = 0.8
SALTS = 8
# Distinct lines, or local templates, that one task compares with each other.
PART_LINES = 10_000
# Shares of the tokens by which the templates of a large leaf are dealt, one after the other.
ROUNDS = 4
FIELD = "<*>"
FIELD_HASH = np.uint64(0xF1E1D)

IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[ord("0") : ord("9") + 1] = True


def line_tokens(data: np.ndarray, offsets: np.ndarray):
    """Per token of a step: hash (fields alike), own hash, row, line number in the row, start and end."""
    starts, ends, rows = word_spans(data, offsets)
    own = hash_spans(data, starts, ends)
    digits = np.concatenate([[0], np.cumsum(IS_DIGIT[data])])
    hashes = np.where(digits[ends] > digits[starts], FIELD_HASH, own)
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
    return hashes, own, rows, breaks[starts] - breaks[offsets[rows]], starts, ends


TEMPLATE, COPY, SHORT_COPY = 0, 1, 2


def leaves(data: np.ndarray, offsets: np.ndarray, fewest: int = FEWEST_TOKENS, leading: int = LEADING):
    """Row, line number, leaf and kind of every line of a step that has tokens.

    The leaf of a line of few tokens is its hash, and its kind a copy.
    """
    hashes, own, rows, lines, starts, ends = line_tokens(data, offsets)
    none = np.zeros(0, np.int64)
    if not len(hashes):
        return none, none, none, none
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (lines[1:] != lines[:-1])]))
    counts = np.diff(np.concatenate([first, [len(hashes)]]))
    long = counts >= max(fewest, leading)
    with np.errstate(over="ignore"):
        place = (np.arange(len(own)) - np.repeat(first, counts)).astype(np.uint64)
        whole = mix(np.add.reduceat(mix(own + place * np.uint64(0x9E3779B97F4A7C15)), first) + counts.astype(np.uint64))
        leaf = mix(counts.astype(np.uint64))
        for k in range(leading):
            leaf = mix(leaf * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(first + k, len(hashes) - 1)])
    length = ends[first + counts - 1] - starts[first]
    kind = np.where(long, TEMPLATE, np.where(length >= SHORT_BYTES, COPY, SHORT_COPY))
    leaf = np.where(long, leaf, whole)
    return rows[first], lines[first], leaf.view(np.int64), kind


def _is_field(token: str) -> bool:
    return any("0" <= c <= "9" for c in token)


def _split(line: str) -> list[str]:
    # The six white-space characters of the word pattern, not those of Unicode.
    return [t for t in line.translate(_BLANKS).split(" ") if t]


_BLANKS = {c: " " for c in range(128) if IS_SPACE[c]}


def form_templates(lines: list[list[str]], similarity: float = SIMILARITY) -> tuple[list[int], list[list[str]]]:
    """Template number of each token list (all of one length) and the templates.

    Each list joins the template it agrees with in the most tokens, the first of equals, if
    these are a share of at least ``similarity``; a field agrees with a field only.
    """
    numbers: dict[str, int] = {FIELD: 0}
    width = len(lines[0])
    known = np.zeros((16, width), np.int64)
    templates: list[list[str]] = []
    found = []
    for tokens in lines:
        own = np.array([numbers.setdefault(t, len(numbers)) for t in tokens])
        equal = (known[: len(templates)] == own).sum(axis=1) if templates else np.zeros(0)
        best = int(equal.argmax()) if len(equal) else -1
        if best >= 0 and equal[best] >= similarity * width - 1e-9:
            same = known[best] == own
            known[best] = np.where(same, own, 0)
            templates[best] = [t if s else FIELD for t, s in zip(templates[best], same, strict=True)]
        else:
            best = len(templates)
            if best == len(known):
                known = np.concatenate([known, np.zeros_like(known)])
            known[best] = own
            templates.append(list(tokens))
        found.append(best)
    return found, templates


ROW_ARROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("line", pa.int32()), ("leaf", pa.int64())])
FOUND_ARROW = pa.schema([*ROW_ARROW, ("kind", pa.int8())])
FOUND_TYPE = "doc_id long, h long, line int, leaf long, kind tinyint"


def _find_leaves(fewest: int, leading: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches, "text"):
            rows, lines, leaf, kind = leaves(data, offsets, fewest, leading)
            keys = [batch.column(c).take(pa.array(rows)) for c in ("doc_id", "h")]
            columns = [*keys, pa.array(lines.astype(np.int32)), pa.array(leaf), pa.array(kind.astype(np.int8))]
            yield pa.RecordBatch.from_arrays(columns, schema=FOUND_ARROW)

    return run


def _take_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*ROW_ARROW, ("salts", pa.int32()), ("whole", pa.int64()), ("masked", pa.string())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            lines = row["text"].split("\n")
            for place in row["places"]:
                own = _split(lines[place["line"]])
                whole = int.from_bytes(blake2b(" ".join(own).encode(), digest_size=8).digest(), "little", signed=True)
                tokens = " ".join(FIELD if _is_field(token) else token for token in own)
                out.append({"doc_id": row["doc_id"], "h": row["h"], **place, "whole": whole, "masked": tokens})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


TEXT_TYPE = "doc_id long, h long, line int, leaf long, salts int, whole long, masked string"
GROUP_ARROW = pa.schema([("leaf", pa.int64()), ("masked", pa.string()), ("template", pa.string()), ("low", pa.int64()), ("high", pa.int64())])
GROUP_TYPE = "leaf long, masked string, template string, low long, high long"


def _templates(similarity: float):
    """Template of each row of a part of a leaf; rows of a part follow each other."""

    def formed(part: list[dict]) -> list[dict]:
        found, templates = form_templates([r["masked"].split(" ") for r in part], similarity)
        named = [" ".join(t) for t in templates]
        return [{**{k: r[k] for k in ("leaf", "masked", "low", "high")}, "template": named[i]} for r, i in zip(part, found, strict=True)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if part and (part[0]["leaf"], part[0]["salt"]) != (row["leaf"], row["salt"]):
                    out += formed(part)
                    part = []
                part.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=GROUP_ARROW)
        yield pa.RecordBatch.from_pylist(formed(part) if part else [], schema=GROUP_ARROW)

    return run


def _formed(rows: DataFrame, similarity: float, name: str) -> DataFrame:
    """Templates of the rows (leaf, salt, masked, low, high), part by part; stored."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_parts = rows.repartition(parts, "leaf", "salt").sortWithinPartitions("leaf", "salt", "masked")
    return stored(sorted_parts.mapInArrow(_templates(similarity), GROUP_TYPE), name)


def _distinct_templates(formed: DataFrame) -> DataFrame:
    return formed.groupBy("leaf", F.col("template").alias("masked")).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _salted(rows: DataFrame, keys: list[str], part_lines: int) -> DataFrame:
    """A salt for each row, so that no group of ``keys`` has much more than ``part_lines`` rows a salt."""
    crowded = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_lines)
    salts = F.ceil(F.coalesce("_n", F.lit(1)) / part_lines).cast("long")
    return rows.join(crowded, keys, "left").withColumn("salt", F.pmod(F.xxhash64("masked"), salts)).drop("_n")


def _merged(first: DataFrame, similarity: float, part_lines: int) -> DataFrame:
    """leaf, masked (local template), template, low, high: local templates merged within their leaves."""
    templates = _distinct_templates(first)
    counts = templates.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    large = stored(counts.where(F.col("n") > part_lines).select("leaf"), "line-large")
    if large.isEmpty():
        return _formed(templates.withColumn("salt", F.lit(0).cast("long")), similarity, "line-merged")
    rounds, current = [], stored(templates.join(large, "leaf", "left_semi"), "line-round")
    for share in range(ROUNDS):
        tokens = F.filter(F.split("masked", " "), lambda _, i: i % ROUNDS == share)  # noqa: B023
        dealt = _salted(current.withColumn("cell", F.xxhash64(F.array_join(tokens, " "))), ["leaf", "cell"], part_lines)
        dealt = dealt.withColumn("salt", F.xxhash64("cell", "salt")).drop("cell")
        rounds.append(_formed(dealt, similarity, "line-round"))
        current = _distinct_templates(rounds[-1])
    small = templates.join(large, "leaf", "left_anti")
    last = _formed(_salted(small.unionByName(current), ["leaf"], part_lines), similarity, "line-merged")
    # From a local template to that of the last round, back through the rounds.
    last = last.select("leaf", "masked", "template")
    found = last.join(large, "leaf", "left_semi")
    for formed in reversed(rounds):
        step = formed.select("leaf", F.col("masked").alias("_local"), F.col("template").alias("masked"))
        found = stored(step.join(found, ["leaf", "masked"]).select("leaf", F.col("_local").alias("masked"), "template"), "line-round")
    found = found.unionByName(last.join(large, "leaf", "left_anti"))
    return templates.join(found, ["leaf", "masked"]).select("leaf", "masked", "template", "low", "high")


def recurring_lines(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    leading: int = LEADING,
    fewest_tokens: int = FEWEST_TOKENS,
    fewest_constants: int = FEWEST_CONSTANTS,
    part_lines: int = PART_LINES,
) -> DataFrame:
    """doc_id, h (hash of the text), line (number from 0), template of every line to drop.

    The template is null for lines that are dropped as copies.
    """
    texts = docs.select(F.col("doc_id").cast("long"), empty_text().alias("text")).where("doc_id is not null")
    texts = texts.withColumn("h", F.xxhash64("text"))
    rows = stored(texts.mapInArrow(_find_leaves(fewest_tokens, leading), FOUND_TYPE), "line-leaves")
    few = rows.where(F.col("kind") != TEMPLATE)
    rows = rows.where(F.col("kind") == TEMPLATE).drop("kind")
    shared = rows.groupBy("leaf").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
    salts = F.greatest(F.lit(SALTS), F.ceil(F.col("n") / part_lines)).cast("int").alias("salts")
    # Stored, so that the join has a plain shuffle on either side and hot leaves can be split.
    shared = stored(shared.where("low < high").select("leaf", salts), "line-shared")
    places = rows.join(shared, "leaf").groupBy("doc_id", "h").agg(F.collect_set(F.struct("line", "leaf", "salts")).alias("places"))
    taken = texts.join(places, ["doc_id", "h"]).select("doc_id", "h", "text", "places")
    lines = stored(taken.mapInArrow(_take_lines, TEXT_TYPE), "line-texts")

    distinct = lines.groupBy("leaf", "salts", "masked").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    first = _formed(distinct.withColumn("salt", F.pmod(F.xxhash64("masked"), F.col("salts"))), similarity, "line-templates")
    second = _merged(first, similarity, part_lines)
    constant = F.size(F.filter(F.split("template", " "), lambda t: t != FIELD))
    known = second.groupBy("leaf", "template").agg(F.min("low").alias("first"), F.max("high").alias("last"))
    enough = constant >= fewest_constants
    known = known.where(F.col("first") < F.col("last")).withColumn("enough", enough)
    final = second.join(known, ["leaf", "template"]).select("leaf", F.col("masked").alias("_local"), "template", "first", "enough")
    local = first.select("leaf", "masked", F.col("template").alias("_local"))
    dropped = local.join(final, ["leaf", "_local"]).select("leaf", "masked", "template", "first", "enough")
    found = stored(lines.join(dropped, ["leaf", "masked"]).drop("masked"), "line-recurring")
    by_template = found.where("enough and doc_id <> first").select("doc_id", "h", "line", "template")

    # Copies: equal lines of weak templates, then of few tokens.
    weak = found.where("not enough").select("doc_id", "h", "line", "whole")
    kept_in = weak.groupBy("whole").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    alike = weak.join(stored(kept_in.select("whole", "low"), "line-weak"), "whole").where("doc_id <> low")
    short = few.where(F.col("kind") == SHORT_COPY).select("leaf", "doc_id").distinct().groupBy("leaf")
    short = short.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")).where(F.col("n") >= SHORT_REPEATS)
    longer = few.where(F.col("kind") == COPY).groupBy("leaf")
    longer = longer.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    both = stored(short.select("leaf", "low").unionByName(longer.select("leaf", "low")), "line-copies")
    copied = few.join(both, "leaf").where("doc_id <> low")
    copies = [df.select("doc_id", "h", "line", F.lit(None).cast("string").alias("template")) for df in (alike, copied)]
    return by_template.unionByName(copies[0]).unionByName(copies[1])


KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("dropped", pa.list_(pa.int32()))])
KEPT_TYPE = "doc_id long, h long, text string, n_lines long, dropped array<int>"


def _drop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            lines, gone = row["text"].split("\n"), sorted(row["lines"] or [])
            skip = set(gone)
            text = "\n".join(x for i, x in enumerate(lines) if i not in skip) if gone else row["text"]
            out.append({"doc_id": row["doc_id"], "h": row["h"], "text": text, "n_lines": len(lines), "dropped": gone})
        yield pa.RecordBatch.from_pylist(out, schema=KEPT_ARROW)


def dedup(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, h (hash of the whole text), text (what is left), n_lines, dropped (line numbers, from 0).

    Reads doc_id and text; other columns are left out. A null text is empty: one empty line,
    which stays. Rows without a doc_id, and rows that repeat a doc_id among themselves, do not
    count as further documents. Every row gives a row.
    """
    texts = docs.select(F.col("doc_id").cast("long"), empty_text().alias("text")).withColumn("h", F.xxhash64("text"))
    gone = recurring_lines(docs, **settings).groupBy("doc_id", "h").agg(F.collect_set("line").alias("lines"))
    return texts.join(gone, ["doc_id", "h"], "left").select("doc_id", "h", "text", "lines").mapInArrow(_drop, KEPT_TYPE)
