"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word, letters and digits in a row, is the sum of the embeddings of its hashed form and its
hashed beginnings. Filters over one, two and three words are pooled by their largest value in
the text; a logistic layer reads the pooled values. Embeddings start from the log odds of each
hash in the labelled texts in their first coordinate, at random in the others. The language of
a text is guessed from its words, and the logit is shifted so that the cut that separates best
on held-back labelled texts of that language is a score of ``CUT``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.llm.common import BYTE_VALUE, LOWER, hash_spans, mix, per_row, steps, steps_of, stored, stored_in_buckets, stream

SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS
BEGINNINGS = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 8
SIZE = 8
EPOCHS = 6
RATE = 0.05
CUT = 0.3
SEED = 3
# Labelled text that one task learns from.
SHARD_BYTES = 16 << 20
# Languages with fewer held-back texts of either label take the common cut.
FEWEST = 15

IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


@dataclass
class Model:
    table: np.ndarray  # slots x size
    filters: np.ndarray  # size x (blocks * filters): one block per word of each width
    bias: np.ndarray
    out: np.ndarray
    base: float
    language: np.ndarray  # slots x languages, log odds of whole words
    cuts: np.ndarray  # logit cut per language


def word_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each word of a step (whole word, then beginnings) and the words' row offsets."""
    data = LOWER[data]
    solid = IN_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    slots = np.empty((len(starts), 1 + len(BEGINNINGS)), np.int32)
    keys = [hash_spans(data, starts, stops)]
    factors = stream(max(BEGINNINGS), 13) | np.uint64(1)
    with np.errstate(over="ignore"):
        running, lengths = np.zeros(len(starts), np.uint64), stops - starts
        for n in range(max(BEGINNINGS)):
            at = np.minimum(starts + n, max(0, len(data) - 1))
            running = running + np.where(n < lengths, BYTE_VALUE[data[at]] * factors[n], np.uint64(0)) if len(data) else running
            if n + 1 in BEGINNINGS:
                keys.append(mix(running + np.uint64(n + 1)))
    for k, key in enumerate(keys):
        slots[:, k] = (key >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
    return slots, per_row(rows, len(offsets) - 1)


def _after(block: np.ndarray, ends: np.ndarray, steps_: int) -> np.ndarray:
    """Row i holds the block's row i + steps_, or zeros beyond the end of its text."""
    moved = np.zeros_like(block)
    if len(block) > steps_:
        moved[:-steps_] = block[steps_:]
        moved[: len(block)][np.arange(len(block)) + steps_ >= ends] = 0
    return moved


def convolve(model: Model, slots: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word embeddings, and the filters' values at each word."""
    words = model.table[slots[:, 0]]
    for k in range(1, slots.shape[1]):
        words = words + model.table[slots[:, k]]
    blocks = (words @ model.filters).reshape(len(words), -1, FILTERS)
    ends = np.repeat(edges[1:], np.diff(edges))
    values, at = [], 0
    for width in WIDTHS:
        value = blocks[:, at]
        for step in range(1, width):
            value = value + _after(blocks[:, at + step], ends, step)
        values.append(value)
        at += width
    return words, np.concatenate(values, axis=1)


def logits(model: Model, slots: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Logit of each text; a text without words has the base logit."""
    pooled = np.zeros((len(edges) - 1, FILTERS * len(WIDTHS)), np.float32)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        _, values = convolve(model, slots, edges)
        pooled[full] = np.maximum(np.maximum.reduceat(values, edges[full], axis=0) + model.bias, 0)
    return pooled @ model.out + model.base


def languages(model: Model, slots: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Likeliest language of each text by its whole words; the first without words."""
    sums = np.zeros((len(edges) - 1, model.language.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        sums[full] = np.add.reduceat(model.language[slots[:, 0]], edges[full], axis=0)
    return sums.argmax(axis=1)


def _presence(slots: np.ndarray, edges: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted number of texts that hold each slot."""
    found = np.zeros(SLOTS)
    for row in range(len(edges) - 1):
        found[np.unique(slots[edges[row] : edges[row + 1]])] += weight[row]
    return found


@dataclass
class Shard:
    """Labelled texts that one task learns from: word slots, row offsets, labels, languages."""

    slots: np.ndarray
    edges: np.ndarray
    y: np.ndarray
    spoken: list[str | None]

    @staticmethod
    def of(texts: list[str], toxic: list[int], spoken: list[str | None]) -> Shard:
        pieces = [word_slots(data, offsets) for data, offsets in steps_of(texts)]
        slots = np.concatenate([s for s, _ in pieces])
        edges = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(e) for _, e in pieces]))])
        return Shard(slots, edges, np.asarray(toxic, np.float32), list(spoken))

    @property
    def held(self) -> np.ndarray:
        """Rows that are for the cuts only."""
        return np.arange(len(self.y)) % 4 == 3

    def counts(self) -> Counts:
        toxic, clean = (np.asarray(~self.held & (self.y == v), float) for v in (1, 0))
        presence = [_presence(self.slots, self.edges, rows) for rows in (toxic, clean)]
        words = {name: np.zeros(SLOTS) for name in {s for s in self.spoken if s is not None}}
        for row, name in enumerate(self.spoken):
            if name is not None:
                np.add.at(words[name], self.slots[self.edges[row] : self.edges[row + 1], 0], 1)
        return Counts(presence, [toxic.sum(), clean.sum()], words)


@dataclass
class Counts:
    """Of toxic and of clean texts: those that hold each slot, and their number; words by language."""

    presence: list[np.ndarray]
    texts: list[float]
    words: dict[str, np.ndarray]


def first_values(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.random.Generator]:
    """Random embeddings, filters and output weights, and the generator that drew them."""
    rng = np.random.default_rng(seed)
    shapes = ((0.05, (SLOTS, SIZE)), (0.3, (SIZE, sum(WIDTHS) * FILTERS)), (0.1, FILTERS * len(WIDTHS)))
    return *(rng.normal(0, width, shape).astype(np.float32) for width, shape in shapes), rng


def begin(counts: Counts, seed: int) -> tuple[Model, dict]:
    """The model before training, and the sums of squared gradients by parameter."""
    table, filters, out, _ = first_values(seed)
    (p, n), (n_toxic, n_clean) = counts.presence, counts.texts
    odds = np.log((p + 0.5) / (n_toxic + 1)) - np.log((n + 0.5) / (n_clean + 1))
    table[:, 0] = np.clip(odds * (p + n) / (p + n + 4), -1, 6) / 4
    firsts = np.cumsum([0, *WIDTHS[:-1]]) * FILTERS
    filters[0, firsts] = 1.0
    out[:: FILTERS] = 1.0
    known = sorted(counts.words) or [""]
    word_counts = np.stack([counts.words.get(name, np.zeros(SLOTS)) for name in known], axis=1).astype(np.float32) + np.float32(0.1)
    language = np.log(word_counts / word_counts.sum(axis=0))
    share = np.float32(n_toxic) / np.float32(n_toxic + n_clean) if n_toxic + n_clean else None
    base = -2.0 if share is None else float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    model = Model(table, filters, np.full(FILTERS * len(WIDTHS), -0.5, np.float32), out, base, language, np.zeros(len(known)))
    grown = {name: np.full_like(getattr(model, name), 1e-2) for name in ("table", "filters", "bias", "out")}
    return model, grown | {"base": 1e-2}


def row_order(n_rows: int, epoch: int, seed: int, place: int = 0) -> np.ndarray:
    """Order in which a shard's rows are learned in an epoch; those held back are left out."""
    rng = np.random.default_rng([seed, place]) if place else first_values(seed)[-1]
    train = np.flatnonzero(np.arange(n_rows) % 4 != 3)
    for _ in range(epoch + 1):
        order = rng.permutation(train)
    return order


def train_epoch(model: Model, grown: dict, shard: Shard, order: np.ndarray, rate: float) -> None:
    """One pass over the shard's rows in the given order; changes ``model`` and ``grown``."""
    slots, edges, y = shard.slots, shard.edges, shard.y
    for first in range(0, len(order), 64):
        rows = order[first : first + 64]
        rows = rows[edges[rows + 1] > edges[rows]]
        if not len(rows):
            continue
        pieces = [np.arange(edges[r], edges[r + 1]) for r in rows]
        own = np.concatenate([[0], np.cumsum([len(x) for x in pieces])])
        s = slots[np.concatenate(pieces)]
        words, values = convolve(model, s, own)
        at = np.stack([own[i] + values[own[i] : own[i + 1]].argmax(axis=0) for i in range(len(rows))])
        raw = values[at, np.arange(values.shape[1])] + model.bias
        pooled = np.maximum(raw, 0)
        z = pooled @ model.out + model.base
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
        flow = (error[:, None] * model.out) * (raw > 0)
        d_out, d_bias, d_base = pooled.T @ error, flow.sum(axis=0), error.sum()
        d_filters = np.zeros_like(model.filters)
        touched, pushed, block = [], [], 0
        for w, width in enumerate(WIDTHS):
            f = slice(w * FILTERS, (w + 1) * FILTERS)
            for step in range(width):
                position = at[:, f] + step
                inside = position < own[1:, None]
                position = np.minimum(position, len(words) - 1)
                g = np.where(inside, flow[:, f], 0)
                columns = slice(block * FILTERS, (block + 1) * FILTERS)
                d_filters[:, columns] += np.einsum("rfs,rf->sf", words[position], g)
                touched.append(position.ravel())
                pushed.append((g[:, :, None] * model.filters[:, columns].T[None]).reshape(-1, SIZE))
                block += 1
        place, inverse = np.unique(s[np.concatenate(touched)], return_inverse=True)
        d_table = np.zeros((len(place), SIZE), np.float32)
        pushed = np.concatenate(pushed)
        for k in range(s.shape[1]):
            np.add.at(d_table, inverse.reshape(-1, s.shape[1])[:, k], pushed)
        grown["table"][place] += d_table**2
        model.table[place] -= rate * d_table / np.sqrt(grown["table"][place])
        for name, gradient in (("filters", d_filters), ("bias", d_bias), ("out", d_out)):
            grown[name] += gradient**2
            getattr(model, name)[...] -= rate * gradient / np.sqrt(grown[name])
        grown["base"] += d_base**2
        model.base -= float(rate * d_base / np.sqrt(grown["base"]))


def fit(texts: list[str], toxic: list[int], spoken: list[str | None], seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """Model of the given texts, trained here."""
    shard = Shard.of(texts, toxic, spoken)
    model, grown = begin(shard.counts(), seed)
    for epoch in range(epochs):
        train_epoch(model, grown, shard, row_order(len(shard.y), epoch, seed), RATE * (1 - epoch / epochs))
    _calibrate(model, shard.slots, shard.edges, shard.y, shard.held)
    return model


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """Midpoint of the two neighbouring logits between which a cut has the highest F1."""
    order = np.argsort(-z)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    k = int(f1.argmax())
    below = z[order[k + 1]] if k + 1 < len(z) else z[order[k]] - 1
    return float((z[order[k]] + below) / 2)


def _logits_by_row(model: Model, slots: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Logits of many texts, one at a time: working arrays stay small."""
    each = [logits(model, slots[a:b], np.array([0, b - a])) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return np.concatenate(each or [np.zeros(0)])


def _calibrate(model: Model, slots, edges, y, held) -> None:
    z = _logits_by_row(model, slots, edges)
    guess = languages(model, slots, edges)
    enough = lambda rows: min(y[rows].sum(), (1 - y[rows]).sum())
    common = _best_cut(z[held], y[held]) if held.any() and enough(held) >= 1 else 0.0
    model.cuts[:] = common
    for k in range(len(model.cuts)):
        rows = held & (guess == k)
        if enough(rows) >= FEWEST:
            model.cuts[k] = _best_cut(z[rows], y[rows])


def learn(docs: DataFrame, labels: DataFrame, most_toxic: int | None = None, most_clean: int | None = None) -> Model | None:
    """Model from every labelled text; with bounds, from as many, chosen by a hash of doc_id.

    A doc_id with several labels is toxic if one of them is. A doc_id whose rows hold several
    texts gives one of them, that of the smallest hash. Rows without a doc_id, a text or a label
    teach nothing. None if no labelled text is there.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    bounded = most_toxic is not None or most_clean is not None
    if bounded:
        order = F.xxhash64("doc_id", F.lit(17))
        chosen = [
            marked.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(most if most is not None else 2**31 - 1)
            for label, most in ((1, most_toxic), (0, most_clean))
        ]
        marked = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", "lang").join(marked, "doc_id")
    one = texts.groupBy("doc_id", "toxic").agg(F.min_by(F.struct("text", "lang"), F.xxhash64("text")).alias("row"))
    rows = one.select("doc_id", "toxic", "row.*", F.xxhash64("doc_id", F.lit(18)).alias("place"))
    if not bounded:
        return _learn_in_shards(rows)
    few = rows.orderBy("place", "doc_id").collect()
    return fit([r.text for r in few], [r.toxic for r in few], [r.lang for r in few]) if few else None


def _learn_in_shards(rows: DataFrame, shard_bytes: int = SHARD_BYTES, seed: int = SEED, epochs: int = EPOCHS) -> Model | None:
    """Model from all rows, dealt to shards by doc_id.

    Counts are added up over the shards. In every epoch each shard trains the common model on its
    own rows; the new model is the mean over the shards, of an embedding over those that changed it.
    Values are added as whole numbers, so that their order does not matter.
    """
    rows = stored(rows, "toxicity-labelled")
    n_bytes = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    if not n_bytes:
        return None
    shards = math.ceil(n_bytes / shard_bytes)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(19)), F.lit(shards)).cast("int"))
    dealt = stored_in_buckets(dealt.repartition(shards, "shard"), "toxicity-shards", "shard", shards).groupBy("shard")
    context = rows.sparkSession.sparkContext
    model, grown = begin(_counted(dealt.applyInArrow(_count_shard, COUNT_TYPE)), seed)
    for epoch in range(epochs):
        shared = context.broadcast((model.__dict__, grown))
        trained = dealt.applyInArrow(_train_shard(shared, epoch, seed, RATE * (1 - epoch / epochs)), PARAMETER_TYPE)
        sums = trained.groupBy("at").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(2 * SIZE)])
        # At most a row per slot: as many whatever the input.
        found = sums.toArrow()
        values = np.stack([found.column(f"v{i}").to_numpy() for i in range(2 * SIZE)], axis=1) / found.column("n").to_numpy()[:, None]
        matrix = _flat(model, grown)
        matrix[found.column("at").to_numpy()] = values / SCALE
        _unflat(matrix, model, grown)
        shared.unpersist()
    shared = context.broadcast(model.__dict__)
    best_cuts(model, dealt.applyInArrow(_score_shard(shared), "k int, z double, y int"))
    return model


def _rows_of(table: pa.Table) -> Shard:
    table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")])
    return Shard.of(*(table.column(c).to_pylist() for c in ("text", "toxic", "lang")))


# Kinds 0 and 1 are toxic and clean texts, 2 the words of a language; slot -1 stands for all texts.
COUNT_TYPE = "kind int, name string, slot int, n long"
COUNT_ARROW = pa.schema([("kind", pa.int32()), ("name", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])


def _count_shard(table: pa.Table) -> pa.Table:
    counts = _rows_of(table).counts()
    found = [(k, "", counts.presence[k], counts.texts[k]) for k in (0, 1)]
    found += [(2, name, words, 0) for name, words in counts.words.items()]
    parts = []
    for kind, name, numbers, texts in found:
        at = np.flatnonzero(numbers)
        slots, n = np.concatenate([[-1], at]).astype(np.int32), np.concatenate([[texts], numbers[at]]).astype(np.int64)
        parts.append(pa.table([pa.array(np.full(len(n), kind, np.int32)), pa.array([name] * len(n), pa.string()), slots, n], schema=COUNT_ARROW))
    return pa.concat_tables(parts)


def _counted(counts: DataFrame) -> Counts:
    """Counts of all shards: at most a row per slot of either label and of each language."""
    found = counts.groupBy("kind", "name", "slot").agg(F.sum("n").alias("n")).toArrow()
    kind, slot, n = (found.column(c).to_numpy() for c in ("kind", "slot", "n"))
    name = found.column("name").to_numpy(zero_copy_only=False)

    def numbers(own: np.ndarray) -> np.ndarray:
        out, own = np.zeros(SLOTS), own & (slot >= 0)
        out[slot[own]] = n[own]
        return out

    texts = [float(n[(kind == k) & (slot < 0)].sum()) for k in (0, 1)]
    words = {x: numbers((kind == 2) & (name == x)) for x in sorted(set(name[kind == 2]))}
    return Counts([numbers(kind == k) for k in (0, 1)], texts, words)


# Parameters and their sums of squares as rows of twice SIZE whole numbers: a row per slot, then the others.
SCALE = float(1 << 40)
PARAMETER_TYPE = "at int, " + ", ".join(f"v{i} long" for i in range(2 * SIZE))
SMALL = ("filters", "bias", "out", "base")


def _flat(model: Model, grown: dict) -> np.ndarray:
    """All trained parameters as a matrix: values in the first SIZE columns, sums of squares beside."""
    def rows(values: list) -> np.ndarray:
        flat = np.concatenate([np.ravel(v).astype(float) for v in values])
        return np.concatenate([flat, np.zeros(-len(flat) % SIZE)]).reshape(-1, SIZE)

    small = np.concatenate([rows([getattr(model, n) for n in SMALL]), rows([grown[n] for n in SMALL])], axis=1)
    return np.concatenate([np.concatenate([model.table, grown["table"]], axis=1).astype(float), small])


def _unflat(matrix: np.ndarray, model: Model, grown: dict) -> None:
    for values, columns in ((model.__dict__, matrix[:, :SIZE]), (grown, matrix[:, SIZE:])):
        values["table"] = columns[:SLOTS].astype(np.float32)
        flat, at = columns[SLOTS:].ravel(), 0
        for name in SMALL[:-1]:
            size, shape = values[name].size, values[name].shape
            values[name] = flat[at : at + size].reshape(shape).astype(np.float32)
            at += size
        values["base"] = float(flat[at])


def _train_shard(shared, epoch: int, seed: int, rate: float):
    def run(table: pa.Table) -> pa.Table:
        place = table.column("shard")[0].as_py()
        shard = _rows_of(table)
        kept, sums = shared.value
        before = _flat(Model(**kept), sums)
        model = Model(**{n: np.array(v) if isinstance(v, np.ndarray) else v for n, v in kept.items()})
        grown = {n: np.array(v) if isinstance(v, np.ndarray) else v for n, v in sums.items()}
        train_epoch(model, grown, shard, row_order(len(shard.y), epoch, seed, place), rate)
        after = _flat(model, grown)
        changed = (after != before).any(axis=1)
        changed[SLOTS:] = True
        values = np.rint(after[changed] * SCALE).astype(np.int64)
        names = ["at", *[f"v{i}" for i in range(2 * SIZE)]]
        return pa.table([np.flatnonzero(changed).astype(np.int32), *values.T.copy()], names=names)

    return run


def _score_shard(shared):
    """Language, logit and label of the rows that are held back."""

    def run(table: pa.Table) -> pa.Table:
        shard, model = _rows_of(table), Model(**shared.value)
        z = _logits_by_row(model, shard.slots, shard.edges)
        guess = languages(model, shard.slots, shard.edges)
        held = shard.held
        columns = [guess[held].astype(np.int32), z[held].astype(float), shard.y[held].astype(np.int32)]
        return pa.table(columns, names=["k", "z", "y"])

    return run


def best_cuts(model: Model, scores: DataFrame) -> None:
    """Sets the cuts from all held-back rows (k, z, y), as ``_calibrate`` does from rows on the driver.

    Rows are counted by logit; running sums go over slices of the logits first, then inside a
    slice, so that no language is in one task.
    """
    both = scores.select(F.explode(F.array(F.lit(-1), "k")).alias("k"), "z", "y")
    each = both.groupBy("k", "z").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    each = stored(each.withColumn("slice", F.floor(F.col("z") * 256)), "toxicity-logits")
    down = Window.partitionBy("k").orderBy(F.desc("slice"))
    over, whole = down.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("k")
    slices = each.groupBy("k", "slice").agg(F.sum("n").alias("_n"), F.sum("hits").alias("_hits"), F.max("z").alias("_top"))
    slices = slices.select(
        "k", "slice",
        F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("n0"), F.coalesce(F.sum("_hits").over(over), F.lit(0)).alias("hits0"),
        F.sum("_n").over(whole).alias("rows"), F.sum("_hits").over(whole).alias("bad"), F.lead("_top").over(down).alias("next"),
    )
    inside = Window.partitionBy("k", "slice").orderBy(F.desc("z"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    f1 = 2.0 * (F.col("hits0") + F.sum("hits").over(upto)) / (F.col("n0") + F.sum("n").over(upto) + F.col("bad"))
    below = F.coalesce(F.lead("z").over(inside), "next", F.col("z") - 1)
    ranked = each.join(slices, ["k", "slice"]).select("k", "z", "rows", "bad", f1.alias("f1"), below.alias("below"))
    best = F.max_by(F.struct("z", "below"), F.struct("f1", "z")).alias("best")
    found = {r.k: r for r in ranked.groupBy("k").agg(best, F.max("rows").alias("rows"), F.max("bad").alias("bad")).collect()}

    def cut(k: int, fewest: int, other: float) -> float:
        r = found.get(k)
        if r is None or min(r.bad, r.rows - r.bad) < fewest:
            return other
        return float((np.float32(r.best.z) + np.float32(r.best.below)) / 2)

    common = cut(-1, 1, 0.0)
    model.cuts[:] = [cut(k, FEWEST, common) for k in range(len(model.cuts))]


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted of every whole text.

    Reads doc_id and text. A null, empty or wordless text has the base score. Without a model
    all scores are 0. Rows with one doc_id are scored each by itself.
    """
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch, data, offsets in steps(batches, "text"):
            found = likelihoods(m, data, offsets)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(found), pa.array((found >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def likelihoods(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of the texts of a step, shifted so that every language is cut at ``CUT``."""
    slots, edges = word_slots(data, offsets)
    z = logits(model, slots, edges) - model.cuts[languages(model, slots, edges)] + np.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(z.astype(float), -500, 500)))


def drop_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows whose text is not predicted as toxic, with all their columns; each row by itself."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch, data, offsets in steps(batches, "text"):
            yield batch.filter(pa.array(likelihoods(m, data, offsets) < CUT))

    return docs.mapInArrow(run, docs.schema)
