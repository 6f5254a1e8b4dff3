"""Language identification: blended-spectrum string kernel, Nyström landmarks, kernel ridge.

The kernel of two texts counts the byte n-grams, of 2 to 5 bytes, that both hold, presence
only, and is divided by the root of the two texts' own counts. N-grams are hashed into
``SLOTS`` places, so the kernel is one of hashed n-grams. A one-versus-rest ridge regression
is fitted on the Nyström features of a bounded sample. As the kernel is a product of presence
vectors, landmarks and weights fold into one matrix of slots by languages: a batch of texts is
scored by the product of its sparse presence matrix with that matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.llm.common import BYTE_VALUE, LOWER, mix, steps, steps_of, stream

SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
ORDERS = (2, 3, 4, 5)
LANDMARKS = 128
# The sample holds at most this many different texts of each language, and the most frequent
# languages: texts of all others are predicted as one of these.
TEXTS_PER_LANGUAGE = 400
MOST_LANGUAGES = 500
RIDGE = 1e-3
SHARPNESS = 6.0


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # slots x languages


def slots_of_step(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of every row of a step, one after another, and the offsets of the rows."""
    data, factors = LOWER[data], stream(max(ORDERS), 5) | np.uint64(1)
    values, hashes = BYTE_VALUE[data], []
    with np.errstate(over="ignore"):
        rolling = values * factors[0]
        for n in range(2, max(ORDERS) + 1):
            rolling = rolling[: max(0, len(data) - n + 1)] + values[n - 1 :] * factors[n - 1]
            hashes.append((mix(rolling + np.uint64(n)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
    last, found, counts = np.zeros(SLOTS, np.int32), [], np.zeros(len(offsets), np.int64)
    for row in range(len(offsets) - 1):
        start, end = offsets[row], offsets[row + 1]
        grams = np.concatenate([h[start : max(start, end - n + 1)] for n, h in zip(ORDERS, hashes, strict=True)])
        place = np.arange(len(grams), dtype=np.int32)
        last[grams] = place  # the last place that names a slot is the one that counts
        own = grams[last[grams] == place]
        found.append(own)
        counts[row + 1] = len(own)
    return np.concatenate([np.zeros(0, np.int32), *found]), np.cumsum(counts)


def kernel(rows: list[np.ndarray], landmarks: list[np.ndarray]) -> np.ndarray:
    """Normalised presence kernel of texts given by their slots, a block of rows at a time."""
    used = np.unique(np.concatenate([np.zeros(0, np.int32), *landmarks]))
    column = np.full(SLOTS, -1, np.int32)
    column[used] = np.arange(len(used))
    right = np.zeros((len(landmarks), len(used)), np.float32)
    for i, slots in enumerate(landmarks):
        right[i, column[slots]] = 1
    out = np.zeros((len(rows), len(landmarks)))
    for first in range(0, len(rows), 256):
        block = rows[first : first + 256]
        left = np.zeros((len(block), len(used)), np.float32)
        for i, slots in enumerate(block):
            own = column[slots]
            left[i, own[own >= 0]] = 1
        out[first : first + 256] = left @ right.T
    size = lambda texts: np.sqrt(np.maximum([len(t) for t in texts], 1))
    return out / size(rows)[:, None] / size(landmarks)[None, :]


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Model of the given texts, of which evenly spaced ones of each language are the landmarks."""
    names = sorted(set(languages))
    rows = []
    for data, offsets in steps_of(texts):
        slots, ends = slots_of_step(data, offsets)
        rows += np.split(slots, ends[1:-1])
    by_language = [[i for i, name in enumerate(languages) if name == wanted] for wanted in names]
    share = max(2, landmarks // len(names))
    chosen = [own[int(k)] for own in by_language for k in np.linspace(0, len(own) - 1, min(share, len(own)))]
    marks = [rows[i] for i in chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel(rows, marks) @ root
    truth = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = 1.0 / np.array([len(by_language[names.index(name)]) for name in languages])[:, None]
    gram = features.T @ (features * weight) + ridge * np.eye(features.shape[1])
    alpha = root @ np.linalg.solve(gram, features.T @ (truth * weight))
    table = np.zeros((SLOTS, len(names)), np.float32)
    for own, a in zip(marks, alpha, strict=True):
        table[own] += a / np.sqrt(max(1, len(own)))
    return Model(names, table)


def sample(
    docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES
) -> tuple[list[str], list[str]]:
    """Up to ``per_language`` different labelled texts of each language, those of smallest hash.

    Copies of a text count once, so no text floods the sample and none of the
    ``most_languages`` most frequent languages is left out.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    labelled = labelled.select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("texts"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not sizes:
        return [], []
    # Twice the share of the different texts: short by chance hardly ever, and bounded.
    limits = {r.lang: min(1.0, 2 * per_language / max(1, r.texts)) for r in sizes}
    share = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]
    place = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.where(place < share).groupBy("lang", "h").agg(F.first("text").alias("text"))
    first = Window.partitionBy("lang").orderBy(place, "h")
    chosen = drawn.withColumn("i", F.row_number().over(first)).where(F.col("i") <= per_language)
    rows = chosen.orderBy("i", "lang").select("lang", "text").collect()
    return [r.text for r in rows], [r.lang for r in rows]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every whole text.

    Reads doc_id and text. A text that is null, empty or without a letter is ``und`` with score
    0, and so is every text without a model. Ties go to the first language by code point. Rows
    with one doc_id are predicted each by itself.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) if model else F.lit(False)
    texts = docs.select("doc_id", "text", letters.alias("letters"))
    if model is None:
        return texts.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, table = shared.value
        names = np.array([*languages, "und"], object)
        for batch, data, offsets in steps(batches, "text"):
            slots, ends = slots_of_step(data, offsets)
            sizes = np.diff(ends)
            sums = np.zeros((batch.num_rows, table.shape[1]))
            full = np.flatnonzero(sizes)
            for first in range(0, len(full), 64):
                rows = full[first : first + 64]
                part = table[slots[ends[rows[0]] : ends[rows[-1] + 1]]]
                sums[rows] = np.add.reduceat(part, ends[rows] - ends[rows[0]], axis=0)
            scores = SHARPNESS * sums / np.sqrt(np.maximum(sizes, 1))[:, None]
            likely = np.exp(scores - scores.max(axis=1, keepdims=True))
            likely /= likely.sum(axis=1, keepdims=True)
            known = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            best = np.where(known, likely.argmax(axis=1), len(names) - 1)
            score = np.where(known, likely.max(axis=1), 0.0)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(names[best], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def learn(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> Model | None:
    texts, languages = sample(docs, per_language)
    return fit(texts, languages) if texts else None
