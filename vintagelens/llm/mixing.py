"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same number of copies, target / source size. The
whole part is taken as it is. The fractions are rounded in pairs: words move at random from
one document of the pair to the other until one of the two fractions is 0 or 1. A move keeps
the words of the pair, and in expectation each fraction; so a source keeps its total up to the
one document that stays fractional at the end. Inside a cell of a source, each document is
paired with the cell's smaller documents taken together. If a large document is left over, it
becomes whole at random and its words are made up for by copies of smaller documents, so that
what stays fractional is small. The one residual of each cell goes up a reduction tree, which
pairs residuals until a source has one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens.llm.common import WORD, empty_text, mix as mix_bits, stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
# Documents of a source that one task pairs, and residuals that one task of the tree combines.
CELL_ROWS = 2_000
FAN_IN = 1_000
# Equal rows that one task tells off.
EQUAL_ROWS = 10_000
# Fractions closer than this to a whole number are whole.
CLOSE = 1e-9


def count_words(column: str = "text"):
    return F.coalesce(F.expr(f"regexp_count({column}, r'{WORD}')"), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, most_copies: float = MOST_COPIES
) -> DataFrame:
    """source, source_size, source_rows, target: shares by weight, capped, the excess reshared.

    ``sized`` has source and size. Sources by code point, null last, take the weights in turn.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    in_order = totals.orderBy(F.col("source").asc_nulls_last()).withColumn("_place", F.monotonically_increasing_id())
    in_order = stored(in_order, "mix-sources")
    # A place is the partition's number and the row's number in it: rank = rows before + row number.
    part = F.shiftright("_place", 33)
    counts = sorted((r.part, r.n) for r in in_order.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, seen = {}, 0
    for number, n in counts:
        before[number], seen = seen, seen + n
    if not before:
        return in_order.select("source", "source_size", "source_rows", F.lit(0.0).alias("target"))
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[part]
    rank = offset + F.col("_place").bitwiseAND((1 << 33) - 1)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighted = in_order.withColumn("_weight", turn[(rank % len(weights)).cast("int")])

    most, share = F.col("source_size") * most_copies, None
    while True:  # the set of capped sources only grows
        capped = F.lit(False) if share is None else most < F.col("_weight") * share
        row = weighted.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, most).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_weight"))).alias("free"),
        ).first()
        found = (row.total - row.fixed) / row.free if row.free else share
        if found == share:
            break
        share = found
    target = F.least(most, F.col("_weight") * share)
    return weighted.select("source", "source_size", "source_rows", target.alias("target"))


def round_pairs(size: np.ndarray, fraction: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, int]:
    """Fractions after pairing in the given order, and the place of the one left, or -1."""
    x, held = fraction.astype(float).tolist(), -1
    sizes, chances = size.tolist(), chance.tolist()
    for i in range(len(x)):
        if sizes[i] == 0 or x[i] < CLOSE or x[i] > 1 - CLOSE:
            x[i] = float(round(x[i])) if sizes[i] else 0.0
            continue
        if held < 0:
            held = i
            continue
        a, b, sa, sb = x[held], x[i], sizes[held], sizes[i]
        up, down = min((1 - a) * sa, b * sb), min(a * sa, (1 - b) * sb)
        moved = up if chances[i] * (up + down) < down else -down
        a, b = a + moved / sa, b - moved / sb
        a, b = (float(round(v)) if min(abs(v), abs(1 - v)) < CLOSE else v for v in (a, b))
        x[held], x[i] = a, b
        left = [k for k, v in ((held, a), (i, b)) if 0 < v < 1]
        held = left[0] if left else -1
    return np.array(x), held


def round_pool(size: np.ndarray, fraction: float, chance: np.ndarray) -> tuple[np.ndarray, int]:
    """As ``round_pairs`` where all fractions are equal: each document is paired with all after it.

    A move shifts the fractions of those by one amount, so they stay equal. A large document
    thus becomes whole in one move, and the one left over is among the smallest.
    """
    x, after = np.zeros(len(size)), np.cumsum(size[::-1])[::-1] - size
    f, pool = float(fraction), after.tolist()
    for i, (s, draw) in enumerate(zip(size.tolist(), chance.tolist(), strict=True)):
        if s == 0 or f < CLOSE or f > 1 - CLOSE:
            x[i:] = round(f) * (size[i:] > 0)
            return x, -1
        up, down = min((1 - f) * s, f * pool[i]), min(f * s, (1 - f) * pool[i])
        if up + down == 0:
            x[i] = f
            return x, i
        moved = up if draw * (up + down) < down else -down
        a, f = f + moved / s, f - moved / pool[i]
        x[i] = round(a) if min(abs(a), abs(1 - a)) < CLOSE else a
        if 0 < x[i] < 1:
            x[i + 1 :] = round(f) * (size[i + 1 :] > 0)
            return x, i
    return x, -1


def settle(size: np.ndarray, x: np.ndarray, held: int, draw: float) -> int:
    """Makes the held document whole, if whole copies of smaller ones make up for it; who is held then.

    Up with the chance of its fraction, or down; the words too many or too few are taken from
    or given to smaller documents, large ones first, and the smallest of them that the rest
    fits into stays fractional. Without enough of them nothing changes.
    """
    start = x[held]
    order = [i for i in np.argsort(-size, kind="stable").tolist() if 0 < size[i] < size[held]]
    for up in (draw < start, draw >= start):
        rest = (1 - start if up else start) * size[held]
        full = 1.0 if up else 0.0  # these can give words, or take them
        changed, last = [], -1
        for i in order:
            if abs(x[i] - full) < CLOSE:
                if size[i] <= rest + CLOSE:
                    changed.append(i)
                    rest -= size[i]
                else:
                    last = i
        if rest < CLOSE or last >= 0:
            x[held] = full
            x[changed] = 1 - full
            if rest < CLOSE:
                return -1
            x[last] = 1 - rest / size[last] if up else rest / size[last]
            return last
    return held


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_copies: float = MOST_COPIES,
    seed: int = 7,
    cell_rows: int = CELL_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Copies of each document: doc_id, h (hash of its text), source, size, source_size, target, copies, taken.

    Reads doc_id, text, source; other columns are left out. Null or blank text has size 0 and
    no copies. A null source is a source of its own, the last. Rows with equal doc_id are
    documents of their own. No rows give no rows. Runs with the same seed agree.
    """
    text_hash = F.xxhash64(empty_text()).alias("h")
    sized = docs.select("doc_id", "source", count_words().alias("size"), text_hash)
    # Equal rows are numbered without gathering them: counted, then told off in blocks.
    equal = sized.groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("n"))
    begins = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(EQUAL_ROWS).cast("long"))
    blocks = equal.withColumn("from", F.explode(begins)).repartition("doc_id", "h", "from")
    number = F.explode(F.sequence("from", F.least("n", F.col("from") + EQUAL_ROWS) - 1))
    sized = blocks.withColumn("number", number).drop("n", "from")
    sized = stored(sized.withColumn("rid", F.monotonically_increasing_id()), "mix-sizes")
    targets = stored(source_targets(sized, weights, most_copies), "mix-targets").withColumnRenamed("source", "_source")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    x = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    bits = F.xxhash64(F.lit(seed), "doc_id", "h", "number")
    cells = F.ceil(F.col("source_rows") / cell_rows).cast("long")
    rows = rows.select(
        *["rid", "doc_id", "h", "source", "size", "source_size", "target"],
        F.floor(x + CLOSE).cast("long").alias("whole"),
        F.greatest(x - F.floor(x + CLOSE), F.lit(0.0)).alias("fraction"),
        bits.alias("bits"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "h", "number"), cells).alias("cell"),
        cells.alias("cells"),
    )

    def pair(level: int, last: bool):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            # Large documents first, so that the one left over tends to be small.
            g = group.sort_values(["size", "bits", "rid"], ascending=[False, True, True])
            chance = mix_bits(g["bits"].to_numpy().astype(np.uint64) + np.uint64(level)) / 2.0**64
            size, fraction = g["size"].to_numpy(), g["fraction"].to_numpy()
            equal = level == 0 and len(g) and fraction.min() == fraction.max()
            done, held = round_pool(size, fraction[0], chance) if equal else round_pairs(size, fraction, chance)
            if held >= 0:
                held = settle(size, done, held, chance[held])
            open_ = np.zeros(len(g), bool)
            if held >= 0 and last:
                done[held] = float(done[held] >= 0.5)
            elif held >= 0:
                open_[held] = True
            return pd.DataFrame({
                "rid": g["rid"], "source": g["source"], "size": g["size"], "bits": g["bits"],
                "cell": g["cell"], "fraction": done, "open": open_,
            })

        return run

    out = "rid long, source string, size long, bits long, cell long, fraction double, open boolean"
    wanted = ["rid", "source", "size", "bits", "cell", "fraction"]
    most = rows.agg(F.max("cells")).first()[0] or 1
    levels = 1 + (math.ceil(math.log(most, fan_in) - 1e-12) if most > 1 else 0)
    settled = left = None
    current = rows.select(*wanted)
    for level in range(levels):
        grouped = current.groupBy("source", "cell").applyInPandas(pair(level, level == levels - 1), out)
        tier = stored(grouped, f"mix-level{level}")
        closed = tier.where(~F.col("open")).select("rid", "fraction")
        settled = closed if settled is None else settled.unionByName(closed)
        left = tier.where("open")
        current = left.withColumn("cell", F.floor(F.col("cell") / fan_in)).select(*wanted)
    copies = F.col("whole") + F.round("fraction").cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(0).cast("long")
    return (
        rows.drop("fraction", "bits", "cell", "cells")
        .join(settled, "rid")
        .select("doc_id", "h", "source", "size", "source_size", "target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
