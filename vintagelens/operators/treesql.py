"""Boosted trees as a column expression: scoring without vectors and without an ML stage.

The scaler disappears into the thresholds. A scaled feature passes a split if
``(x - mean) / std <= t``, which holds for all x up to some double; that double is searched for,
and the split compares the feature as it is. A missing feature counts as its training mean, so
its side of a split is known beforehand and takes the branch that a NULL falls into. The text
reads the same in other engines and gives the same scores there.

A frame is scored by a few trees a column, which are then added up: the code that Spark generates
for one column stays small enough for the JVM to compile it. One expression of 75 trees took four
times as long.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (feature, threshold, left, right), or the value of a leaf.
Node = tuple | float
# Leaves of the trees that one column adds up.
COLUMN_LEAVES = 40

_IF = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")
_TREE = re.compile(r"Tree \d+ \(weight (\S+)\):")


@dataclass(frozen=True)
class Scale:
    """Mean and deviation by which a feature is scaled before it meets a threshold."""

    mean: float
    std: float

    def passes(self, x: float, threshold: float) -> bool:
        return (x - self.mean) / self.std <= threshold


@dataclass(frozen=True)
class Ensemble:
    features: list[str]
    scales: list[Scale]
    trees: list[Node]

    def __post_init__(self):
        for name in self.features:
            if not name.isidentifier():
                raise ValueError(f"not a plain column name: {name}")

    def margin_sql(self, n_trees: int | None = None) -> str:
        """Sum of the first ``n_trees`` trees, or of all, as one expression. NaN has to be NULL."""
        return "(" + (" + ".join(self._tree_sql(t) for t in self.trees[:n_trees]) or "0E0") + ")"

    def score_sql(self, n_trees: int | None = None) -> str:
        """Probability of the label 1, as one expression."""
        return probability(self.margin_sql(n_trees))

    def with_margin(self, df: DataFrame, name: str, n_trees: int | None = None) -> DataFrame:
        """``df`` with the sum of the first ``n_trees`` trees, or of all. NaN counts as missing."""
        missing = {f: F.expr(f"nullif({f}, cast('NaN' as double))").alias(f"_in_{f}") for f in self.features}
        inner = Ensemble([f"_in_{f}" for f in self.features], self.scales, self.trees[:n_trees])
        texts = ["0E0"] if not inner.trees else [" + ".join(inner._tree_sql(t) for t in g) for g in inner._groups()]
        parts = [f"_part_{i}" for i in range(len(texts))]
        cleaned = df.select("*", *missing.values())
        summed = cleaned.select(*df.columns, *[F.expr(t).alias(p) for t, p in zip(texts, parts, strict=True)])
        # Each part is used twice, so that the optimizer does not write them all into one expression.
        known = " and ".join(f"{p} is not null" for p in parts)
        return summed.withColumn(name, F.expr(f"if({known}, {' + '.join(parts)}, null)")).drop(*parts)

    def with_score(self, df: DataFrame, name: str, n_trees: int | None = None) -> DataFrame:
        """``df`` with the probability of the label 1 of every row."""
        return self.with_margin(df, name, n_trees).withColumn(name, F.expr(probability(name)))

    def _groups(self) -> list[list[Node]]:
        groups, leaves = [[]], 0
        for tree in self.trees:
            own = _leaves(tree)
            if groups[-1] and leaves + own > COLUMN_LEAVES:
                groups, leaves = [*groups, []], 0
            groups[-1].append(tree)
            leaves += own
        return groups

    def _tree_sql(self, node: Node) -> str:
        if isinstance(node, float):
            return number(node)
        feature, threshold, left, right = node
        at = last_passing(self.scales[feature], threshold)
        left_sql, right_sql = self._tree_sql(left), self._tree_sql(right)
        value = self.features[feature]
        if 0.0 <= threshold:  # a missing feature is at its mean, scaled 0
            return f"if({value} > {number(at)}, {right_sql}, {left_sql})"
        return f"if({value} <= {number(at)}, {left_sql}, {right_sql})"


def probability(margin: str) -> str:
    return f"(1E0 / (1E0 + exp(-2E0 * {margin})))"


def _leaves(node: Node) -> int:
    return 1 if isinstance(node, float) else _leaves(node[2]) + _leaves(node[3])


def number(value: float) -> str:
    """A double as SQL text that reads back as the same double."""
    text = repr(float(value)).upper()
    return text if "E" in text or "INF" in text or "NAN" in text else text + "E0"


def _ordered(x: float) -> int:
    """Whole number that ascends with the double."""
    (bits,) = struct.unpack("<q", struct.pack("<d", x))
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _double(place: int) -> float:
    (x,) = struct.unpack("<d", struct.pack("<q", place if place >= 0 else (-place) | -0x8000000000000000))
    return x


LARGEST = 1.7976931348623157e308


def last_passing(scale: Scale, threshold: float) -> float:
    """The largest double that passes; the lowest there is if none does."""
    low, high = _ordered(-LARGEST), _ordered(LARGEST)
    if scale.passes(_double(high), threshold):
        return LARGEST
    while high - low > 1:
        middle = (low + high) // 2
        if scale.passes(_double(middle), threshold):
            low = middle
        else:
            high = middle
    return _double(low)


def parse_trees(description: str) -> list[Node]:
    """Trees of a fitted ensemble from its printed form, each leaf times the tree's weight."""
    trees, lines, weight = [], [], 1.0
    for line in [*(x.strip() for x in description.splitlines()), "Tree 0 (weight 1.0):"]:
        head = _TREE.match(line)
        if head:
            if lines:
                trees.append(_parse(iter(lines), weight))
            lines, weight = [], float(head.group(1))
        elif line.startswith(("If", "Predict")):
            lines.append(line)
    return trees


def _parse(lines: Iterator[str], weight: float) -> Node:
    line = next(lines)
    leaf = _LEAF.match(line)
    if leaf:
        return float(leaf.group(1)) * weight
    split = _IF.match(line)
    if not split:
        raise ValueError(f"not a split on a number: {line}")
    left = _parse(lines, weight)
    return int(split.group(1)), float(split.group(2)), left, _parse(lines, weight)
