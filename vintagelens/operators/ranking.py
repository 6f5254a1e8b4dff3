"""Exact order statistics without a global sort: percentiles and ROC AUC.

A running count over all values of a group would put the whole group into one task.
Instead the value axis is cut into ranges that hold about equally many rows (a sketch of
fixed size, read by a scalar subquery), equal values are counted before the shuffle, and
running counts are taken inside each (group, range). A range that still holds too many distinct
values is cut again by a sketch of its own, and so on. Range totals then give the counts below
each range. The result does not depend on where the cuts lie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The value axis is cut into BASE * BASE ranges, found digit by digit.
BASE = 16
# Accuracy of the sketches: the rank of a cut is off by one part in so many.
ACCURACY = 1_000
# A range with more distinct values is cut again, up to so many times. A window partition then
# holds about MOST_VALUES values at most while a group has fewer than MOST_VALUES * 256 ** (1 + CUTS),
# which is 1e10 with one more cut.
MOST_VALUES = 200_000
CUTS = 1
# Pair counts are summed in a lower part of this many bits and the rest.
PART_BITS = 20


def percentiles(df: DataFrame, groups: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Exact percentiles per group with linear interpolation.

    One row per group: ``n`` values and the array ``percentiles`` in the given order.
    """
    cells = (
        _ranged(df.where(F.col(value).isNotNull() & ~F.isnan(value)), groups, value, [])
        .groupBy(*groups, "_range", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    cells = split_full_ranges(cells, groups, ["_n"])
    ranked = _with_wanted_ranks(cells, groups, probabilities).select(
        *groups, "n", "_value", "_n", (F.col("_below") + F.col("_upto")).alias("_last"), F.explode("_wanted").alias("_w")
    )
    # A value covers the zero-based ranks [last - n, last).
    rank = F.col("_w.rank")
    ends = (
        ranked.where((rank >= F.col("_last") - F.col("_n")) & (rank < F.col("_last")))
        .groupBy(*groups, "n", F.col("_w.i").alias("i"))
        .agg(
            F.max(F.when(~F.col("_w.upper"), F.col("_value"))).alias("lo"),
            F.max(F.when(F.col("_w.upper"), F.col("_value"))).alias("hi"),
            F.max("_w.t").alias("t"),
        )
    )
    width = F.col("hi") - F.col("lo")
    between = F.when(F.col("t") >= 0.5, F.col("hi") - width * (1 - F.col("t"))).otherwise(F.col("lo") + width * F.col("t"))
    # At most len(probabilities) entries are collected per group.
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("i", between.alias("v")))), lambda s: s["v"])
    return ends.groupBy(*groups, "n").agg(in_order.alias("percentiles"))


def _with_wanted_ranks(cells: DataFrame, groups: list[str], probabilities: list[float]) -> DataFrame:
    """Cells of the ranges that hold a wanted rank, with their running count ``_upto``.

    Range totals tell which ranges those are, two per probability at most, so that only
    they are sorted.
    """
    by_group = Window.partitionBy(*groups)
    totals = (
        cells.groupBy(*groups, "_range")
        .agg(F.sum("_n").alias("_n_range"))
        .select(
            *groups,
            "_range",
            "_n_range",
            (F.sum("_n_range").over(by_group.orderBy("_range")) - F.col("_n_range")).alias("_below"),
            F.sum("_n_range").over(by_group).alias("n"),
        )
    )

    position = "p * (n - 1)"
    ends = ", ".join(
        f"named_struct('i', i, 'upper', {upper}, 'rank', {end}({position}), 't', {position} - floor({position}))"
        for upper, end in (("false", "floor"), ("true", "ceil"))
    )
    listed = ", ".join(f"{float(p)!r}D" for p in probabilities)
    wanted = F.expr(
        f"filter(flatten(transform(array({listed}), (p, i) -> array({ends}))), "
        "w -> w.rank >= _below and w.rank < _below + _n_range)"
    )
    needed = totals.withColumn("_wanted", wanted).where(F.size("_wanted") > 0)
    same = [F.col(f"c.{g}").eqNullSafe(F.col(f"t.{g}")) for g in [*groups, "_range"]]
    upto = F.sum("_n").over(
        Window.partitionBy(*groups, "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cells.alias("c")
        .join(needed.alias("t"), same)
        .select(*[f"c.{g}" for g in groups], "c._range", "_value", "_n", "n", "_below", "_wanted")
        .withColumn("_upto", upto)
    )


def auc(df: DataFrame, groups: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve per group, ties counted half.

    One row per group: ``n_pos``, ``n_neg`` and ``roc_auc``, NULL if a class is absent.
    The pair counts are exact decimals, so the result is one division away from exact.
    """
    usable = df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    cells = (
        _ranged(usable, groups, score, [F.col(label).alias("_label")])
        .groupBy(*groups, "_range", "_value")
        .agg(F.count_if(F.col("_label") == 1).alias("_pos"), F.count_if(F.col("_label") != 1).alias("_neg"))
    )
    cells = split_full_ranges(cells, groups, ["_pos", "_neg"])
    below = F.sum("_neg").over(
        Window.partitionBy(*groups, "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("_neg")
    # Twice the lower negatives plus the tied ones, in two parts whose products with a
    # count of up to 2**40 rows stay inside 64 bits. Decimals enter with the range totals.
    beaten = cells.select(*groups, "_range", "_pos", "_neg", (2 * below + F.col("_neg")).alias("_beaten"))
    upper, lower = F.shiftright("_beaten", PART_BITS), F.col("_beaten").bitwiseAND(2**PART_BITS - 1)
    ranges = beaten.groupBy(*groups, "_range").agg(
        F.sum(F.col("_pos") * upper).alias("_upper"),
        F.sum(F.col("_pos") * lower).alias("_lower"),
        F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"),
    )
    wins = F.col("_upper").cast("decimal(19,0)") * F.lit(2**PART_BITS).cast("decimal(19,0)") + F.col("_lower")
    per_range = ranges.withColumn("_wins", wins.cast("decimal(38,0)"))
    below = F.sum("_neg").over(Window.partitionBy(*groups).orderBy("_range")) - F.col("_neg")
    totals = (
        per_range.withColumn("_wins", F.col("_wins") + _pairs("_pos", 2 * below))
        .groupBy(*groups)
        .agg(F.sum("_wins").alias("_wins"), F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    )
    pairs = _pairs("n_pos", 2 * F.col("n_neg")).cast("double")
    return totals.select(*groups, "n_pos", "n_neg", F.try_divide(F.col("_wins").cast("double"), pairs).alias("roc_auc"))


def _pairs(count: str, other: Column) -> Column:
    """Product of two counts, wide enough for any number of rows."""
    return F.col(count).cast("decimal(19,0)") * other.cast("decimal(19,0)")


def _ranged(df: DataFrame, groups: list[str], value: str, carried: list[Column]) -> DataFrame:
    """``df`` with ``_value`` and the number ``_range`` of the value range it falls into.

    The cuts are the same for all groups, so no range of a group holds more than about
    1 in BASE * BASE of all distinct values, however large the group is.
    """
    cuts = df.agg(_sketch(f"double(`{value}`)")).scalar()
    rows = df.select(*groups, F.col(value).cast("double").alias("_value"), *carried, cuts.alias("_cuts"))
    return _numbered(rows).withColumnRenamed("_inner", "_range").drop("_cuts")


def split_full_ranges(
    cells: DataFrame, groups: list[str], counts: list[str], most_values: int | None = None, cuts: int | None = None
) -> DataFrame:
    """``cells`` with ``_range`` made finer where a range holds more than ``most_values`` cells.

    Each cut divides a full range into up to BASE * BASE by a sketch of its values. Ranges keep
    their order. Where no range is full, the join meets an empty side and falls away at run time.
    Both uses of the cells read the ``counts`` columns, so that they share one shuffle.
    """
    most_values = MOST_VALUES if most_values is None else most_values
    keys = [*groups, "_range"]
    cells = cells.withColumn("_range", F.col("_range").cast("long"))
    for _ in range(CUTS if cuts is None else cuts):
        counted = F.sum(sum((F.col(c) for c in counts), F.lit(0))).alias("_rows")
        sizes = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cells"), counted, _sketch("_value"))
        full = sizes.where((F.col("_cells") > most_values) & (F.col("_rows") > 0)).select(*keys, "_cuts")
        joined = cells.alias("c").join(full.alias("t"), _same(keys), "left").select("c.*", "t._cuts")
        finer = F.col("_range") * (BASE * BASE) + F.when(F.col("_cuts").isNull(), 0).otherwise(F.col("_inner"))
        cells = _numbered(joined).withColumn("_range", finer).drop("_cuts", "_inner")
    return cells


def _same(keys: list[str]) -> list[Column]:
    return [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]


def _sketch(value: str) -> Column:
    """Cuts between BASE * BASE ranges of about equally many rows, as the array ``_cuts``."""
    ranges = BASE * BASE
    steps = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    return F.expr(f"percentile_approx({value}, array({steps}), {ACCURACY})").alias("_cuts")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``_inner``: the number of the range, by their ``_cuts``, that ``_value`` lies in."""
    return (
        rows.withColumn("_high", F.expr(_digit(lambda i: f"get(_cuts, {i * BASE + BASE - 1})")))
        .withColumn("_low", F.expr(_digit(lambda i: f"get(_cuts, _high * {BASE} + {i})")))
        .withColumn("_inner", F.col("_high") * BASE + F.col("_low"))
        .drop("_high", "_low")
    )


def _digit(cut: Callable[[int], str], first: int = 0, last: int | None = None) -> str:
    """Binary search among sorted cuts as nested conditions, which stay inside generated code.

    One digit of base 16 keeps the generated method small enough to be compiled by the JVM;
    a single search among all cuts would not be.
    """
    last = BASE - 1 if last is None else last
    if first == last:
        return str(first)
    middle = (first + last) // 2
    lower, upper = _digit(cut, first, middle), _digit(cut, middle + 1, last)
    return f"if(_value <= {cut(middle)}, {lower}, {upper})"
