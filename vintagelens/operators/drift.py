"""Distribution drift: breakpoints, histograms, population stability index and density.

Tables of breakpoints and of density settings hold one row per group, a model and snapshot,
with at most ``buckets + 1`` numbers. They are joined without hints: the groups are the
caller's, and Spark broadcasts them where their measured size allows it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.operators.ranking import percentiles

BUCKETS = 10
# Share given to a bin that is empty on one side, so that its logarithm is finite.
EMPTY_SHARE = 1e-6

# The density grid and the reach of the kernel, in bandwidths.
GRID_POINTS = 200
GRID_MARGIN = 3
# exp(-z*z/2) is exactly zero in double precision from here on.
KERNEL_REACH = 39
# Bins per bandwidth of the binned density, and the reach of its kernel: exp(-z*z/2) < 1e-15.
BINS_PER_BANDWIDTH = 1_000
BINNED_REACH = 8.5


def breakpoints(
    df: DataFrame, groups: list[str], value: str, buckets: int = BUCKETS, strict: bool = True
) -> DataFrame:
    """Distinct quantile edges per group, ascending, as the array ``edges``.

    Fewer than two bins leave nothing to compare: an error, or with ``strict=False`` NULL for
    that group. Rows without a group are left out.
    """
    probabilities = [i / buckets for i in range(buckets + 1)]
    edges = F.array_distinct("percentiles")
    error = F.raise_error(F.lit("too few distinct values to form bins"))
    too_few = (error if strict else F.lit(None)).cast("array<double>")
    checked = F.when(F.size(edges) > 2, edges).otherwise(too_few)
    # Stated here, because the optimizer would push it into one of two uses of the cell counts
    # and thereby keep them from sharing one shuffle.
    for group in groups:
        df = df.where(F.col(group).isNotNull())
    return percentiles(df, groups, value, probabilities).select(*groups, checked.alias("edges"))


def histogram(
    df: DataFrame, edges: DataFrame, groups: list[str], value: str, buckets: int = BUCKETS, tags: tuple[str, ...] = ()
) -> DataFrame:
    """Rows per bin: right-closed bins numbered from 1, the first also closed on the left.

    Values outside the edges are not counted. Counting happens before the shuffle. Counts
    are kept apart by the columns ``tags``, of the rows or of several edges of one group.
    """
    x = F.col(value).cast("double")
    lowest, highest = F.get("edges", F.lit(0)), F.element_at("edges", -1)
    edges_below = F.expr(" + ".join(f"if(get(edges, {i}) < double(`{value}`), 1, 0)" for i in range(buckets + 1)))
    rows = df.where(F.col(value).isNotNull())
    binned = rows.join(edges, groups, "inner") if groups else rows.withColumn("edges", edges.scalar())
    return (
        binned.where((x >= lowest) & (x <= highest))
        .groupBy(*groups, *tags, F.greatest(edges_below, F.lit(1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def shares(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Histogram counts with their share of the counted rows of the group."""
    total = F.sum("n_rows").over(Window.partitionBy(*groups))
    return counts.withColumn("share", F.col("n_rows") / total)


def stability_index(counts: DataFrame, groups: list[str], floor: float | None = EMPTY_SHARE) -> DataFrame:
    """PSI per group from histograms over the same bins, told apart by ``side``.

    ``side`` is ``expected`` or ``actual``. A bin that is empty on one side takes the share
    ``floor``; with ``floor=None`` the index is infinite. Groups that lack one of the sides
    are left out.
    """
    bins = counts.groupBy(*groups, "bin").agg(
        F.sum(F.when(F.col("side") == "expected", F.col("n_rows")).otherwise(0)).alias("n_e"),
        F.sum(F.when(F.col("side") == "actual", F.col("n_rows")).otherwise(0)).alias("n_a"),
    )
    in_group = Window.partitionBy(*groups)
    totals = bins.withColumns({"t_e": F.sum("n_e").over(in_group), "t_a": F.sum("n_a").over(in_group)})
    e, a = F.col("n_e") / F.col("t_e"), F.col("n_a") / F.col("t_a")
    return (
        totals.where((F.col("t_e") > 0) & (F.col("t_a") > 0))
        .groupBy(*groups)
        .agg(F.sum(_contribution(e, a, floor)).alias("psi"))
    )


def psi(
    expected: DataFrame,
    actual: DataFrame,
    groups: list[str],
    value: str,
    buckets: int = BUCKETS,
    floor: float | None = EMPTY_SHARE,
) -> DataFrame:
    """PSI of ``actual`` against ``expected`` on quantile bins of ``expected``.

    One row per group, or one in all if there are no groups.
    """
    edges = breakpoints(expected, groups, value, buckets)
    expected, actual = (
        df.select(*groups, value, F.lit(side).alias("side")) for df, side in ((expected, "expected"), (actual, "actual"))
    )
    counts = histogram(expected.unionByName(actual), edges, groups, value, buckets, tags=("side",))
    return stability_index(counts, groups, floor)


def psi_by_snapshot(
    predictions: DataFrame,
    groups: list[str],
    value: str = "model_predictions",
    buckets: int = BUCKETS,
    floor: float | None = EMPTY_SHARE,
    snapshot: str = "snapshot_date",
    strict: bool = False,
) -> DataFrame:
    """PSI of every snapshot against the snapshot one month before it.

    Where that snapshot has too few distinct values to form bins, the PSI is NULL, or with
    ``strict=True`` the job fails.

    Each row is counted twice in one pass: on the edges of its own snapshot, as expected
    value of the month after, and on those of the month before, as actual value. Only
    edges and counts move to the following month, not the rows.
    """
    keys = [*groups, snapshot]
    own = breakpoints(predictions, keys, value, buckets, strict)
    # One expansion rather than a union of both uses: a union would compute the edges twice.
    in_own = F.array(F.struct(F.lit("expected").alias("side"), F.col(snapshot).alias("day")))
    in_next = F.transform(_one_month_after(snapshot), lambda d: F.struct(F.lit("actual").alias("side"), d.alias("day")))
    edges = own.select(*groups, "edges", F.explode(F.concat(in_own, in_next)).alias("_use")).select(
        *groups, F.col("_use.day").alias(snapshot), F.col("_use.side").alias("side"), "edges"
    )
    counts = histogram(predictions, edges, keys, value, buckets, tags=("side",))
    compared_in = F.when(F.col("side") == "expected", _one_month_after(snapshot)).otherwise(F.array(snapshot))
    index = stability_index(counts.withColumn(snapshot, F.explode(compared_in)), keys, floor)
    if strict:
        return index
    # Snapshots that follow one without bins: they have no index, but they are not left out.
    blank = own.where(F.col("edges").isNull()).select(*groups, F.explode(_one_month_after(snapshot)).alias(snapshot))
    unknown = own.select(*keys).join(blank, keys, "left_semi").withColumn("psi", F.lit(None).cast("double"))
    return index.unionByName(unknown)


def baselines(
    predictions: DataFrame,
    groups: list[str],
    value: str = "model_predictions",
    buckets: int = BUCKETS,
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """What later snapshots are compared with: ``edges`` and rows per bin (``counts``) of each snapshot.

    One short row per group and snapshot. A snapshot with too few distinct values to form bins
    has NULL for both.
    """
    keys = [*groups, snapshot]
    own = breakpoints(predictions, keys, value, buckets, strict=False)
    counted = histogram(predictions, own, keys, value, buckets)
    # At most ``buckets`` entries are collected per group.
    listed = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n_rows"))).alias("_n"))
    in_order = F.transform(F.sequence(F.lit(1), F.size("edges") - 1), lambda b: F.coalesce(F.col("_n")[b], F.lit(0)).cast("long"))
    return own.join(listed, keys, "left").select(*keys, "edges", F.when(F.col("edges").isNotNull(), in_order).alias("counts"))


def psi_from_baselines(
    predictions: DataFrame,
    stored: DataFrame,
    groups: list[str],
    value: str = "model_predictions",
    buckets: int = BUCKETS,
    floor: float | None = EMPTY_SHARE,
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """PSI of every snapshot against the stored baseline of the snapshot one month before it.

    Equal to ``psi_by_snapshot`` for the snapshots in ``predictions``, without reading the
    predictions of the month before.
    """
    keys = [*groups, snapshot]
    moved = stored.select(*groups, F.explode(_one_month_after(snapshot)).alias(snapshot), "edges", "counts")
    actual = histogram(predictions, moved.drop("counts"), keys, value, buckets).withColumn("side", F.lit("actual"))
    there = predictions.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys).distinct()
    compared = moved.join(there, keys, "left_semi")
    expected = compared.select(*keys, F.posexplode("counts").alias("_at", "n_rows"), F.lit("expected").alias("side"))
    expected = expected.withColumn("bin", F.col("_at") + 1).drop("_at")
    index = stability_index(actual.select(*keys, "bin", "n_rows", "side").unionByName(expected), keys, floor)
    unknown = compared.where(F.col("edges").isNull()).select(*keys, F.lit(None).cast("double").alias("psi"))
    return index.unionByName(unknown)


def score_density(df: DataFrame, groups: list[str], value: str, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density per group on an even grid.

    Scott bandwidth, grid three bandwidths past the extremes. Equal scores are counted
    first; a score then adds only to grid points inside the reach of its kernel. Groups
    with fewer than two distinct scores have no density.
    """
    scores = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_x"))
    settings = _density_settings(scores, groups, points)
    cells = scores.groupBy(*groups, "_x").agg(F.count(F.lit(1)).alias("_w"))
    reach = KERNEL_REACH * F.col("_h")
    first = F.greatest(F.lit(0), F.ceil((F.col("_x") - reach - F.col("_start")) / F.col("_step")).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((F.col("_x") + reach - F.col("_start")) / F.col("_step")).cast("int"))
    z = (F.col("_start") + F.col("point") * F.col("_step") - F.col("_x")) / F.col("_h")
    sums = (
        cells.join(settings, groups, "inner")
        .withColumn("point", F.explode(F.sequence(first, last)))
        .groupBy(*groups, "point")
        .agg(F.sum(F.col("_w") * F.exp(-0.5 * z * z)).alias("_sum"))
    )
    return _on_grid(settings, sums, groups, points)


def score_density_binned(
    df: DataFrame, groups: list[str], value: str, points: int = GRID_POINTS, per_bandwidth: int = BINS_PER_BANDWIDTH
) -> DataFrame:
    """``score_density`` from linearly binned scores: bins add to the grid, not scores.

    A score is shared by the two bin centres around it, by nearness. With ``r`` bins per bandwidth
    ``h`` the density is off by less than 0.05 / (h * r * r). The number of bins is that of the range
    in bandwidths times ``r``, however many scores there are, and binning counts before the shuffle.
    """
    scores = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_x"))
    settings = _density_settings(scores, groups, points).withColumn("_width", F.col("_h") / per_bandwidth)
    place = (F.col("_x") - F.col("_min")) / F.col("_width")
    low = F.floor(place)
    shares = F.array(
        F.struct(low.alias("bin"), (1 - (place - low)).alias("share")), F.struct((low + 1).alias("bin"), (place - low).alias("share"))
    )
    bins = (
        scores.join(settings, groups, "inner")
        .select(*groups, F.inline(shares))
        .groupBy(*groups, "bin")
        .agg(F.sum("share").alias("_w"))
        .where("_w > 0")
    )
    placed = bins.join(settings, groups, "inner").withColumn("_x", F.col("_min") + F.col("bin") * F.col("_width"))
    reach = BINNED_REACH * F.col("_h")
    first = F.greatest(F.lit(0), F.ceil((F.col("_x") - reach - F.col("_start")) / F.col("_step")).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((F.col("_x") + reach - F.col("_start")) / F.col("_step")).cast("int"))
    z = (F.col("_start") + F.col("point") * F.col("_step") - F.col("_x")) / F.col("_h")
    sums = (
        placed.where(first <= last)
        .withColumn("point", F.explode(F.sequence(first, last)))
        .groupBy(*groups, "point")
        .agg(F.sum(F.col("_w") * F.exp(-0.5 * z * z)).alias("_sum"))
    )
    return _on_grid(settings, sums, groups, points)


def _density_settings(scores: DataFrame, groups: list[str], points: int) -> DataFrame:
    """Number of scores, bandwidth, lowest score, start and step of the grid of each group."""
    n, spread = F.count(F.lit(1)).cast("double"), F.stddev_samp("_x")
    bandwidth = spread * F.pow(n, F.lit(-0.2))
    return (
        scores.groupBy(*groups)
        .agg(n.alias("_n"), bandwidth.alias("_h"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
        .where(F.col("_max") > F.col("_min"))
        .withColumn("_start", F.col("_min") - GRID_MARGIN * F.col("_h"))
        .withColumn("_step", (F.col("_max") + GRID_MARGIN * F.col("_h") - F.col("_start")) / (points - 1))
        .select(*groups, "_n", "_h", "_min", "_start", "_step")
    )


def _on_grid(settings: DataFrame, sums: DataFrame, groups: list[str], points: int) -> DataFrame:
    grid = settings.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return grid.join(sums, [*groups, "point"], "left").select(
        *groups,
        "point",
        (F.col("_start") + F.col("point") * F.col("_step")).alias("score"),
        (F.coalesce("_sum", F.lit(0.0)) / scale).alias("density"),
    )


def _contribution(expected: Column, actual: Column, floor: float | None) -> Column:
    if floor is None:
        one_sided = (expected == 0) | (actual == 0)
        safe = F.when(~one_sided, (actual - expected) * F.ln(actual / F.nullif(expected, F.lit(0.0))))
        return F.when((expected == 0) & (actual == 0), 0.0).when(one_sided, float("inf")).otherwise(safe)
    e = F.when(expected == 0, floor).otherwise(expected)
    a = F.when(actual == 0, floor).otherwise(actual)
    return (a - e) * F.ln(a / e)


def _one_month_after(snapshot: str) -> Column:
    """All days whose day one month before is the snapshot.

    28 February is one month before each of 28 to 31 March; 31 January before no day at all.
    """
    day = F.col(snapshot)
    next_month = F.add_months(day, 1)
    last = F.when(day == F.last_day(day), F.last_day(next_month)).otherwise(next_month)
    return F.filter(F.sequence(next_month, last), lambda d: F.add_months(d, -1) == day)
