"""Temporal windows and the stratified train/test split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Months of development data, months held out of time, train share, seed.
DEVELOPMENT_MONTHS = 12
OOT_MONTHS = 2
TRAIN_SHARE = 0.8
SEED = 88

# Leading hex digits of a row's hash that find the cut of an exact split: 16**4 slices.
SLICE_DIGITS = 4


def split_windows(
    train_date: Column, development_months: int = DEVELOPMENT_MONTHS, oot_months: int = OOT_MONTHS
) -> dict[str, Column]:
    """Bounds, both inclusive, of the out-of-time months and of the development months before."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "oot_start": oot_start,
        "oot_end": F.date_sub(train_date, 1),
        "train_test_start": F.add_months(oot_start, -development_months),
        "train_test_end": F.date_sub(oot_start, 1),
    }


def time_split(df: DataFrame, train_date: str | dt.date, snapshot: str = "snapshot_date", **months: int) -> DataFrame:
    """Rows of the two periods, tagged ``train_test`` or ``oot`` in the column ``period``."""
    w = split_windows(F.lit(train_date).cast("date"), **months)
    day = F.col(snapshot)
    period = F.when(day.between(w["oot_start"], w["oot_end"]), "oot").when(
        day.between(w["train_test_start"], w["train_test_end"]), "train_test"
    )
    # The closed range on the date itself is what reaches the scan as a partition filter.
    kept = df.where(day.between(w["train_test_start"], w["oot_end"]))
    return kept.withColumn("period", period).where(F.col("period").isNotNull())


def row_hash(keys: list[str], seed: int = SEED) -> Column:
    """Seeded hash text of a row's key: the same on every run and any partitioning."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))


def hash_split(df: DataFrame, keys: list[str], train_share: float = TRAIN_SHARE, seed: int = SEED) -> DataFrame:
    """Tag rows ``train`` or ``test`` in the column ``split`` by a threshold on their hash.

    A projection: no shuffle and one pass. Each label is split at the same share, up to
    binomial noise.
    """
    threshold = format(round(train_share * 16**8), "08x")
    return df.withColumn("split", F.when(row_hash(keys, seed).substr(1, 8) < threshold, "train").otherwise("test"))


def stratified_split(
    df: DataFrame, label: str, keys: list[str], train_share: float = TRAIN_SHARE, seed: int = SEED
) -> DataFrame:
    """Tag rows so that each label has the exact number of training rows.

    Of a label's ``n`` rows the ``n - ceil(n * (1 - share))`` with the lowest hashes train.
    Rows with the same key stay on the same side. The keys are read three times, so ``df``
    should be a stored table.
    """
    test_rows = F.ceil((F.col("_total") * F.lit(1 - train_share)).cast("decimal(28,6)"))
    hashed = _with_cuts(df, label, keys, F.array(F.col("_total") - test_rows), seed)
    split = F.when(F.col("_hash") <= F.col("_cuts")[0], "train").otherwise("test")
    return hashed.withColumn("split", split).select(*df.columns, "split")


def stratified_folds(df: DataFrame, label: str, keys: list[str], folds: int, seed: int = SEED) -> DataFrame:
    """Number rows 0 to ``folds - 1`` in the column ``fold``, with even counts of each label.

    The counts of a label differ by one row at most between folds, if keys are unique; rows
    with the same key share a fold.
    """
    ends = F.array(*[F.floor(F.col("_total") * i / folds) for i in range(1, folds)])
    hashed = _with_cuts(df, label, keys, ends, seed)
    below = F.filter("_cuts", lambda cut: cut < F.col("_hash"))
    return hashed.withColumn("fold", F.size(below)).select(*df.columns, "fold")


def _with_cuts(df: DataFrame, label: str, keys: list[str], ranks: Column, seed: int) -> DataFrame:
    """Rows with ``_hash`` and ``_cuts``: the hashes at the wanted ranks of the row's label.

    ``ranks`` is an array of ascending row counts, stated by the label's ``_total``; a rank of
    0 has a cut below all hashes. Counting hash slices finds the slices with the cuts, and only
    the hashes of those slices are ranked, so no label has to fit a task. The rows meet the cuts
    where they lie: shuffled by label, all rows of a label would end in one task.
    """
    hashed = df.withColumn("_hash", row_hash(keys, seed)).withColumn("_slice", F.col("_hash").substr(1, SLICE_DIGITS))
    in_label = Window.partitionBy(label)
    slices = hashed.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    ranked = slices.select(
        F.col(label).alias("_label"),
        "_slice",
        "_n",
        F.sum("_n").over(in_label.orderBy("_slice")).alias("_upto"),
        F.sum("_n").over(in_label).alias("_total"),
    )
    located = (
        ranked.select("*", F.posexplode(ranks).alias("_i", "_at"))
        .where((F.col("_at") > F.col("_upto") - F.col("_n")) & (F.col("_at") <= F.col("_upto")))
        .select("_label", "_slice", "_i", (F.col("_at") - F.col("_upto") + F.col("_n")).alias("_rank"))
    )
    upto = F.sum("_n").over(
        Window.partitionBy("_label", "_slice", "_i").orderBy("_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        hashed.groupBy(F.col(label).alias("_label"), "_slice", "_hash")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(located, ["_label", "_slice"], "inner")
        .withColumn("_upto", upto)
        .where(F.col("_upto") >= F.col("_rank"))
        .groupBy("_label", "_i")
        .agg(F.min("_hash").alias("_cut"))
    )
    # A few cuts a label; a rank of 0 found none and is below every hash.
    listed = found.groupBy("_label").agg(F.map_from_entries(F.collect_list(F.struct("_i", "_cut"))).alias("_found"))
    wanted = ranked.select("_label", F.transform(ranks, lambda _, i: i).alias("_places")).distinct()
    cuts = wanted.join(listed, "_label", "left").select(
        "_label", F.transform("_places", lambda i: F.coalesce(F.col("_found")[i], F.lit(""))).alias("_cuts")
    )
    # One row a label.
    return hashed.join(F.broadcast(cuts), F.col(label) == F.col("_label"), "left")


def split_stats(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Rows and label mean of each split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(label).alias("n_bad"), F.avg(label).alias("label_mean")
    )
