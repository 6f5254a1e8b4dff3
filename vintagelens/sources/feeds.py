"""Raw CSV feeds and their bronze tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens.functions.cleaning import lenient_int, parse_date

# Columns that tell where a row of a feed comes from.
FILE = "_file"


def read_feed(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """CSV feed with a header. Every column is a string: no inference pass over the data.

    Each file's header is checked, so a file with other or reordered columns is an error.
    ``with_file`` adds the name of each row's file.
    """
    rows = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)
    return rows.withColumn(FILE, F.col("_metadata.file_name")) if with_file else rows


def problems(types: Mapping[str, str]) -> Column:
    """Array of the texts of a raw row that are there and do not parse, as ``column: text``."""
    parsers = {"date": parse_date, "int": lenient_int, "float": lambda c: F.col(c).try_cast("float")}

    def problem(name: str, parse) -> Column:
        text = F.col(name)
        wrong = text.isNotNull() & (F.trim(text) != "") & parse(name).isNull()
        return F.when(wrong, F.concat(F.lit(f"{name}: "), text))

    return F.filter(F.array(*[problem(n, parsers[t]) for n, t in types.items() if t in parsers]), lambda p: p.isNotNull())


def sort_out(raw: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows of a raw feed all of whose texts parse, and the others with file, line and reasons.

    The two hold each row of ``raw`` once. ``line`` is the row as CSV, ``file`` its file where the
    feed was read with it, ``reasons`` an array. Blank and missing texts are no problem. Expects
    text columns; a column that is typed already cannot be wrong.
    """
    texts = {c for c, kind in raw.dtypes if kind == "string"}
    marked = raw.withColumn("_reasons", problems({c: t for c, t in types.items() if c in texts}))
    columns = [c for c in raw.columns if c != FILE]
    file = F.col(FILE) if FILE in raw.columns else F.lit(None).cast("string")
    held = marked.where(F.size("_reasons") > 0).select(
        *columns, file.alias("file"), F.to_csv(F.struct(*columns)).alias("line"), F.col("_reasons").alias("reasons")
    )
    return marked.where(F.size("_reasons") == 0).drop("_reasons"), held


def quarantine_counts(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows of each snapshot, as it is written in the feed: all, kept and held back."""
    held = F.size(problems(types)) > 0
    return raw.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_raw"), F.count_if(~held).alias("n_kept"), F.count_if(held).alias("n_held")
    )


def feed_counts(raw: DataFrame, start: str, end: str) -> DataFrame:
    """What ``bronze`` does with the rows of a feed: one row of counts."""
    day = F.col("snapshot_date") if dict(raw.dtypes)["snapshot_date"] == "date" else parse_date("snapshot_date")
    inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return raw.agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if(day.isNull()).alias("n_no_date"),
        F.count_if(~inside).alias("n_outside"),
        F.count_if(inside).alias("n_kept"),
    )


def bronze(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Raw rows of all snapshots in the closed period, values as read.

    Only the snapshot date is parsed, because it is the partition key. One pass covers
    the whole period; a single snapshot is the period from a date to itself.
    """
    if dict(raw.dtypes)["snapshot_date"] != "date":
        raw = raw.withColumn("snapshot_date", parse_date("snapshot_date"))
    return raw.where(F.col("snapshot_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
