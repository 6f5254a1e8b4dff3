"""Tables partitioned by snapshot date: sinks and pruned reads.

A write that replaces a period goes in two phases. The new partitions are written to a side
folder of the table, whose name readers pass over; then an intent is recorded, with the period
and the partitions that shall be there; then partition folders are swapped, absent ones removed,
and the intent is dropped. A job that dies before the intent leaves the table as it was; one
that dies after it is finished by the next write, or by ``recover``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SNAPSHOT = "snapshot_date"
# Side folders of a table: readers leave out names that begin with an underscore.
STAGED = "_staged"
INTENTS = "_intents"
STARTED = "-started"


def write_snapshots(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (SNAPSHOT,),
    rebalance: bool = True,
    period: tuple[str | dt.date, str | dt.date] | None = None,
    within: Mapping[str, str] | None = None,
) -> None:
    """Write the snapshots in ``df``, replacing those and leaving all others in place.

    With a closed ``period``, a snapshot in it that ``df`` no longer has is removed as well, and
    the whole period changes over in two phases; ``within`` limits that to partitions with the
    given values of other partition columns.

    The rebalance hint gathers the rows of a snapshot so that each becomes a few files of
    the advisory size, and lets AQE split a snapshot that holds a large share of the rows.
    Rows read from a table with the same partitions and changed one by one lie together
    already: they are written with ``rebalance=False``, without a shuffle.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if rebalance else df
    if period is None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).parquet(path)
        return
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    swap(spark, path, stage(rows, path, partition_by, period, within))


def stage(rows: DataFrame, path: str, partition_by, period, within=None) -> str:
    """First phase: rows in a side folder, then the recorded intent, whose name is returned."""
    name, path = uuid.uuid4().hex, path.rstrip("/")
    staged = f"{path}/{STAGED}/{name}"
    rows.write.partitionBy(*partition_by).parquet(staged)
    files = _Files(rows.sparkSession, path)
    intent = {
        "columns": list(partition_by),
        "period": [_date(d).isoformat() for d in period],
        "within": dict(within or {}),
        "kept": files.partitions(staged, partition_by),  # one entry per partition: at most the calendar's dates
    }
    files.write(f"{path}/{INTENTS}/{name}", json.dumps(intent))
    return name


def swap(spark: SparkSession, path: str, name: str) -> None:
    """Second phase, which may be repeated: what has been swapped is no longer in the side folder."""
    path = path.rstrip("/")
    files, staged, at = _Files(spark, path), f"{path}/{STAGED}/{name}", f"{path}/{INTENTS}/{name}"
    intent = json.loads(files.read(at))
    columns, kept = intent["columns"], {tuple(p) for p in intent["kept"]}
    for part in files.partitions(staged, columns):
        files.replace(f"{staged}/{'/'.join(part)}", f"{path}/{'/'.join(part)}")
    first, last = intent["period"]
    for part in files.partitions(path, columns):
        values = dict(unquote(p).split("=", 1) for p in part)
        inside = first <= values[SNAPSHOT] <= last and all(values[c] == v for c, v in intent["within"].items())
        if inside and tuple(part) not in kept:
            files.delete(f"{path}/{'/'.join(part)}")
    files.delete(at)
    files.delete(staged)


def recover(spark: SparkSession, path: str) -> int:
    """Finish the swaps that were recorded and not carried out, and drop what was never recorded."""
    files, path = _Files(spark, path), path.rstrip("/")
    names = files.names(f"{path}/{INTENTS}")
    for name in names:
        swap(spark, path, name)
    for name in files.names(f"{path}/{STAGED}"):
        files.delete(f"{path}/{STAGED}/{name}")
    return len(names)


class _Files:
    """Folders and small files where the table lies, in any store that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.system = self.path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.system.globStatus(self.path(f"{folder}/*")) or [])

    def partitions(self, folder: str, columns: Sequence[str]) -> list[list[str]]:
        """Partition folders as lists such as ["model_name=m1", "snapshot_date=2024-01-01"]."""
        found = self.system.globStatus(self.path("/".join([folder, *[f"{c}=*" for c in columns]]))) or []
        return [s.getPath().toUri().getPath().rstrip("/").split("/")[-len(columns) :] for s in found]

    def replace(self, source: str, target: str) -> None:
        self.delete(target)
        self.system.mkdirs(self.path(target).getParent())
        if not self.system.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        self.system.delete(self.path(path), True)

    def write(self, path: str, text: str) -> None:
        """A file that is there as a whole or not at all."""
        folder, name = path.rsplit("/", 1)
        started = self.path(f"{folder}{STARTED}/{name}")
        out = self.system.create(started, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.system.mkdirs(self.path(path).getParent())
        if not self.system.rename(started, self.path(path)):
            raise OSError(f"cannot record {path}")

    def read(self, path: str) -> str:
        stream = self.system.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def read_all(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Whole table. A known schema saves the footer read that inference needs."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_one(spark: SparkSession, path: str, snapshot: str | dt.date, schema: StructType | str | None = None) -> DataFrame:
    return snapshot_equals(read_all(spark, path, schema), snapshot)


def read_listed(
    spark: SparkSession, path: str, snapshots: Iterable[str | dt.date], schema: StructType | str | None = None
) -> DataFrame:
    """The listed snapshots; one that is not in the table contributes nothing."""
    return read_all(spark, path, schema).where(F.col(SNAPSHOT).isin([_date(s) for s in snapshots]))


def snapshot_equals(df: DataFrame, snapshot: str | dt.date) -> DataFrame:
    return df.where(F.col(SNAPSHOT) == F.lit(_date(snapshot)))


def snapshot_between(df: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    return df.where(F.col(SNAPSHOT).between(F.lit(_date(start)), F.lit(_date(end))))


def _date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
