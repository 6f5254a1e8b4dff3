"""Session settings the engine relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings. All of them can be changed on a live session.
SQL_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, also where that costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods beyond this are never compiled by the JVM: better no whole-stage code then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "vintagelens", master: str | None = None, **conf: str) -> SparkSession:
    """Session for the command line, the tests and the benchmark.

    On a cluster leave ``master`` out: it comes from spark-submit, as do executor sizes.
    """
    # Recording the Python line of every expression multiplies the time to build a plan.
    builder = SparkSession.builder.appName(app).config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster a
    machine-local path would not survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="vintagelens-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """Path for a table written between two jobs, unique per call."""
    return f"{shared_dir(spark)}/vintagelens/{name}-{uuid.uuid4().hex}"
