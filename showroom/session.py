"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", app: str = "showroom", **extra: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHOWROOM_DRIVER_MEMORY", "8g"))
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Timestamps without a zone are read as UTC everywhere in this package."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and hand-over tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of this machine.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder so that later passes read the same rows."""
    ensure_shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_lookup(df: DataFrame) -> DataFrame:
    """The small side of a join as a stored table: Spark knows its bytes and broadcasts it only below its own limit."""
    return hand_over(df, "lookup")


def hand_over(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a wide table to the shared folder as Parquet and read it back.

    Later passes read only the columns they need, and lost executors cost nothing but the task.
    """
    path = f"{ensure_shared_folder(df.sparkSession)}/hand-over/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
