"""Session helpers: a tuned session, shared scratch folders, stored intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "quireflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library expects; extra settings win.

    On a cluster the submit command sets the master, memory and partition counts.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # A scan is cut into a task per core at least, small tables into fewer.
        "spark.sql.files.openCostInBytes": "131072",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a fresh folder under /tmp: there the driver and
    the tasks see the same disk.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quireflow-", dir="/tmp"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses (not created yet)."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    Cuts the lineage like a checkpoint and keeps columns, statistics and pruning; later
    plans read the same rows even after executors are lost.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
