"""Managed and external tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from quireflow.sources import files

APPEND_JOB, APPEND_VERSION = "append_job", "append_version"


def use_database(spark: SparkSession, name: str, location: str | None = None, reset: bool = False) -> None:
    """Create the database if needed and switch to it; ``reset`` drops its tables first."""
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    spark.sql(f"USE {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def save_table(
    df: DataFrame, name: str, mode: str = "errorifexists", even: bool = False
) -> DataFrame:
    """Write a managed table and return it as read back, so that later layers start from
    the stored rows instead of computing them again.

    ``even`` evens out file sizes at the price of an exchange; worth it after a filter
    that left many small partitions, not after a shuffle, which run-time coalescing has
    already sized.
    """
    df = df.hint("rebalance") if even else df
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def append_predictions(
    df: DataFrame, name: str, path: str, job: str = "append", version: str | int | None = None
) -> DataFrame:
    """Append to a path, once for each ``(job, version)``, and register it as a table.

    The rows are written to a folder that readers skip, and published by one rename to
    ``append_job=…/append_version=…``, two columns of the table. If that folder is there, the
    append is a repeat and changes nothing; a try that died half-way leaves no row behind.
    Without a version each call is an append of its own, and a retry of it doubles rows.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex if version is None else str(version)
    for part in (job, version):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", part):
            raise ValueError(f"letters, digits, '_', '.' and '-' only: {part!r}")
    target = f"{path}/{APPEND_JOB}={job}/{APPEND_VERSION}={version}"
    drafts = f"{path}/_drafts/{job}/{version}"
    if not files.exists(spark, target):
        draft = f"{drafts}/{uuid.uuid4().hex[:12]}"
        df.write.parquet(draft)
        files.move(spark, draft, target)
    files.remove(spark, drafts)  # also what earlier tries have left
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {APPEND_JOB} string, {APPEND_VERSION} string) "
              f"USING parquet PARTITIONED BY ({APPEND_JOB}, {APPEND_VERSION}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({APPEND_JOB} = '{job}', {APPEND_VERSION} = '{version}')")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def replace_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Point a table name at a folder, whatever it meant before; no data is touched."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()
