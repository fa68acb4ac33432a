"""Small files and folders on whatever storage Spark reaches, published by a rename that never
overwrites: of several writers of one name exactly one succeeds."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _at(spark: SparkSession, path: str):
    where = _hadoop(spark).Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or a folder in one step; False, and nothing moved, if the target is there."""
    fs, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    files = _hadoop(spark)
    context = files.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_overwrite = spark.sparkContext._gateway.new_array(getattr(files.Options, "Rename"), 0)
    try:
        context.rename(files.Path(source), to, never_overwrite)
    except Py4JJavaError as failed:
        if "AlreadyExists" in failed.java_exception.getClass().getName() or (fs.exists(to) and exists(spark, source)):
            return False
        raise
    return True


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file whole or not at all; False if there is one of that name."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex[:12]}"
    fs, where = _at(spark, draft)
    stream = fs.create(where, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if move(spark, draft, path):
        return True
    remove(spark, draft)
    return False


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
