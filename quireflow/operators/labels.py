"""Class ids: by frequency, attached by dictionary, decoded again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.operators.ranking import global_index


def label_index(df: DataFrame, label: str = "label") -> DataFrame:
    """Dictionary ``(label, label_id, rows)``: most frequent first, ties by name.

    Numbered by a distributed sort, so there may be any number of classes.
    """
    counts = (
        df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label"))
        .agg(F.count("*").alias("rows"))
    )
    return global_index(counts, F.col("rows").desc(), F.col("label"), name="_i").select(
        "label", F.col("_i").cast("int").alias("label_id"), "rows"
    )


def attach_label_id(
    df: DataFrame, dictionary: DataFrame, label: str = "label", out: str = "label_id"
) -> DataFrame:
    """Replace the label by its id; rows with null or unseen labels drop out.

    No hint: the dictionary's measured size decides between a broadcast and a shuffle, and
    run-time skew handling splits a hot label.
    """
    side = dictionary.select(F.col("label").alias("_name"), F.col("label_id").alias(out))
    return df.join(side, F.col(label) == F.col("_name")).drop("_name", label)


def decode_label(df: DataFrame, dictionary: DataFrame, ids: str, out: str) -> DataFrame:
    """Names for ids, taken from the very dictionary that made them."""
    side = dictionary.select(F.col("label").alias(out), F.col("label_id").alias("_id"))
    return df.join(side, F.col(ids) == F.col("_id"), "left").drop("_id")


def class_count(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.countDistinct(label).alias("classes"))
