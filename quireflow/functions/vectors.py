"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def argmax(scores: Column) -> Column:
    """Position of the largest value, the first one on ties (0-based)."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def with_softmax(df: DataFrame, scores: str, out: str) -> DataFrame:
    """Add class probabilities. Peak, exponentials and total each get their own step so
    that none is evaluated once per element."""
    return (
        df.withColumn("_peak", F.array_max(scores))
        .withColumn("_exp", F.transform(scores, lambda x: F.exp(x - F.col("_peak"))))
        .withColumn("_sum", array_total(F.col("_exp")))
        .withColumn(out, F.transform("_exp", lambda x: x / F.col("_sum")))
        .drop("_peak", "_exp", "_sum")
    )


def pad_sequence(seq: Column, length: Column, dim: int, fill: float) -> Column:
    """Extend a list of vectors to ``length`` with vectors of ``fill``."""
    blank = F.array_repeat(F.lit(fill).cast("float"), dim)
    return F.concat(seq, F.array_repeat(blank, length - F.size(seq)))
