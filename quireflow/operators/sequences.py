"""Per-page sequences of chunk values: stacking, padding, pooling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.functions import vectors
from quireflow.operators.ranking import global_index

SEGMENT = 4096


def stack(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str = "emb",
    segment: int = SEGMENT,
) -> DataFrame:
    """Chunk values of a page as one list in chunk order.

    ``order`` counts from 1. A page of up to ``segment`` chunks gives one row with
    ``segment = 0``; a longer one gives one row per ``segment`` chunks, so a row and the
    group behind it never outgrow a task. Nothing is dropped: the segments of a page, in
    order, are its sequence.
    """
    piece = F.floor((F.col(order) - 1) / segment).cast("int").alias("segment")
    item = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    return (
        df.groupBy(*keys, piece)
        .agg(F.sort_array(F.collect_list(item)).alias("_items"))
        .select(*keys, "segment", F.transform("_items", lambda s: s["v"]).alias(out))
    )


def pad_batches(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    dim: int,
    batch_size: int,
    fill: float = -99.0,
) -> DataFrame:
    """Cut the rows, ordered by ``keys``, into batches and pad each to its longest sequence.

    Every row is kept, also those of a last, smaller batch. Adds ``batch_id``,
    ``timesteps`` (the padded length), ``steps`` (the real one) and ``padded``. The keys must
    identify a row: only they and the lengths are numbered, and the sequences are joined to
    the result once. Give it a stored table: it is read twice.
    """
    numbered = global_index(df.select(*keys, F.size(seq).alias("steps")), *keys, name="_i").withColumn(
        "batch_id", F.floor(F.col("_i") / batch_size).cast("bigint")
    )
    longest = numbered.groupBy("batch_id").agg(F.max("steps").alias("timesteps"))
    placed = numbered.join(longest, "batch_id").drop("_i")
    return df.join(placed, list(keys)).withColumn(
        "padded", vectors.pad_sequence(F.col(seq), F.col("timesteps"), dim, fill))


def pool(df: DataFrame, keys: Sequence[str], value: str, order: str | None = None) -> DataFrame:
    """Mean and maximum per dimension (and the first vector, given an order) per group.

    Summaries combine before the exchange, so a hot group costs one buffer per task.
    """
    summary = Summarizer.metrics("mean", "max", "count").summary(array_to_vector(value))
    aggs = [summary.alias("_s")]
    if order:
        aggs.append(F.min_by(value, order).alias("first"))
    kept = ["first"] if order else []
    return df.groupBy(*keys).agg(*aggs).select(
        *keys,
        vector_to_array("_s.mean").alias("mean"),
        vector_to_array("_s.max").alias("max"),
        *kept,
        F.col("_s.count").alias("vectors"),
    )
