"""Fixed-length token encoding over a vocabulary table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.operators.ranking import global_index

# The four reserved ids.
PAD, UNKNOWN, BEGIN, END = 0, 1, 2, 3
FIRST_FREE = 4


def vocabulary(df: DataFrame, tokens: Column) -> DataFrame:
    """All tokens as ``(token, token_id, uses)``, the most frequent first, ties by token.

    The ids come from a distributed sort of the counts. Make it on training rows: tokens
    that only other rows have then encode as unknown.
    """
    counts = (
        df.select(F.explode_outer(tokens).alias("token")).where(F.col("token").isNotNull())
        .groupBy("token").agg(F.count("*").alias("uses"))
    )
    return global_index(counts, F.col("uses").desc(), F.col("token"), name="_i").select(
        "token", (F.col("_i") + FIRST_FREE).alias("token_id"), "uses"
    )


def encode(
    df: DataFrame, keys: Sequence[str], tokens: Column, vocab: DataFrame, max_len: int
) -> DataFrame:
    """``input_ids`` and ``attention_mask`` of exactly ``max_len`` entries per row.

    Begin and end marks count towards the length; longer texts are cut before the lookup,
    so at most ``max_len - 2`` tokens per row travel. ``keys`` must identify a row.

    No hint on the lookup: the measured size of the vocabulary decides between a broadcast
    and a shuffle.
    """
    room = max_len - 2
    if room < 0:
        raise ValueError("max_len must leave room for the two marks")
    looked_up = (
        df.select(*keys, F.posexplode_outer(F.slice(tokens, 1, room)).alias("_pos", "token"))
        .join(vocab.select("token", "token_id"), "token", "left")
    )
    found = F.when(
        F.col("token").isNotNull(),
        F.struct("_pos", F.coalesce("token_id", F.lit(UNKNOWN).cast("bigint")).alias("id")),
    )
    body = (
        looked_up.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(found)).alias("_body"))
        .withColumn("_ids", F.concat(
            F.array(F.lit(BEGIN).cast("bigint")), F.transform("_body", lambda s: s["id"]), F.array(F.lit(END).cast("bigint"))
        ))
    )
    gap = F.lit(max_len) - F.size("_ids")
    return body.select(
        *keys,
        F.concat("_ids", F.array_repeat(F.lit(PAD).cast("bigint"), gap)).alias("input_ids"),
        F.concat(
            F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), gap)
        ).alias("attention_mask"),
    )
