"""Reproducible train / validation / test splits on the page key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quireflow.functions import hashing

CUTS_90_5_5 = [("train", 900), ("val", 950), ("test", 1000)]
CUTS_60_20_20 = [("train", 600), ("val", 800), ("test", 1000)]


def with_split(
    df: DataFrame, *keys: str, cuts=CUTS_90_5_5, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Name the split each row belongs to, in thousandths of the key's hash range.

    Row-local. All rows of a key get the same split, so the chunks of a page never leak
    from training into test, and a page stays where it was when the table grows.
    """
    bucket = hashing.stable_bucket(1000, *keys, seed=seed)
    return df.withColumn(out, hashing.split_name(bucket, list(cuts)))
