"""Hash keys that give the same value on every engine and every run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(c: Column) -> Column:
    """Cryptographic digest standing in for a long text in shuffles."""
    return F.sha2(c, 256)


def stable_bucket(buckets: int, *keys: Column | str, seed: int | str = 42) -> Column:
    """Bucket of a key in ``[0, buckets)``; depends on the key and the seed only."""
    parts = [k if isinstance(k, Column) else F.col(k) for k in keys]
    joined = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return (F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def split_name(bucket: Column, cuts: list[tuple[str, int]]) -> Column:
    """Name of the first cut whose upper bound exceeds the bucket."""
    return reduce(
        lambda acc, cut: F.when(bucket < cut[1], cut[0]).otherwise(acc),
        reversed(cuts[:-1]),
        F.lit(cuts[-1][0]),
    )
