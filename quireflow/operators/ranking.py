"""Total row numbers without pulling everything into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.session import stored

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition number in 33 bits


def global_index(df: DataFrame, *order: Column | str, name: str = "idx") -> DataFrame:
    """0-based position of each row in the total order given.

    One range-partitioned sort; then every row adds its place inside its partition to the
    rows before that partition. ``order`` must be total (end it with a unique key), which
    also lets the range partitioning cut through hot leading values. The sorted rows are
    stored because the numbers depend on where the partitions were cut.
    """
    ranked = stored(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    ranked = ranked.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    # One row per partition: the only thing that is numbered in a single task.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_pid").agg(F.count("*").alias("_rows"))
        .select("_pid", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ranked.join(offsets, "_pid")
        .withColumn(name, F.col("_start") + local)
        .drop("_mid", "_pid", "_start")
    )


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], value: str, name: str
) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, in the order given.

    The sort is cut into partitions wherever it is even, also within a group; each row adds
    the sum inside its partition and that of its group's earlier partitions.
    """
    group = list(group)
    ranked = stored(
        df.orderBy(*group, *order).withColumn("_mid", F.monotonically_increasing_id()), "totals",
    ).withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    within = Window.partitionBy("_pid", *group).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ranked.groupBy("_pid", *group).agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .select(F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in group], "_base")
    )
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group], F.col("_pid") == F.col("_p"))
    return (
        ranked.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(parts, same).withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_mid", "_pid", "_p", "_local", "_base", *[f"_g_{g}" for g in group])
    )
