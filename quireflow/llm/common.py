"""What several of the text operators share: word patterns, stored tables, row numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireflow.session import stored  # noqa: F401 - shared by the operators

#: A word is a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition number in 33 bits


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: Column | str = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z; other letters stay as they are."""
    return F.translate(column, UPPER, LOWER)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(text_or_empty(F.col(column).cast("string")).cast("binary")) % modulus


def unit(*parts: Column | str) -> Column:
    """A reproducible number in [0, 1), a multiple of 2^-20, from the md5 of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def numbered(df: DataFrame, order: list[Column], group: str | None = None,
             name: str = "__rank") -> DataFrame:
    """0-based position of each row within its group, in the order given.

    One range-partitioned sort on ``order`` (which must start with what makes the groups), so
    a group of any size is cut over many tasks; its position is the place inside the
    partition plus the rows of the group in earlier partitions. Rows that tie in ``order``
    get different numbers in no particular order, so let them differ or be alike. Only one
    row for each partition and group meets in the window over a group. These rows are stored,
    too: their measured size decides how they are joined, so a few of them are broadcast and
    the sorted rows are not exchanged a second time. A null group counts as a group.
    """
    key = F.lit("") if group is None else F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("~"))
    rows = stored(
        df.withColumn("__key", key.cast("string")).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id()), "numbered",
    )
    part = F.shiftright(F.col("__at"), _LOCAL_BITS)
    before = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(
        rows.groupBy(part.alias("__part"), "__key")
        .agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n"), "runs",
    )
    return (
        rows.withColumn("__part", part).join(runs, ["__part", "__key"])
        .withColumn(name, F.col("__before") + F.col("__at") - F.col("__first"))
        .drop("__part", "__key", "__at", "__first", "__before")
    )


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` renamed, so that no name clashes with those an
    operator works with, and the function that names them back. Columns that the operator has
    added come last; where one has the name of a column of ``docs``, it replaces that column."""
    names = {c: c if c in used else f"__in_{i}" for i, c in enumerate(docs.columns)}
    held = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])

    def back(df: DataFrame) -> DataFrame:
        added = [c for c in df.columns if c not in names.values()]
        kept = [F.col(n).alias(c) for c, n in names.items() if c not in added and n in df.columns]
        return df.select(*kept, *added)

    return held, back


def text_digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
