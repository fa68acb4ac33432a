"""Operator 9: URL filters by a temporal list join.

List entries are dated: an entry lists or delists a host (or a domain above it) from a date
on. The entries of a host become validity intervals, and each capture is judged by the entry
that was active for its host, or the nearest domain above, at fetch time.

The as-of join lays entries and captures in one order (name, time) and carries the last entry
forward. The order comes from a range-partitioned sort, so a host with any share of the
captures or entries is cut over many tasks; what was active where a cut falls is carried over
by one row per partition and name. No pairs are formed.

Defined cases: a null or unreadable URL has the empty host and is never listed; a null fetch
time comes before every entry; of entries with one name and time the greatest ``action`` and
``category`` holds; an entry at the very fetch time counts; entries with a null name or time
are ignored; empty tables on either side are fine. A capture's other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import lower_ascii, stored

BLOCK, ALLOW = "block", "allow"


def host(url: Column) -> Column:
    """Host in lower case, without user, port and a leading ``www.``; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.regexp_replace(lower_ascii(found), r"^www\.", "")


def names_above(name: Column) -> Column:
    """The host and all domains above it of two labels or more, the longest first."""
    labels = F.split(name, r"\.")
    return F.when(name == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def intervals(entries: DataFrame) -> DataFrame:
    """``name, action, category, valid_from, valid_to`` (end exclusive; null: still valid) from
    dated entries ``name, action, category, listed_at`` and, if there is such a column,
    ``delisted_at``: an entry is valid until the name's next one or its own end, if that comes
    first. An end at or before the beginning makes it valid at no time."""
    if "delisted_at" not in entries.columns:
        entries = entries.withColumn("delisted_at", F.lit(None))
    end = F.col("delisted_at").cast(entries.schema["listed_at"].dataType)
    one = entries.filter(F.col("name").isNotNull() & F.col("listed_at").isNotNull()).groupBy("name", "listed_at").agg(
        F.max(F.struct("action", "category", end.alias("end"))).alias("__e"))
    after = Window.partitionBy("name").orderBy("listed_at")
    return one.select("name", "__e.action", "__e.category", F.col("listed_at").alias("valid_from"),
                      F.least(F.lead("listed_at").over(after), F.col("__e.end")).alias("valid_to"))


def active_at(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures ``__name, __time, …`` plus ``__entry`` (struct action, category, valid_from):
    the entry whose interval holds the time, or null.

    Beginnings and ends of intervals stand in one sort with the captures, and the last one
    before a capture says what holds: an as-of join that cuts through a hot name. Where one
    interval ends and the next begins, the end comes first."""
    spans = intervals(entries)
    held = F.struct("action", "category", "valid_from", F.lit(True).alias("open"))
    begun = spans.select(F.col("name").alias("__name"), F.col("valid_from").alias("__time"), held.alias("__entry"),
                         F.lit(1).alias("__kind"))
    shut = F.struct("action", "category", "valid_from", F.lit(False).alias("open"))
    ended = spans.where("valid_to IS NOT NULL").select(
        F.col("name").alias("__name"), F.greatest("valid_from", "valid_to").alias("__time"), shut.alias("__entry"),
        F.when(F.col("valid_to") > F.col("valid_from"), 0).otherwise(2).alias("__kind"))
    both = begun.unionByName(ended).unionByName(captures.withColumn("__kind", F.lit(3)), allowMissingColumns=True)
    order = [F.col("__name"), F.col("__time"), F.col("__kind")]
    rows = stored(both.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("__part", F.spark_partition_id())
                  .withColumn("__at", F.monotonically_increasing_id()), "asof")
    last = F.max_by("__entry", F.when(F.col("__kind") < 3, F.col("__at")))
    ends = rows.groupBy("__name", "__part").agg(last.alias("__last"))
    earlier = Window.partitionBy("__name").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("__name", "__part", F.last("__last", ignorenulls=True).over(earlier).alias("__start"))
    so_far = Window.partitionBy("__name", "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("__seen", F.last("__entry", ignorenulls=True).over(so_far)).filter("__kind = 3")
    found = F.coalesce("__seen", "__start")
    return (
        filled.join(starts, ["__name", "__part"], "left")
        .withColumn("__entry", F.when(found["open"], found.dropFields("open")))
        .drop("__part", "__at", "__kind", "__seen", "__start")
    )


def judge(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url",
          fetched: str = "fetched_at") -> DataFrame:
    """``key, host, fetched_at, listed_name, action, category, valid_from, blocked`` for
    every row of ``captures``; rows that repeat give rows that repeat."""
    slim = captures.select(F.col(key).alias("__id"), F.col(fetched).alias("__time"), host(F.col(url)).alias("__host"))
    # The same answer holds for equal (host, time), so each is looked up once.
    asked = slim.select("__host", "__time").distinct()
    names = asked.select("__host", F.col("__time"), F.posexplode(names_above(F.col("__host"))).alias("__depth", "__name"))
    known = active_at(names, entries).filter("__entry IS NOT NULL").groupBy("__host", "__time").agg(
        F.min(F.struct("__depth", "__name", "__entry")).alias("__best"))
    joined = slim.join(known, (slim["__host"] == known["__host"]) & (slim["__time"] == known["__time"]), "left")
    return joined.select(
        slim["__id"].alias(key), slim["__host"].alias("host"), slim["__time"].alias(fetched),
        F.col("__best.__name").alias("listed_name"), F.col("__best.__entry.action").alias("action"),
        F.col("__best.__entry.category").alias("category"), F.col("__best.__entry.valid_from").alias("valid_from"),
        F.coalesce(F.col("__best.__entry.action") == BLOCK, F.lit(False)).alias("blocked"),
    )
