"""Operator 1: mixing sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, its source's target over
its source's size. The expected copies are summed up along the source, one offset is added,
and a document is taken once for every integer its sum crosses. Documents stand in order of
size, which makes every stretch of sizes get its share, so that the words taken miss the
target by about one large document at most.

DataFrame functions only. The sums need no more than a document's place within its source,
and the places come from a range-partitioned sort that cuts through a hot source.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
rows that repeat are rows like others; a source of size 0 has the target 0 and none of its
documents is taken; an empty table gives an empty mix. Columns beside ``doc_id``, ``text``
and ``source`` are carried along by ``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import WORD, numbered, stored, text_or_empty, unit

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = "mix"


def word_count(text: Column | str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """``source, source_size, target`` for one row ``source, source_size`` per source.

    The weights repeat over the sources by code point, null last. Every source gets its
    share of the total; one whose share is above ``ceiling`` sizes gets that, and the rest
    is shared anew by weight, until no share is above. Each pass is one sum over the sources.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    rows = stored(ranked.select("source", "source_size", weight.alias("__weight"),
                                (F.col("source_size") * ceiling).alias("__cap")), "targets")
    capped, count, share = F.lit(False), -1, 0.0
    while True:
        now = rows.agg(
            F.sum("source_size").alias("total"), F.sum("__weight").alias("weight"),
            F.sum(F.when(capped, F.col("__cap"))).alias("fixed"),
            F.sum(F.when(capped, F.col("__weight"))).alias("spent"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        if now.n == count or not now.total or now.weight == (now.spent or 0):
            break
        count = now.n
        share = (now.total - (now.fixed or 0)) / (now.weight - (now.spent or 0))
        capped = F.col("__cap") < F.col("__weight") * F.lit(share)
    target = F.when(capped, F.col("__cap").cast("double")).otherwise(F.col("__weight") * F.lit(share))
    return rows.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING,
           seed: str = SEED) -> DataFrame:
    """``docs`` (with a column ``size``) plus ``source_size, target, copies``."""
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("~"))
    goal = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ceiling)
    goal = goal.withColumn("__source", key).withColumn(
        "__each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ).withColumn("__offset", unit(F.lit(seed), "__source")).drop("source")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    rows = numbered(docs.drop("source_size", "target", "copies"), order, "source")
    reached = F.floor(F.col("__rank") * F.col("__each") + F.col("__offset"))
    crossed = F.floor((F.col("__rank") + 1) * F.col("__each") + F.col("__offset")) - reached
    return (
        rows.withColumn("__source", key).join(goal, "__source")
        .withColumn("copies", F.least(crossed, F.lit(ceiling)))
        .drop("__source", "__each", "__offset", "__rank")
    )


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING,
         seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``: the mix without its texts."""
    slim = stored(docs.select("doc_id", F.col("source").cast("string"), word_count().alias("size")), "sizes")
    return copies(slim, weights, ceiling, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies"
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING,
        seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; the columns stay as they are."""
    names = docs.columns
    held = docs.select(*[F.col(c).alias(f"__in_{c}") for c in names],
                       "doc_id", F.col("source").cast("string").alias("source"),
                       word_count().alias("size"))
    taken = copies(held, weights, ceiling, seed).filter("copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col(f"__in_{c}").alias(c) for c in names]
    )
