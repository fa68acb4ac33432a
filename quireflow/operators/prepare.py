"""Bronze, Silver and Gold: dedup, clean, chunk."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.functions import bitmaps, chunks, hashing, text
from quireflow.operators.ranking import running_total
from quireflow.session import stored


def bronze(pages: DataFrame, order: Sequence[str] = ("dcn", "page")) -> DataFrame:
    """Pages with text, one per ``(text, label)``; the first in ``order`` survives.

    One pass groups digests and keys, with map-side combine. The groups that hold more than one
    page are stored as a table of repeats and, by a hash, put into a bitmap filter of bounded
    size. The second pass asks the filter about each page: pages that are not in it have no
    copy and come out at once, their texts never digested again nor shuffled, however many
    copies there are of others. Only the rest is joined to the repeats.

    Pages that agree in text, label and ``order`` cannot be told apart and are copies: of
    these any one is kept.
    """
    order = list(order)
    kept = pages.where(F.col("text").isNotNull())
    digests = kept.select(hashing.text_key(F.col("text")).alias("_digest"), _page_code().alias("_code"), "label", *order)
    alike = digests.groupBy("_digest", "label", *order).agg(F.count("*").alias("_same"), F.min("_code").alias("_code"))
    repeats = stored(
        alike.groupBy(F.col("_digest").alias("_d"), F.col("label").alias("_l")).agg(
            F.min(F.struct(*order, "_same")).alias("_first"), F.sum("_same").alias("_n"), F.min("_code").alias("_c"))
        .where("_n > 1").drop("_n"), "repeats",
    )
    found = repeats.agg(F.count("*").alias("n"), F.max("_first._same").alias("same")).first()
    if not found.n:
        return kept
    bits = bitmaps.size_for(found.n)
    asked = bitmaps.marked(kept, _page_code(), bitmaps.build(repeats, "_c", bits), bits)
    single = asked.where("NOT _hit").select(*pages.columns)

    suspects = asked.where("_hit").withColumn("_digest", hashing.text_key(F.col("text")))
    group = (F.col("_digest") == F.col("_d")) & F.col("label").eqNullSafe(F.col("_l"))
    met = suspects.join(repeats, group, "left")
    is_first = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_first.{c}")) for c in order])
    chosen = met.where(F.col("_d").isNull() | (is_first & (F.col("_first._same") == 1)))
    single = single.unionByName(chosen.select(*pages.columns))
    if found.same > 1:  # pages that repeat whole: any one of them
        tied = met.where(is_first & (F.col("_first._same") > 1)).dropDuplicates(["_digest", "label"])
        single = single.unionByName(tied.select(*pages.columns))
    return single


def _page_code() -> Column:
    return F.xxhash64("text", "label")


def silver(
    bronze_pages: DataFrame,
    paragraphs: str = "all",
    noise_phrases: Sequence[str] = (),
    stop_words: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cleaned pages ``(dcn, page, text_processed, label)``; a row-local projection. The
    compatible result, which keeps a page's last paragraph only, is ``paragraphs="last"``."""
    cleaned = text.clean_training(F.col("text"), paragraphs, noise_phrases, stop_words)
    return bronze_pages.select(
        "dcn", "page", cleaned.alias("text_processed"), "label", *keep
    )


def with_chunks(
    df: DataFrame,
    source: str,
    maxlen: int = 512,
    overlap: int = 50,
    full_split: bool = True,
    drop_empty: bool = False,
    out: str = "chunks",
) -> DataFrame:
    """Add the array of overlapping word windows of ``source``."""
    df = df.withColumn("_words", text.words(F.col(source))).withColumn(
        "_n", chunks.chunk_count(F.size("_words"), maxlen, overlap, full_split)
    )
    made = chunks.chunk_words(F.col("_words"), F.col("_n"), maxlen, overlap)
    if drop_empty:
        made = F.filter(made, lambda c: c != "")
    return df.withColumn(out, made).drop("_words", "_n")


def gold(
    silver_pages: DataFrame,
    maxlen: int = 200,
    overlap: int = 50,
    full_split: bool = True,
    drop_empty: bool = False,
) -> DataFrame:
    """One row per chunk, ``index`` counting from 1 within the page. The compatible result,
    which leaves off the last words of a page, is ``full_split=False``.

    For tables where ``(dcn, page)`` identifies a row the position inside the array is
    the index, so no shuffle is needed. See ``gold_shared`` for the other case.
    """
    # The outer form keeps the optimizer from repeating the array expression in a filter.
    return (
        with_chunks(silver_pages, "text_processed", maxlen, overlap, full_split, drop_empty)
        .select("dcn", "page", "label", F.posexplode_outer("chunks").alias("_pos", "text_chunk"))
        .where(F.col("_pos").isNotNull())
        .select("dcn", "page", "text_chunk", (F.col("_pos") + 1).alias("index"), "label")
    )


def gold_shared(
    silver_pages: DataFrame,
    row_id: str,
    maxlen: int = 200,
    overlap: int = 50,
    full_split: bool = True,
    drop_empty: bool = False,
) -> DataFrame:
    """Chunks numbered through when several rows share one ``(dcn, page)``.

    Rows of a page follow each other by ``row_id``, which must tell them apart. Each row's
    first number comes from a running total of chunk counts over a range-partitioned sort,
    which cuts through a page of any size. Only keys and counts are sorted; the numbers are
    joined to the texts once. Give it a stored table: it is read twice.
    """
    keys = ["dcn", "page"]
    made = chunks.chunk_count(
        F.size(text.words(F.col("text_processed"))), maxlen, overlap, full_split, drop_empty)
    counts = silver_pages.select(*keys, row_id, made.alias("_made"))
    starts = running_total(counts, keys, [row_id], "_made", "_start").select(
        *[F.col(k).alias(f"_k_{k}") for k in (*keys, row_id)], "_start")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in (*keys, row_id)])
    joined = silver_pages.join(starts, same)
    return (
        with_chunks(joined, "text_processed", maxlen, overlap, full_split, drop_empty)
        .select("dcn", "page", row_id, "label", "_start",
                F.posexplode_outer("chunks").alias("_pos", "text_chunk"))
        .where(F.col("_pos").isNotNull())
        .select("dcn", "page", "text_chunk", (F.col("_start") + F.col("_pos") + 1).alias("index"),
                "label", row_id)
    )


def chunk_stats(gold_chunks: DataFrame, *by: Column | str) -> DataFrame:
    """Chunks, pages and words per group; pages are counted by their first chunk."""
    return gold_chunks.groupBy(*by).agg(
        F.count("*").alias("chunks"),
        F.sum((F.col("index") == 1).cast("bigint")).alias("pages"),
        F.sum(F.size(text.words(F.col("text_chunk"))).cast("bigint")).alias("words"),
    )


def drop_stray_headers(df: DataFrame, column: str = "Request") -> DataFrame:
    """Remove rows that repeat the header. Null values go too, as in SQL's ``!=``."""
    return df.where(F.col(column) != column)


def spread(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Even out partitions: by size at run time, or to a fixed number when one is given."""
    if partitions:
        return df.repartition(partitions, *keys)
    return df.hint("rebalance", *keys)
