"""Overlapping word windows as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_count(
    n_words: Column, maxlen: int, overlap: int, full_split: bool = False, drop_empty: bool = False
) -> Column:
    """How many windows a text of ``n_words`` words gives: at least one, unless empty ones
    are not counted."""
    if not 0 <= overlap < maxlen:
        raise ValueError("need 0 <= overlap < maxlen")
    q = F.floor(n_words / F.lit(maxlen - overlap)).cast("int")
    if full_split:
        return F.ceil(n_words / F.lit(maxlen - overlap)).cast("int") if drop_empty else q + 1
    whole = F.greatest(q, F.lit(1))
    return F.when(n_words > 0, whole).otherwise(0) if drop_empty else whole


def chunk_words(words: Column, n_chunks: Column, maxlen: int, overlap: int) -> Column:
    """The windows themselves, each joined with blanks.

    ``words`` and ``n_chunks`` must be plain columns: an expression would be evaluated
    again for every window.
    """
    stride = maxlen - overlap
    return F.transform(
        F.sequence(F.lit(0), n_chunks - 1),
        lambda i: F.array_join(F.slice(words, i * stride + 1, F.lit(maxlen)), " "),
    )
