"""A one-hash Bloom filter as rows of bitmaps: built with map-side combine, merged by OR, and of
a size that is chosen and bounded before it is built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ITEM = 16          # about one false hit in sixteen rows that are not in it
LEAST_BITS, MOST_BITS = 15, 29  # powers of two: one bitmap of 4 KB, and 64 MB in all


def size_for(items: int) -> int:
    """Power-of-two number of bits for so many items. Beyond 2^29 bits (33 million items) it
    stays, and false hits become more frequent; they never change what is right."""
    return 1 << min(MOST_BITS, max(LEAST_BITS, (max(1, items) * BITS_PER_ITEM - 1).bit_length()))


def _position(code: Column, bits: int) -> Column:
    return F.pmod(code, F.lit(bits)) + 1  # bitmap functions count from 1


def build(items: DataFrame, code: str, bits: int) -> DataFrame:
    """``_bucket, _bitmap`` for the 64-bit hashes in column ``code``; no more than ``bits`` / 8
    bytes."""
    at = _position(F.col(code), bits)
    return items.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bitmap"))


def marked(df: DataFrame, code: Column, bitmaps: DataFrame, bits: int, name: str = "_hit") -> DataFrame:
    """``df`` plus ``name``: may the row's hash be among the items? False is certain.

    The bitmaps are broadcast; their size is bounded by ``bits``."""
    at = _position(code, bits)
    rows = df.withColumns({"_b": F.bitmap_bucket_number(at), "_p": F.bitmap_bit_position(at)})
    met = rows.join(F.broadcast(bitmaps), F.col("_b") == F.col("_bucket"), "left")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.col("_p") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (F.col("_p") % 8).cast("int")) == 1
    return met.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_b", "_p", "_bucket", "_bitmap")
