"""Packed exchanges: documents in shards, and questions about keys in one row per shard and bucket.

Counting every n-gram or window of a corpus one row each would move and sort billions of tiny
rows. Here a task hashes its shard's items with numpy, sorts them once, and sends each bucket
of the key space one row with the keys it has there. Spark shuffles these rows by bucket; a
bucket answers each of its rows with one value per key; the answers go back by shard.

A bucket holds a bounded number of keys, as the number of buckets follows the corpus, and a
key occurs once in a shard's row however hot it is. Losing an executor repeats tasks only:
shards and answers are stored before they are read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.session import fresh_dir

SHARD_BYTES = 8 << 20
REQUEST = "bucket int, shard long, keys binary, extra binary"
U64 = np.uint64


# Arrays as bytes

def squeeze(values: np.ndarray) -> bytes:
    """Non-negative integers, as narrow as their maximum, compressed."""
    values = np.ascontiguousarray(values)
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    raw = values.astype(f"<u{width}").tobytes()
    return bytes([width]) + len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unsqueeze(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[1:9], "little")
    raw = pa.decompress(blob[9:], size, "zstd", asbytes=True) if size else b""
    return np.frombuffer(raw, f"<u{blob[0]}")


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Ascending uint64 as differences, byte plane by byte plane."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=U64(0)).astype("<u8")
    first, steps[0] = steps[0], 0
    planes = steps.view(np.uint8).reshape(-1, 8)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(planes[:, :width].T).tobytes()
    return int(first).to_bytes(8, "little") + bytes([width]) + len(keys).to_bytes(8, "little") + pa.compress(
        raw, "zstd", asbytes=True)


def unsqueeze_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, U64)
    width, n = blob[8], int.from_bytes(blob[9:17], "little")
    raw = np.frombuffer(pa.decompress(blob[17:], width * n, "zstd", asbytes=True), np.uint8).reshape(width, n)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = raw.T
    steps = steps.view("<u8").ravel()
    steps[0] = int.from_bytes(blob[:8], "little")
    return np.cumsum(steps, dtype=U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


# Words

def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in a row, and how many each text has; null has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts.slice(0, 0), texts])  # a copy: ascii_lower misreads slices
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = parts.flatten()
    real = pc.not_equal(words, "")
    ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), np.diff(kept[ends])


def hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of each word among the distinct ones, and their 64-bit hashes."""
    coded = words.dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return coded.indices.to_numpy(), np.fromiter(map(xxhash.xxh3_64_intdigest, names), U64, len(names))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SHARD_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))
        start = 0
        while start < len(ends):
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


# Shards

def _bucketed(df: DataFrame, buckets: int, name: str) -> DataFrame:
    """``df`` stored as a table bucketed by shard: joins by shard of two such tables move
    nothing."""
    path = fresh_dir(df.sparkSession, name)
    table = f"{name}_{path.rsplit('-', 1)[1]}"
    df.write.bucketBy(buckets, "shard").option("path", path).option("compression", "zstd").saveAsTable(table)
    return df.sparkSession.table(table)


def buckets_of(spark: SparkSession) -> int:
    """Buckets of the stored shards and answers."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES, text: str = "text", by: str | None = None) -> DataFrame:
    """``docs`` stored as rows ``shard, size, part, rows`` of about ``shard_bytes`` of text.

    With ``by``, an integer column of few values, the documents of a shard agree in it and
    ``part`` is its value.
    """
    inner = docs.schema
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("size", T.LongType()),
                           T.StructField("part", T.IntegerType()), T.StructField("rows", T.ArrayType(inner))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 33, 0
        held: dict[int | None, list[pa.RecordBatch]] = {}
        size: dict[int | None, int] = {}

        def one(part: int | None) -> pa.RecordBatch:
            table = pa.Table.from_batches(held.pop(part)).combine_chunks()
            fields = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
            rows = pa.StructArray.from_arrays(fields, fields=list(table.schema))
            return pa.RecordBatch.from_arrays(
                [pa.array([base + count], pa.int64()), pa.array([size.pop(part)], pa.int64()), pa.array([part], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=["shard", "size", "part", "rows"])

        for piece in slices(batches, shard_bytes, text):
            parts = [None] if by is None else pc.unique(piece.column(by)).to_pylist()
            for part in parts:
                mine = piece if by is None else piece.filter(pc.equal(piece.column(by), part))
                held.setdefault(part, []).append(mine)
                size[part] = size.get(part, 0) + (pc.sum(pc.binary_length(mine.column(text))).as_py() or 0)
                if size[part] >= shard_bytes // 2:
                    yield one(part)
                    count += 1
        for part in list(held):
            yield one(part)
            count += 1

    return _bucketed(docs.mapInArrow(cut, schema), buckets_of(docs.sparkSession), "shards")


def open_shard(batch: pa.RecordBatch, i: int) -> pa.StructArray:
    return batch.column("rows")[i].values


# Questions and answers

def by_bucket(keys: np.ndarray, bits: int, first: int = 0) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted 64-bit keys by their top ``bits`` bits, as slices."""
    if bits == 0:
        yield first, slice(0, len(keys))
        return
    tops = (keys >> U64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(tops, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        yield first + int(tops[a]), slice(int(a), int(b))


def request_batch(shard: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int32()), pa.array([shard] * len(rows), pa.int64()),
        pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
    ], names=["bucket", "shard", "keys", "extra"])


def ask(requests: DataFrame, answer: Callable[[int, list[bytes], list[bytes]], list[bytes]],
        name: str) -> DataFrame:
    """``shard, answers array<struct<bucket,reply>>`` (sorted by bucket), stored beside the
    shards.

    ``answer(bucket, keys, extras)`` gets all rows of a bucket and returns a reply for each; a
    reply more is the bucket's own, filed under shard ``-1 - bucket``.
    """
    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        replies = answer(bucket, table["keys"].to_pylist(), table["extra"].to_pylist())
        owners = table["shard"].to_pylist() + [-1 - bucket] * (len(replies) - len(table))
        return pa.table({"bucket": pa.array([bucket] * len(replies), pa.int32()),
                         "shard": pa.array(owners, pa.int64()), "reply": pa.array(replies, pa.binary())})

    replies = requests.groupBy("bucket").applyInArrow(run, "bucket int, shard long, reply binary")
    return _bucketed(replies.groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "reply"))).alias("answers")), buckets_of(requests.sparkSession), name)


def replies_of(batch: pa.RecordBatch, column: str, i: int) -> list[tuple[int, bytes]]:
    return [(r["bucket"], r["reply"]) for r in batch.column(column)[i].as_py() or []]


def bits_for(items: float, each: int) -> int:
    """Bits of a power-of-two number of buckets with about ``each`` items."""
    return max(0, int(np.ceil(np.log2(max(1.0, items / each)))))
