"""Operator 10: substring dedup with a count-min prefilter and an exact second pass.

Every window of 13 words is hashed. Each shard adds its windows to partial count-min
sketches; the parts of a cell range meet in one task, which adds them up and tells each shard
which of its cells reach two. The sketch never undercounts, so a window that any two places
share is always kept for the second pass, and most others drop out. The second pass groups
exactly the windows that are left, by 96 bits of two independent hashes, and finds the
smallest ``doc_id`` of each. A word goes if a window over it occurs in a smaller document.

The width of the sketch follows the number of windows, and a task holds one range of cells.

Defined cases: a null text has no words; a text of fewer than 13 words loses nothing; a null
``doc_id`` is greater than all others and equal to itself; rows of equal ``doc_id`` do not
take words from each other, while both lose them to a smaller one; repeats within one
document stay; an empty table gives an empty result. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.llm import packed
from quireflow.llm.common import set_aside

WINDOW = 13
DEPTH = 2
CELL_BITS = 21          # cells of the sketch that one task adds up
KEYS_PER_BUCKET = 4_000_000
U64 = np.uint64
_BASE1, _BASE2 = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
_ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # one per row of the sketch
_NO_ID = np.iinfo(np.int64).max


class _Shard:
    """The windows of one shard, in order of place."""

    def __init__(self, rows: pa.StructArray, window: int):
        self.rows = rows
        self.words, self.lengths = packed.words_of(rows.field("text"))
        indices, names = packed.hashed(self.words)
        tokens = names[indices]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        left = np.repeat(self.starts[1:], self.lengths) - np.arange(len(tokens))
        self.at = np.flatnonzero(left >= window)     # places where a window starts
        n = max(0, len(tokens) - window + 1)
        one, two, other = np.zeros(n, U64), np.zeros(n, U64), packed.mix64(tokens + _BASE2)
        for j in range(window):
            one = one * _BASE1 + tokens[j:j + n]
            two = two * _BASE2 + other[j:j + n]
        self.one = packed.mix64(one[self.at])
        self.two = (packed.mix64(two[self.at]) >> U64(32)).astype(np.uint32)
        ids = pc.fill_null(rows.field("doc_id").cast(pa.int64()), _NO_ID).to_numpy()
        self.ids = np.repeat(ids, self.lengths)[self.at]

    def cells(self, row: int, bits: int) -> np.ndarray:
        """Cell of each window in one row of the sketch, in the upper bits."""
        spread = packed.mix64(self.one ^ U64(_ROWS[row]))
        return spread & ~U64((1 << (64 - bits)) - 1)

    def repeated(self, replies: list[tuple[int, bytes]], bits: int) -> np.ndarray:
        """Numbers of the windows whose estimate reaches two."""
        alive = np.arange(len(self.one))
        by_row = 1 << _range_bits(bits)
        for row in range(DEPTH):
            flags = [np.unpackbits(np.frombuffer(r[8:], np.uint8), count=int.from_bytes(r[:8], "little"))
                     for b, r in replies if b // by_row == row]
            if not flags or not len(alive):
                return alive[:0]
            flags, cells = np.concatenate(flags).astype(bool), self.cells(row, bits)
            if row == 0:  # all windows: follow their order instead of looking each one up
                order = np.argsort(cells)
                cells = cells[order]
                new = np.ones(len(cells), bool)
                new[1:] = cells[1:] != cells[:-1]
                alive = np.sort(order[flags[np.cumsum(new) - 1]])
            else:
                hot, mine = np.unique(cells)[flags], cells[alive]
                if not len(hot):
                    return alive[:0]
                order = np.argsort(mine)
                spot = np.minimum(np.searchsorted(hot, mine[order]), len(hot) - 1)
                alive = np.sort(alive[order[hot[spot] == mine[order]]])
        return alive

    def keys(self, alive: np.ndarray):
        """Distinct window keys with the shard's smallest id, and each window's key number."""
        return _grouped(self.one[alive], self.two[alive], self.ids[alive])


def _grouped(one: np.ndarray, two: np.ndarray, ids: np.ndarray):
    """Distinct pairs in order, the smallest id of each, and each item's pair number."""
    order = np.argsort(one)
    a, b = one[order], two[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    if (b[1:] != b[:-1])[~new[1:]].any():  # one hash shared by two windows: order by both
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new)) if len(a) else ids
    return a[new], b[new], least, number


def _range_bits(bits: int) -> int:
    return max(0, bits - CELL_BITS)


def _sketch_requests(window: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                data = _Shard(packed.open_shard(batch, i), window)
                rows = []
                for row in range(DEPTH):
                    cells, counts = np.unique(data.cells(row, bits), return_counts=True)
                    counts = np.minimum(counts, 255)
                    for bucket, part in packed.by_bucket(cells, _range_bits(bits), row << _range_bits(bits)):
                        if part.stop > part.start:
                            rows.append((bucket, packed.squeeze_sorted(cells[part] >> U64(64 - bits)),
                                         packed.squeeze(counts[part])))
                yield packed.request_batch(shard, rows)
    return run


def _merge_sketches(bucket: int, keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    cells = [(packed.unsqueeze_sorted(k) & U64((1 << CELL_BITS) - 1)).astype(np.int64) for k in keys]
    total = np.zeros(1 << CELL_BITS, np.uint32)
    for mine, extra in zip(cells, extras):
        total[mine] += packed.unsqueeze(extra)  # a shard names a cell once
    return [len(c).to_bytes(8, "little") + np.packbits(total[c] >= 2).tobytes() for c in cells]


def _exact_requests(window: int, bits: int, key_bits: int):
    """Requests of the windows left, and one row for the shard itself: where these windows
    are and which key each one has, so that the last pass need not work it out again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                data = _Shard(packed.open_shard(batch, i), window)
                alive = data.repeated(packed.replies_of(batch, "flags", i), bits)
                one, two, ids, number = data.keys(alive)
                own = [(_own_bucket(shard), packed.squeeze_sorted(data.at[alive].astype(U64)), packed.squeeze(number))]
                yield packed.request_batch(shard, own * bool(len(alive)) + [
                    (bucket, packed.squeeze_sorted(one[part]), _with_ids(two[part], ids[part]))
                    for bucket, part in packed.by_bucket(one, key_bits) if part.stop > part.start])
    return run


def _own_bucket(shard: int) -> int:
    """A bucket below 0, of few shards each."""
    return -1 - (shard * 0x9E3779B1 >> 7) % (1 << 30)


def _with_ids(two: np.ndarray, ids: np.ndarray) -> bytes:
    low = int(ids.min())
    packed_ids = packed.squeeze(ids.view(U64) - U64(low & (2**64 - 1)))
    return low.to_bytes(8, "little", signed=True) + len(two).to_bytes(8, "little") + two.tobytes() + packed_ids


def _ids_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, n = int.from_bytes(blob[:8], "little", signed=True), int.from_bytes(blob[8:16], "little")
    two = np.frombuffer(blob[16:16 + 4 * n], np.uint32)
    ids = packed.unsqueeze(blob[16 + 4 * n:]).astype(U64) + U64(low & (2**64 - 1))
    return two, ids.view(np.int64)


def _smallest(bucket: int, keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    if bucket < 0:
        return [len(k).to_bytes(8, "little") + k + e for k, e in zip(keys, extras)]
    parts = [packed.unsqueeze_sorted(k) for k in keys]
    sides = [_ids_of(e) for e in extras]
    one, two = np.concatenate(parts), np.concatenate([s[0] for s in sides])
    ids = np.concatenate([s[1] for s in sides])
    _, _, least, number = _grouped(one, two, ids)
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return [_with_ids(np.zeros(0, np.uint32), part) for part in np.split(least[number], cuts)]


def _apply(window: int, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows = packed.open_shard(batch, i)
                words, lengths = packed.words_of(rows.field("text"))
                starts = np.concatenate([[0], np.cumsum(lengths)])
                replies = packed.replies_of(batch, "least", i)
                edge = np.zeros(len(words) + 1, np.int32)
                if replies:
                    own = replies.pop(0)[1]
                    size = int.from_bytes(own[:8], "little")
                    at = packed.unsqueeze_sorted(own[8:8 + size]).astype(np.int64)
                    least = np.concatenate([_ids_of(r)[1] for _, r in replies])[packed.unsqueeze(own[8 + size:])]
                    ids = pc.fill_null(rows.field("doc_id").cast(pa.int64()), _NO_ID).to_numpy()
                    gone = at[least < ids[np.searchsorted(starts, at, "right") - 1]]
                    edge[:-1] += np.bincount(gone, minlength=len(words)).astype(np.int32)
                    edge -= np.bincount(gone + window, minlength=len(words) + 1).astype(np.int32)
                covered = np.cumsum(edge[:-1]) > 0
                kept_before = np.concatenate([[0], np.cumsum(~covered)])[starts]
                kept = pc.binary_join(pa.ListArray.from_arrays(
                    pa.array(kept_before, pa.int32()), words.filter(pa.array(~covered)).cast(pa.string())), " ")
                yield pa.RecordBatch.from_arrays([
                    *[rows.field(f) for f in fields], pa.array(lengths, pa.int64()),
                    pa.array(lengths - np.diff(kept_before), pa.int64()), kept,
                ], names=[*fields, "__n_words", "__n_removed", "__kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` plus ``__n_words, __n_removed, __kept``: the words left, joined by one blank."""
    docs, back = set_aside(docs, "doc_id", "text")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    held = packed.shards(docs)
    # About one window for every six bytes of text, and two cells for each window.
    windows = (held.agg(F.sum("size")).first()[0] or 0) / 6
    bits = max(16, packed.bits_for(2 * windows, 1))
    key_bits = packed.bits_for(windows, KEYS_PER_BUCKET)
    flags = packed.ask(held.mapInArrow(_sketch_requests(window, bits), packed.REQUEST), _merge_sketches,
                       "sketch").withColumnRenamed("answers", "flags")
    flagged = held.join(flags, "shard", "left")
    least = packed.ask(flagged.mapInArrow(_exact_requests(window, bits, key_bits), packed.REQUEST), _smallest,
                       "repeats").withColumnRenamed("answers", "least")
    schema = T.StructType([*docs.schema.fields, T.StructField("__n_words", T.LongType()),
                           T.StructField("__n_removed", T.LongType()), T.StructField("__kept", T.StringType())])
    return back(held.join(least, "shard", "left").mapInArrow(_apply(window, docs.columns), schema))


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
                          F.sha2("__kept", 256).alias("kept_sha256"))
