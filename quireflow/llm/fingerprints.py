"""Operator 8: document fingerprints by content-defined chunking.

A gear hash over the bytes before each place says where a text may be cut. Cutting is
normalised: up to the usual size a cut needs more zero bits than after it, between a least and
a greatest size. Chunks depend on nearby bytes only, so an insertion shifts no far chunk. A
fingerprint is the set of chunk digests with their lengths; the likeness of one to another is
the share of its length whose chunks the other has, too.

Rows are independent of each other but for ``with_next``, which lays the documents in order of
id: ids are cut into stretches, and each stretch gets a copy of the first document after it.
The texts move once. An id with many rows is cut over several stretches by
the digest of the text; only rows alike in id and text stay together.

Defined cases: a null text is empty and has the empty fingerprint; an only document is its own
next one; rows of equal id stand in order of their text's digest, a null id first; an empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm import packed
from quireflow.llm.common import stored, text_or_empty

LEAST, USUAL, GREATEST = 24, 64, 256
STRICT_BITS, LOOSE_BITS = 6, 4     # zero bits asked for before and after the usual size
_NO_ID = int(np.iinfo(np.int64).min)  # a null id stands first
_GEAR = packed.mix64(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte, over the 32 bytes up to it: doubled windows."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width)) if len(h) > width else h[width:]
    return h


def cuts(hashes: np.ndarray) -> list[int]:
    """Ends of the chunks of one text, its length last."""
    n, start, out = len(hashes), 0, []
    top = hashes >> np.uint32(32 - LOOSE_BITS)
    loose = np.flatnonzero(top == 0)
    strict = loose[(hashes[loose] >> np.uint32(32 - STRICT_BITS)) == 0]
    loose, strict = loose.tolist(), strict.tolist()
    i = j = 0
    while n - start > LEAST:
        least, usual, most = start + LEAST, start + USUAL, start + GREATEST
        while i < len(strict) and strict[i] < least:
            i += 1
        if i < len(strict) and strict[i] < min(usual, n):
            end = strict[i] + 1
        else:
            while j < len(loose) and loose[j] < usual:
                j += 1
            end = loose[j] + 1 if j < len(loose) and loose[j] < most else most
        start = min(end, n)
        out.append(start)
    if start < n:
        out.append(n)
    return out


def chunks(text: str) -> dict[int, int]:
    """Chunk digests of a text and their lengths in bytes."""
    data = text.encode("utf-8", "surrogatepass")
    found, start = {}, 0
    for end in cuts(gear(np.frombuffer(data, np.uint8))) if data else ():
        found[xxhash.xxh3_64_intdigest(data[start:end])] = end - start
        start = end
    return found


def fingerprint(found: dict[int, int]) -> str:
    """The set as text: ``digest:length`` in order of digest."""
    return " ".join(f"{d:016x}:{found[d]}" for d in sorted(found))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """How much of ``a``'s length is in ``b``: 1 for two empty sets, 0 for one."""
    every = sum(a.values())
    return sum(length for d, length in a.items() if d in b) / every if every else float(not b)


def edited(text: str, other: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``other``."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_NAMES = [part.split()[0] for part in RESULT.split(", ")]


def _compare(ids: list, texts: list[str], found: list[dict], nexts: list[str], next_found: list[dict]) -> pa.RecordBatch:
    rows = []
    for i, text, mine, other, theirs in zip(ids, texts, found, nexts, next_found):
        changed = edited(text, other)
        changed_found = mine if changed == text else chunks(changed)
        rows.append((i, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                     fingerprint(mine), fingerprint(changed_found), containment(mine, changed_found), containment(mine, theirs)))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=_NAMES)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results for each document and the one after it in its stretch."""
    held = None
    for piece in packed.slices(batches):
        parts, extra = piece.column("part").to_pylist(), piece.column("extra").to_pylist()
        ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
        rows = list(zip(parts, extra, ids, texts, [chunks(t) for t in texts]))
        if held:
            rows.insert(0, held)
        held = rows[-1]
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
        yield _compare([a[2] for a, _ in pairs], [a[3] for a, _ in pairs], [a[4] for a, _ in pairs],
                       [b[3] for _, b in pairs], [b[4] for _, b in pairs])


def _stretch(bounds: np.ndarray):
    """Number of the stretch by id and place. An id that fills several stretches is a bound as
    many times; its rows are cut by place, a number of 32 bits that follows the digest's order."""
    @F.arrow_udf("int")
    def number(ids: pa.Array, places: pa.Array) -> pa.Array:
        filled = pc.fill_null(ids, _NO_ID).to_numpy(zero_copy_only=False)
        least, after = np.searchsorted(bounds, filled, "left"), np.searchsorted(bounds, filled, "right")
        within = places.to_numpy(zero_copy_only=False) * np.maximum(after - least, 1) >> 32
        return pa.array(np.minimum(least + 1, after) + within, pa.int32())
    return number


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text edited with the next document's, and the
    likeness of the first to the second and to the next document's (``RESULT``)."""
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = 4 * tasks
    shares = [k / stretches for k in range(1, stretches)]
    known = F.coalesce("doc_id", F.lit(_NO_ID))
    bounds = np.array(texts.agg(F.percentile_approx(known, shares, 10 * stretches)).first()[0] or [], np.int64)  # one id per stretch
    digest = F.md5(F.col("text").cast("binary"))
    # Only where an id fills a stretch does the place of a row need its text.
    hot = len(np.unique(bounds)) < len(bounds)
    texts = texts.withColumn("digest", digest if hot else F.lit(""))
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") if hot else F.lit(0).cast("long")
    texts = texts.withColumn("part", _stretch(bounds)("doc_id", place))
    # Each stretch also gets the first document of the next one (the last, that of the first).
    firsts = texts.groupBy("part").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
    along, whole = Window.orderBy("part"), Window.partitionBy()
    first = F.coalesce(F.lead("first").over(along), F.min_by("first", "part").over(whole))
    after = stored(firsts.select(  # a row per stretch
        F.col("part").alias("__to"), first["doc_id"].alias("__first"), first["digest"].alias("__digest")), "firsts")
    copies = texts.join(
        after, F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("digest") == F.col("__digest")),
    ).groupBy(F.col("__to").alias("part")).agg(F.min(F.struct(digest.alias("d"), "doc_id", "text")).alias("one")).select(
        "part", F.lit(True).alias("extra"), "one.doc_id", "one.text")
    rows = texts.select("part", F.lit(False).alias("extra"), "doc_id", "text").union(copies).repartition(tasks, "part")
    return rows.sortWithinPartitions("part", "extra", "doc_id", digest).mapInArrow(_walk, RESULT)
