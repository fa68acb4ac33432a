"""Operator 7: near-duplicates by BagMinHash, banding and verified multiset overlap.

A document is a multiset of shingles (five words). Its BagMinHash signature comes from
Poisson processes: each shingle has one for each block [0,1), [1,2), [2,4), [4,8) … of its
multiplicity, points carry a time, a signature place and a weight inside the block, and count
if that weight is below the multiplicity. The earliest time of each place is the signature.
Two places agree with a chance equal to the weighted Jaccard similarity. A process stops when
its time passes the latest one its document's signature holds, so most give one point.

Equal texts are one node from the start. Nodes that agree in a band, or in a band and one of
the next two bands, are first compared with the most central node there: a star. The most
central node shares its bands with the most others, so a text that many others were made from
is compared with all of them. Each candidate is verified by exact weighted Jaccard on 64-bit
shingle hashes; links make classes.

A band with three nodes or more that the stars have not made one class may hold pairs that no
centre met. All nodes of such bands go through an exact prefix join: a node's shingles stand
in one order, rare ones first, and two nodes at 0.8 have one of their first shingles in common,
at places that leave room for enough others. No pair of theirs at 0.8 is left out, whatever the
centres were; pairs of one class are not compared again. So classes are exact for all pairs
that share a band: with 32 bands of 4 places a pair at 0.8 does with a chance of 1 - 5e-8.

Defined cases: a null text counts as empty; texts without words are near-duplicates of equal
texts only; a text of one to four words is one shingle; a null ``doc_id`` is kept and never
names a class unless all of the class are null; repeated rows are copies; an empty table
gives an empty result. Other columns are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm import packed
from quireflow.llm.common import set_aside, numbered, stored, text_or_empty

SHINGLE = 5
SIMILARITY = (4, 5)                # 0.8 as a fraction, for exact comparison
BANDS, ROWS = 32, 4
PLACES = BANDS * ROWS
KEYS_PER_BUCKET = 2_000_000
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_KEY_BITS = 44                     # of a shingle's hash, beside a document's number in its slice
CELL_BITS = 20                     # of the counts that say which shingles are rare


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row, and how many each text has."""
    words, lengths = packed.words_of(texts, lower=True)
    indices, names = packed.hashed(words)
    tokens = names[indices]
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(tokens))
    padded = np.concatenate([tokens, np.zeros(size, U64)])
    found = np.zeros(len(tokens), U64)
    for j in range(size):
        found = found * _BASE + np.where(left > j, padded[j:j + len(tokens)], U64(1))
    first = np.zeros(len(tokens), bool)
    first[(ends - lengths)[lengths > 0]] = True
    whole = (left >= size) | first
    return packed.mix64(found[whole]), np.where(lengths > 0, np.maximum(lengths - size + 1, 1), 0)


def signatures(keys: np.ndarray, weights: np.ndarray, doc: np.ndarray, docs: int, places: int = PLACES) -> np.ndarray:
    """BagMinHash times ``[docs, places]`` of elements ``keys`` with integer ``weights``."""
    times = np.full((docs, places), np.inf)
    flat = times.ravel()
    block = 0
    low, length = 0, 1
    while True:
        mine = np.flatnonzero(weights > low)
        if not len(mine):
            return times
        seed = packed.mix64(keys[mine] ^ packed.mix64(np.full(1, block + 1, U64)))
        at, owner, weight = np.zeros(len(mine)), doc[mine], weights[mine]
        step = 0
        while len(seed):
            step += 1
            draw = packed.mix64(seed + U64(step * int(_STRIDE) & (2**64 - 1)))
            at = at - np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
            inside = low + np.floor((packed.mix64(draw) >> U64(11)).astype(np.float64) * 2.0**-53 * length) < weight \
                if length > 1 else slice(None)
            place = owner * places + (draw & U64(places - 1)).astype(np.int64)
            np.minimum.at(flat, place[inside], at[inside])
            some = np.zeros(docs, bool)
            some[owner] = True
            latest = np.full(docs, -1.0)
            latest[some] = times[some].max(axis=1)
            going = at < latest[owner]
            seed, at, owner, weight = seed[going], at[going], owner[going], weight[going]
        block, low, length = block + 1, low + length, max(1, low + length)


_STRIDE = U64(0xD1B54A32D192ED03)


def band_keys(times: np.ndarray) -> np.ndarray:
    """A 64-bit key for each document and band."""
    parts = times.view(U64).reshape(len(times), BANDS, ROWS)
    keys = np.zeros(parts.shape[:2], U64) + np.arange(1, BANDS + 1, dtype=U64) * _STRIDE
    for r in range(ROWS):
        keys = packed.mix64(keys * _BASE + parts[:, :, r])
    return keys


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in packed.slices(batches):
        found, counts = shingles(piece.column("text"))
        doc = np.repeat(np.arange(len(counts), dtype=U64), counts)
        held, weights = np.unique((doc << U64(_KEY_BITS)) | (found >> U64(64 - _KEY_BITS)), return_counts=True)
        times = signatures(held & U64((1 << _KEY_BITS) - 1), weights, (held >> U64(_KEY_BITS)).astype(np.int64), len(counts))
        keys = band_keys(times)
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id"), piece.column("digest"),
            pa.array([k.tobytes() if c else None for k, c in zip(keys, counts)], pa.binary())],
            names=["doc_id", "digest", "bands"])


def _bands(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes with words, and their keys ``[nodes, BANDS]``."""
    bands = rows.field("bands")
    keys = np.frombuffer(b"".join(bands.drop_null().to_pylist()), U64).reshape(-1, BANDS)
    return rows.field("node").filter(bands.is_valid()).to_numpy(), keys


def _band_requests(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                _, bands = _bands(packed.open_shard(batch, i))
                keys, counts = np.unique(bands, return_counts=True)
                yield packed.request_batch(shard, [
                    (bucket, packed.squeeze_sorted(keys[part]), packed.squeeze(counts[part]))
                    for bucket, part in packed.by_bucket(keys, bits) if part.stop > part.start])
    return run


def _sizes(bucket: int, keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    """How many nodes have each key."""
    parts = [packed.unsqueeze_sorted(k) for k in keys]
    names, number = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(number, np.concatenate([packed.unsqueeze(e) for e in extras]), len(names)).astype(np.int64)
    return [packed.squeeze(part) for part in np.split(total[number], np.cumsum([len(p) for p in parts])[:-1])]


class _Meetings:
    """The keys under which a shard's nodes meet others, and how central each node is: with
    how many nodes it shares its bands. A text that others were made from shares most."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        nodes, bands = _bands(packed.open_shard(batch, i))
        replies = [packed.unsqueeze(r) for _, r in packed.replies_of(batch, "sizes", i)]
        found = np.concatenate(replies).astype(np.int64) if replies else np.zeros(0, np.int64)
        _, number = np.unique(bands, return_inverse=True)
        sizes = found[number.reshape(bands.shape)] if len(found) else np.zeros(bands.shape, np.int64)
        shared, central = sizes > 1, sizes.sum(axis=1)
        keys, mine = [bands[shared]], [np.nonzero(shared)[0]]
        for step in (1, 2):
            both = shared & np.roll(shared, -step, axis=1)
            keys.append(packed.mix64(bands[both] * _BASE + np.roll(bands, -step, axis=1)[both]))
            mine.append(np.nonzero(both)[0])
        mine = np.concatenate(mine)
        self.keys, self.nodes, self.central = np.concatenate(keys), nodes[mine], central[mine]


def _centres(keys: np.ndarray, nodes: np.ndarray, central: np.ndarray):
    """Distinct keys, the most central node of each (then the smallest) with its rank, and
    each item's key number."""
    order = np.lexsort((nodes, -central, keys))
    keys, nodes, central = keys[order], nodes[order], central[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return keys[new], nodes[new], central[new], number


def _centre_requests(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                meet = _Meetings(batch, i)
                keys, nodes, central, _ = _centres(meet.keys, meet.nodes, meet.central)
                rows = []
                for bucket, part in packed.by_bucket(keys, bits):
                    if part.stop > part.start:
                        first = packed.squeeze(nodes[part])
                        rows.append((bucket, packed.squeeze_sorted(keys[part]),
                                     len(first).to_bytes(8, "little") + first + packed.squeeze(central[part])))
                yield packed.request_batch(shard, rows)
    return run


def _most_central(bucket: int, keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    parts = [packed.unsqueeze_sorted(k) for k in keys]
    cuts = [8 + int.from_bytes(e[:8], "little") for e in extras]
    nodes = np.concatenate([packed.unsqueeze(e[8:c]) for e, c in zip(extras, cuts)]).astype(np.int64)
    central = np.concatenate([packed.unsqueeze(e[c:]) for e, c in zip(extras, cuts)]).astype(np.int64)
    _, best, _, number = _centres(np.concatenate(parts), nodes, central)
    return [packed.squeeze(part) for part in np.split(best[number], np.cumsum([len(p) for p in parts])[:-1])]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            meet = _Meetings(batch, i)
            _, _, _, number = _centres(meet.keys, meet.nodes, meet.central)
            replies = [packed.unsqueeze(r) for _, r in packed.replies_of(batch, "centres", i)]
            best = np.concatenate(replies).astype(np.int64)[number] if replies else meet.nodes
            pairs = np.stack([np.minimum(best, meet.nodes), np.maximum(best, meet.nodes)], axis=1)
            pairs = np.unique(pairs[best != meet.nodes], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in packed.slices(batches):
        found, counts = shingles(piece.column("text"))
        blobs = []
        for part in np.split(found, np.cumsum(counts)[:-1]):
            keys, n = np.unique(part, return_counts=True)
            first = packed.squeeze_sorted(keys)
            blobs.append(len(first).to_bytes(8, "little") + first + packed.squeeze(n))
        yield pa.RecordBatch.from_arrays([piece.column("node"), pa.array(blobs, pa.binary())], names=["node", "bag"])


def _bag(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 8 + int.from_bytes(blob[:8], "little")
    return packed.unsqueeze_sorted(blob[8:cut]), packed.unsqueeze(blob[cut:]).astype(np.int64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good, last, bag_a = [], None, None
        blobs_a, blobs_b = batch.column("bag_a"), batch.column("bag_b")
        for i, a in enumerate(batch.column("a").to_pylist()):
            if a != last:
                last, bag_a = a, _bag(blobs_a[i].as_py())
            keys_b, n_b = _bag(blobs_b[i].as_py())
            _, x, y = np.intersect1d(bag_a[0], keys_b, assume_unique=True, return_indices=True)
            shared = int(np.minimum(bag_a[1][x], n_b[y]).sum())
            union = int(bag_a[1].sum() + n_b.sum()) - shared
            good.append(SIMILARITY[1] * shared >= SIMILARITY[0] * union)
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


class _Crowds:
    """The keys of a shard that three nodes or more have, with the least and the greatest
    class among the shard's own nodes there, and each item's node and key number."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        nodes, bands = _bands(packed.open_shard(batch, i))
        replies = [packed.unsqueeze(r) for _, r in packed.replies_of(batch, "sizes", i)]
        found = np.concatenate(replies).astype(np.int64) if replies else np.zeros(0, np.int64)
        _, number = np.unique(bands, return_inverse=True)
        sizes = found[number.reshape(bands.shape)] if len(found) else np.zeros(bands.shape, np.int64)
        marks = batch.column("marks")[i].as_py() or []
        known = dict(zip([m["node"] for m in marks], [m["label"] for m in marks]))
        labels = np.array([known.get(n, n) for n in nodes.tolist()], np.int64)
        crowded = sizes > 2
        at = np.nonzero(crowded)[0]
        self.nodes, mine = nodes[at], labels[at]
        self.keys, self.number = np.unique(bands[crowded], return_inverse=True)
        self.low = np.full(len(self.keys), np.iinfo(np.int64).max)
        self.high = np.full(len(self.keys), -1)
        np.minimum.at(self.low, self.number, mine)
        np.maximum.at(self.high, self.number, mine)


def _crowd_requests(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                crowds = _Crowds(batch, i)
                rows = []
                for bucket, part in packed.by_bucket(crowds.keys, bits):
                    if part.stop > part.start:
                        first = packed.squeeze(crowds.low[part])
                        rows.append((bucket, packed.squeeze_sorted(crowds.keys[part]),
                                     len(first).to_bytes(8, "little") + first + packed.squeeze(crowds.high[part])))
                yield packed.request_batch(shard, rows)
    return run


def _divided(bucket: int, keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    """Whether the nodes of each key are in more than one class."""
    parts = [packed.unsqueeze_sorted(k) for k in keys]
    cuts = [8 + int.from_bytes(e[:8], "little") for e in extras]
    names, number = np.unique(np.concatenate(parts), return_inverse=True)
    low, high = np.full(len(names), np.iinfo(np.int64).max), np.full(len(names), -1)
    np.minimum.at(low, number, np.concatenate([packed.unsqueeze(e[8:c]) for e, c in zip(extras, cuts)]).astype(np.int64))
    np.maximum.at(high, number, np.concatenate([packed.unsqueeze(e[c:]) for e, c in zip(extras, cuts)]).astype(np.int64))
    divided = (low != high)[number].astype(np.uint8)
    return [packed.squeeze(part) for part in np.split(divided, np.cumsum([len(p) for p in parts])[:-1])]


def _unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            crowds = _Crowds(batch, i)
            replies = [packed.unsqueeze(r) for _, r in packed.replies_of(batch, "divided", i)]
            divided = np.concatenate(replies).astype(bool) if replies else np.zeros(len(crowds.keys), bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(crowds.nodes[divided[crowds.number]]))], names=["node"])


def _elements(blob: bytes) -> np.ndarray:
    """A bag as a set: a hash for each occurrence of each shingle."""
    keys, n = _bag(blob)
    turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return packed.mix64(np.repeat(keys, n) * _BASE + turn.astype(U64))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            found = np.concatenate([_elements(b) for b in batch.column("bag").to_pylist()]) >> U64(64 - CELL_BITS)
            cells, n = np.unique(found.astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], names=["cell", "n"])


def _prefixes(counts, shorter: bool):
    """The first elements of each node, rare ones first, with their places from 1: as many as
    a pair at SIMILARITY can do without and one, for its ``shorter`` or its longer text."""
    part, whole = SIMILARITY
    if shorter:
        part, whole = 2 * part, part + whole  # of the shorter text, by the overlap of two equal lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blob in batch.column("bag").to_pylist():
                found = _elements(blob)
                order = np.lexsort((found, counts.value[(found >> U64(64 - CELL_BITS)).astype(np.int64)]))
                rows.append((len(found), found[order[:len(found) + 1 - -(-part * len(found) // whole)]]))
            lengths = np.array([len(r) for _, r in rows], np.int64)
            each = np.repeat(np.arange(len(rows)), lengths)
            first = np.concatenate([r for _, r in rows]) if rows else np.zeros(0, U64)
            places = np.arange(len(first)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array(first.view(np.int64)), batch.column("node").take(pa.array(each)),
                batch.column("label").take(pa.array(each)), pa.array(np.array([n for n, _ in rows], np.int64)[each]),
                pa.array(places)], names=["element", "node", "label", "size", "place"])
    return run


def _prefix_pairs(bags: DataFrame) -> DataFrame:
    """Pairs of ``node, label, bag`` rows of different labels, all those at SIMILARITY among them.

    The join meets the first element that a pair has in common, too; from there on the rest of
    the two texts bounds how many others they can share."""
    spark = bags.sparkSession
    found = bags.mapInArrow(_cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(1 << CELL_BITS, np.int64)  # the driver holds these counts, whatever the input
    cells[found["cell"].to_numpy()] = found["n"].to_numpy()
    counts = spark.sparkContext.broadcast(cells)
    schema = "element long, node long, label long, size long, place long"
    short = bags.mapInArrow(_prefixes(counts, True), schema).toDF("element", "s_node", "s_label", "s_size", "s_place")
    long = bags.mapInArrow(_prefixes(counts, False), schema)
    part, whole = SIMILARITY
    room = F.least(F.col("s_size") - F.col("s_place"), F.col("size") - F.col("place")) + 1
    match = (F.col("s_label") != F.col("label")) & (F.col("s_size") <= F.col("size")) & (
        whole * F.col("s_size") >= part * F.col("size")) & ((part + whole) * room >= part * (F.col("s_size") + F.col("size")))
    met = short.join(long, "element").filter(match)
    return met.select(F.least("s_node", "node").alias("a"), F.greatest("s_node", "node").alias("b")).distinct()


def _linked(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs that are as similar as SIMILARITY."""
    with_a = pairs.join(bags.withColumnsRenamed({"node": "a", "bag": "bag_a"}), "a")
    return stored(with_a.join(bags.withColumnsRenamed({"node": "b", "bag": "bag_b"}), "b").select(
        "a", "b", "bag_a", "bag_b").mapInArrow(_verify, "a long, b long"), "verified")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each linked node can reach. Labels run along
    the links and jump to their label's label, until nothing changes."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = stored(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("__near"))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("__old"), F.least("label", "__near").alias("label"))
        step = stored(step, "labels")
        jump = step.select(F.col("node").alias("__node"), F.col("label").alias("__to"))
        after = stored(step.join(jump, F.col("label") == F.col("__node")).select(
            "node", "__old", F.col("__to").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("label <> __old").isEmpty():
            return labels


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signed rows ``doc_id, digest`` and nodes ``node, digest, first_id, copies, label``."""
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).alias("text"))
    texts = texts.withColumn("digest", F.md5(F.col("text").cast("binary")))
    signed = stored(texts.mapInArrow(_sign, "doc_id long, digest string, bands binary"), "signed")
    copies = signed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"),
                                          F.first("bands").alias("bands"))
    nodes = stored(numbered(copies, [F.col("digest")], name="node"), "nodes")
    held = packed.shards(nodes.select("node", "bands"), text="bands")
    bits = packed.bits_for((held.agg(F.sum("size")).first()[0] or 0) / 8, KEYS_PER_BUCKET)
    sizes = packed.ask(held.mapInArrow(_band_requests(bits), packed.REQUEST), _sizes, "sizes")
    sized = held.join(sizes.withColumnRenamed("answers", "sizes"), "shard")
    centres = packed.ask(sized.mapInArrow(_centre_requests(bits), packed.REQUEST), _most_central, "centres")
    met = sized.join(centres.withColumnRenamed("answers", "centres"), "shard")
    pairs = stored(met.mapInArrow(_candidates, "a long, b long").distinct(), "pairs")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select(
        "node", F.col("digest").alias("__digest"), F.col("first_id").alias("__id"))
    match = (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    found = texts.join(wanted, match).select("node", "text").mapInArrow(_bags, "node long, bag binary")
    bags = stored(found.groupBy("node").agg(F.first("bag").alias("bag")), "bags")
    links = _linked(pairs, bags)
    labels = components(links)

    # What the stars leave undecided: bands whose nodes are still in several classes.
    places = held.select("shard", F.explode("rows.node").alias("node"))
    marks = places.join(labels, "node").groupBy("shard").agg(F.collect_list(F.struct("node", "label")).alias("marks"))
    marked = sized.join(stored(marks, "marks"), "shard", "left")
    divided = packed.ask(marked.mapInArrow(_crowd_requests(bits), packed.REQUEST), _divided, "divided")
    left = stored(marked.join(divided.withColumnRenamed("answers", "divided"), "shard").mapInArrow(
        _unsettled, "node long"), "unsettled")
    if not left.isEmpty():
        again = stored(bags.join(left, "node").join(labels, "node", "left").select(
            "node", F.coalesce("label", "node").alias("label"), "bag"), "again")
        more = stored(_prefix_pairs(again), "pairs")
        found = _linked(more, again.select("node", "bag"))
        if not found.isEmpty():
            labels = components(links.union(found))
    marked = nodes.drop("bands").join(labels, "node", "left").select(
        "node", "digest", "first_id", "copies", F.coalesce("label", "node").alias("label"))
    return signed.select("doc_id", "digest"), stored(marked, "classes")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, class_size`` per row: the smallest id of the row's class, and its rows."""
    signed, nodes = _classed(docs)
    heads = nodes.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    return signed.join(nodes.join(heads, "label").select("digest", "class_id", "class_size"), "digest").select(
        "doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of its smallest id (and smallest text digest)."""
    _, nodes = _classed(docs)
    last = F.lit(2**63 - 1)
    kept = nodes.groupBy("label").agg(F.min(F.struct(F.coalesce("first_id", last).alias("__id"), F.col("digest").alias("__digest"))).alias("k"))
    kept = kept.select("k.__id", "k.__digest")
    held, back = set_aside(docs)
    names = dict(zip(docs.columns, held.columns))
    keyed = held.withColumn("__id2", F.coalesce(F.col(names["doc_id"]).cast("long"), last)).withColumn(
        "__digest2", F.md5(text_or_empty(F.col(names["text"]).cast("string")).cast("binary")))
    rows = keyed.join(kept, (F.col("__id2") == F.col("__id")) & (F.col("__digest2") == F.col("__digest")))
    return back(rows.dropDuplicates(["__id2", "__digest2"]).select(*held.columns))
