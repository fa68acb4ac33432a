"""Operator 2: language-model scores by deleted interpolation.

An n-gram model mixes the maximum-likelihood estimates of all orders down to a uniform one.
The mixture weights depend on how often the longest context was seen (buckets by powers of
two) and come from expectation-maximisation on held-out counts: a fold of the training
documents, against counts from which that fold is deleted. The scores then use the counts of
all training documents with these weights.

Counts are gathered from the whole corpus by packed exchanges (``packed``): each shard asks
once for each n-gram it has, and the key range's task adds up and answers. A word is a
64-bit hash; two words of a corpus with a billion distinct ones share one with a chance of 3 %.
Longer n-grams go by as many hash bits as the corpus needs for about one in a million of them
to share its number with another: 20 more than the number of words has.

Defined cases: a null or empty text is one end token; without training documents every
probability is uniform; repeated rows count and score like others; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm import packed
from quireflow.llm.common import stored

U64 = np.uint64
END, BEGIN = U64(0x2545F4914F6CDD1D), U64(0x27D4EB2F165667C5)
HELD_OUT, TRAIN, FOLD = 0, 1, 2      # what a document is for; a fold document also trains
CONTEXT_BUCKETS = 16
ROUNDS = 12
KEYS_PER_BUCKET = 2_000_000
SPARE_BITS = 20         # of an n-gram's number, beyond those that count the corpus' words


class _Shard:
    """Tokens of a shard, whose documents are all for one use, and the n-gram keys of every
    order, document after document; longer n-grams' keys have only their upper ``width`` bits."""

    def __init__(self, rows: pa.StructArray, order: int, width: int):
        words, lengths = packed.words_of(rows.field("text"), lower=True)
        indices, names = packed.hashed(words)
        self.doc_ids, self.use = rows.field("doc_id"), rows.field("use")[0].as_py() if len(rows) else TRAIN
        self.lengths = lengths + 1
        self.ends = np.cumsum(self.lengths)
        tokens = np.empty(int(self.ends[-1]) if len(rows) else 0, U64)
        inner = np.ones(len(tokens), bool)
        inner[self.ends - 1] = False
        tokens[inner] = names[indices]
        tokens[self.ends - 1] = END
        self.begins = self.ends - self.lengths
        # Order k of a token: its order k - 1 key and the token k - 1 places before it, or a
        # begin mark where that lies before the document.
        self.keys = [tokens]
        for back in range(1, order):
            before = np.empty_like(tokens)
            before[back:] = tokens[:-back] if len(tokens) > back else tokens[:0]
            for k in range(back):
                before[np.minimum(self.begins + k, self.ends - 1)] = BEGIN
            self.keys.append(packed.mix64(self.keys[-1] * U64(0x9E3779B97F4A7C15) + before))
        spare = U64(64 - width)
        self.keys[1:] = [(keys >> spare) << spare for keys in self.keys[1:]]

    def shifted(self, values: np.ndarray, first: int | float) -> np.ndarray:
        """The value of the token before, ``first`` for a document's first token."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.begins] = first
        return out


def _requests(order: int, bits: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                data = _Shard(packed.open_shard(batch, i), order, width)
                rows = []
                for k, keys in enumerate(data.keys):
                    names, times = np.unique(keys, return_counts=True)
                    counts = []
                    for use in (TRAIN, FOLD):
                        counts.append(times if data.use == use else np.zeros(len(names), np.int64))
                    for bucket, part in packed.by_bucket(names, bits, k << bits):
                        if part.stop > part.start:
                            extra = [packed.squeeze(c[part]) for c in counts]
                            rows.append((bucket, packed.squeeze_sorted(names[part] >> U64(64 - width if k else 0)),
                                         len(extra[0]).to_bytes(8, "little") + b"".join(extra)))
                yield packed.request_batch(shard, rows)
    return run


def _pair(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 8 + int.from_bytes(blob[:8], "little")
    return packed.unsqueeze(blob[8:cut]), packed.unsqueeze(blob[cut:])


def _totals(unigram_buckets: int):
    """All training counts of each key, and those of the fold; for unigrams also how many
    distinct ones there are, and their sums."""
    def answer(bucket: int, keys: list[bytes], extras: list[bytes]) -> list[bytes]:
        parts = [packed.unsqueeze_sorted(k) for k in keys]
        pairs = [_pair(e) for e in extras]
        names, where = np.unique(np.concatenate(parts), return_inverse=True)
        sums = [np.bincount(where, np.concatenate([p[side] for p in pairs]), len(names)).astype(np.int64)
                for side in (0, 1)]
        whole = sums[0] + sums[1]
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        replies = []
        for a, b, own in zip(np.split(whole[where], cuts), np.split(sums[1][where], cuts), pairs):
            first = packed.squeeze(a)  # only the fold's own shards need the fold's counts
            second = packed.squeeze(b if own[1].any() else b[:0])
            replies.append(len(first).to_bytes(8, "little") + first + second)
        if bucket < unigram_buckets:
            replies.append(np.array([(whole > 0).sum(), whole.sum(), sums[1].sum()], "<i8").tobytes())
        return replies
    return answer


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The unigram buckets' own replies as numbers."""
    for batch in batches:
        found = [np.frombuffer(r, "<i8") for i in range(len(batch)) for _, r in packed.replies_of(batch, "answers", i)]
        rows = np.array(found, np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=["n_distinct", "n_all", "n_fold"])


def _numbers(keys: np.ndarray) -> np.ndarray:
    """Number of each key among the distinct ones in order, by one sort."""
    order = np.argsort(keys)
    there = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = there[1:] != there[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return number


def _counts(data: _Shard, replies: list[tuple[int, bytes]], bits: int, *sides: int) -> list[list[np.ndarray]]:
    """For each side (0 all training rows, 1 the fold) and order: every token's n-gram's count."""
    found = [[] for _ in sides]
    for k, keys in enumerate(data.keys):
        number = _numbers(keys)
        mine = [_pair(r) for b, r in replies if b >> bits == k]
        for out, side in zip(found, sides):
            out.append(np.concatenate([pair[side] for pair in mine])[number].astype(np.int64))
    return found


def _estimates(data: _Shard, counts: list[np.ndarray], total: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Context bucket of every token, and its estimates by order, the lowest first."""
    context = np.full(len(counts[0]), total, np.int64)
    estimates = []
    for k, c in enumerate(counts):
        if k:
            context = data.shifted(counts[k - 1], docs)
        estimates.append(np.where(context > 0, c / np.maximum(context, 1), 0.0))
    bucket = np.minimum(np.frexp(context.astype(float))[1], CONTEXT_BUCKETS - 1)
    return bucket, np.array(estimates)


def _fold_estimates(order: int, bits: int, width: int, total: int, docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                data = _Shard(packed.open_shard(batch, i), order, width)
                replies = packed.replies_of(batch, "answers", i)
                whole, own = _counts(data, replies, bits, 0, 1)
                bucket, p = _estimates(data, [a - b for a, b in zip(whole, own)], total, docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([bucket.astype(np.uint8).tobytes()], pa.binary()),
                    pa.array([p.astype(np.float32).tobytes()], pa.binary())], names=["bucket", "p"])
    return run


def _expectation(weights: np.ndarray, uniform: float):
    """Each part's expected use by context bucket, added up over a task's tokens."""
    parts = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used = np.zeros((CONTEXT_BUCKETS, parts))
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("p").to_pylist()):
                bucket = np.frombuffer(b, np.uint8)
                p = np.frombuffer(p, np.float32).reshape(parts - 1, -1)
                share = weights[bucket].T * np.vstack([np.full(len(bucket), uniform), p])
                share /= share.sum(axis=0)
                for part in range(parts):
                    used[:, part] += np.bincount(bucket, share[part], CONTEXT_BUCKETS)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(CONTEXT_BUCKETS), parts), pa.int32()),
                pa.array(np.tile(np.arange(parts), CONTEXT_BUCKETS), pa.int32()), pa.array(used.ravel())],
                names=["bucket", "part", "used"])
    return run


def _learn(fold: DataFrame, order: int, uniform: float) -> np.ndarray:
    """Weights ``[bucket, part]``, part 0 uniform: rounds of EM, a pass over the fold each. A
    bucket that the fold has no token of takes the weights of the nearest lower one that has."""
    weights = np.full((CONTEXT_BUCKETS, order + 1), 1.0 / (order + 1))
    for _ in range(ROUNDS):
        used = np.zeros_like(weights)
        sums = fold.mapInArrow(_expectation(weights, uniform), "bucket int, part int, used double")
        for row in sums.groupBy("bucket", "part").agg(F.sum("used").alias("used")).collect():  # buckets x parts rows
            used[row.bucket, row.part] = row.used
        seen = used.sum(axis=1, keepdims=True)
        weights = np.where(seen > 0, used / np.maximum(seen, 1e-300), weights)
    known = np.flatnonzero(seen[:, 0] > 0)
    if len(known):
        lower = np.searchsorted(known, np.arange(CONTEXT_BUCKETS), "right") - 1
        weights = weights[known[np.maximum(lower, 0)]]
    return np.maximum(weights, [1e-9, *[0.0] * order])


def _scores(order: int, bits: int, width: int, weights: np.ndarray, total: int, distinct: int, docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                data = _Shard(packed.open_shard(batch, i), order, width)
                counts, = _counts(data, packed.replies_of(batch, "answers", i), bits, 0)
                bucket, p = _estimates(data, counts, total, docs)
                w = weights[bucket].T
                mixed = w[0] / (distinct + 1) + (w[1:] * p).sum(axis=0)
                sums = [np.add.reduceat(x, data.begins) if len(data.begins) else np.zeros(0) for x in (
                    np.log10(mixed), np.log10((counts[0] + 1) / (total + distinct + 1)), (counts[0] > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([
                    data.doc_ids, pa.array([data.use == HELD_OUT] * len(data.lengths), pa.bool_()), pa.array(data.lengths, pa.int64()),
                    pa.array(sums[2], pa.int64()), pa.array(np.full(len(data.lengths), total), pa.int64()),
                    pa.array(sums[1]), pa.array(sums[0])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, use: Column, order: int = 3) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document.

    ``use`` says what a document is for: ``HELD_OUT``, ``TRAIN`` or ``FOLD``.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), use.cast("int").alias("use"))
    held = packed.shards(rows, by="use")
    words = (held.agg(F.sum("size")).first()[0] or 0) / 6
    bits = packed.bits_for(words, KEYS_PER_BUCKET)
    width = min(64, SPARE_BITS + max(20, packed.bits_for(words, 1)))
    replies = packed.ask(held.mapInArrow(_requests(order, bits, width), packed.REQUEST), _totals(1 << bits), "counts")
    own = replies.filter("shard < 0").mapInArrow(_sums, "n_distinct long, n_all long, n_fold long")
    distinct, total, fold_total = (x or 0 for x in own.agg(*[F.sum(c) for c in own.columns]).first())
    uses = {r.use: r.n for r in held.select(F.explode("rows.use").alias("use")).groupBy("use").agg(
        F.count("*").alias("n")).collect()}
    train, fold = uses.get(TRAIN, 0), uses.get(FOLD, 0)
    known = held.join(replies, "shard")
    parts = stored(known.filter(F.col("part") == FOLD).mapInArrow(_fold_estimates(order, bits, width, total - fold_total, train), "bucket binary, p binary"), "fold")
    weights = _learn(parts, order, 1.0 / (distinct + 1))
    return known.mapInArrow(
        _scores(order, bits, width, weights, total, distinct, train + fold),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
