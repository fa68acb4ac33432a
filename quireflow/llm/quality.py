"""Operator 5: a quality classifier of histogram gradient-boosted trees.

Statistics of each text (lengths, shares of character kinds, repetition) are computed once,
within the row. The trees are fitted on a bounded sample of labelled rows, ``SAMPLE``: the
rows first in order of a checksum of the id. Fitting sums gradients into histograms of
quantile bins, level by level. The fitted trees are arrays of features, thresholds and leaf
values, which numpy walks for all rows and trees at once.

Ids, languages, sources and labels never enter a score. Defined cases: a null or empty text
has all statistics 0 and gets a score like any other; a document with several labels has
their mean, rounded; null labels are ignored; without labels, or with one class only, every
score is the class's share (a half without labels); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm import packed
from quireflow.llm.common import stored, text_or_empty
from quireflow.llm.neardup import shingles

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.15, 64
LEAST_WEIGHT, RIDGE = 4.0, 1.0
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "blank": b" \t\r\v\f", "line": b"\n", "stop": b".", "comma": b",;:", "shout": b"!?",
    "symbol": b"#$%&*+<=>@\\^_`{|}~[]/", "quote": b"\"'()-", "other": bytes(range(128, 256)),
}
FEATURES = ["log_bytes", "log_words", "word_length", *KINDS, "distinct_words", "distinct_shingles",
            "longest_word", "words_per_line", "marked_words"]
_KIND = np.full(256, len(KINDS), np.uint8)
for _number, _chars in enumerate(KINDS.values()):
    _KIND[list(_chars)] = _number


def _distinct(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Share of distinct keys in each document."""
    doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    found = np.unique((doc << np.uint64(44)) | (keys >> np.uint64(20))) >> np.uint64(44)
    return np.bincount(found.astype(np.int64), minlength=len(counts)) / np.maximum(counts, 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """``[documents, features]``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts.slice(0, 0), texts])
    n = len(texts)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[:n + 1]
    size = np.diff(ends)
    kind = _KIND[np.frombuffer(data, np.uint8)[:ends[-1]]] if data else np.zeros(0, np.uint8)
    counts = np.zeros((n, len(KINDS)))
    full = np.flatnonzero(size > 0)
    for number in range(len(KINDS)):
        if len(full):
            counts[full, number] = np.add.reduceat(kind == number, ends[full], dtype=np.int64)
    words, lengths = packed.words_of(texts)
    indices, names = packed.hashed(words)
    long = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    longest, marked, begins = np.zeros(n), np.zeros(n), np.cumsum(lengths) - lengths
    some = np.flatnonzero(lengths > 0)
    if len(some):
        longest[some] = np.maximum.reduceat(long, begins[some])
        mark = pc.match_substring_regex(words, r"[#$%&*+=@^_`|~!]$").to_numpy(zero_copy_only=False)
        marked[some] = np.add.reduceat(mark, begins[some], dtype=np.int64)
    pieces, piece_counts = shingles(texts)
    per = np.maximum(lengths, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(lengths), (size - counts[:, 3] - counts[:, 4]) / per,
        counts / np.maximum(size, 1)[:, None], _distinct(names[indices], lengths), _distinct(pieces, piece_counts),
        longest, lengths / (counts[:, 4] + 1), marked / per,
    ]) * (size > 0)[:, None]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, stats``: statistics as packed 32-bit floats, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in packed.slices(batches):
            rows = statistics(piece.column("text")).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "stats"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(slim.mapInArrow(run, "doc_id long, stats binary"), "statistics")


@dataclass
class Trees:
    """Complete trees of one depth: node ``k`` has the children ``2k+1`` and ``2k+2``."""

    start: float
    feature: np.ndarray     # [trees, inner nodes]
    threshold: np.ndarray   # [trees, inner nodes]
    leaf: np.ndarray        # [trees, leaves]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Chance of class 1 for each row."""
        tree = np.arange(len(self.feature))
        node = np.zeros((len(rows), len(tree)), np.int64)
        inner = self.feature.shape[1]
        row = np.arange(len(rows))[:, None]
        while len(tree) and node[0, 0] < inner if len(rows) else False:
            right = rows[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        total = self.start + (self.leaf[tree, node - inner].sum(axis=1) if len(tree) else 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(total + np.zeros(len(rows)), -50, 50)))


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
              bins: int = BINS) -> Trees:
    n, width = rows.shape if len(rows) else (0, len(FEATURES))
    share = float(labels.mean()) if n else 0.5
    inner, leaves = 2**depth - 1, 2**depth
    if share in (0.0, 1.0) or not n:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Trees(np.log(share / (1 - share)), *[np.zeros((0, inner))] * 2, np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)])  # x > edge[b-1]
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - labels, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(count)
            for f in range(width):
                if not len(edges[f]):
                    continue
                slot = local * bins + binned[:, f]
                hist_g = np.bincount(slot, g, count * bins).reshape(count, bins)
                hist_h = np.bincount(slot, h, count * bins).reshape(count, bins)
                left_g, left_h = hist_g.cumsum(axis=1)[:, :-1], hist_h.cumsum(axis=1)[:, :-1]
                all_g, all_h = hist_g.sum(axis=1)[:, None], hist_h.sum(axis=1)[:, None]
                gain = (left_g**2 / (left_h + RIDGE) + (all_g - left_g)**2 / (all_h - left_h + RIDGE)
                        - all_g**2 / (all_h + RIDGE))
                gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = 0
                gain = gain[:, :len(edges[f])]
                cut = gain.argmax(axis=1)
                value = gain[np.arange(count), cut]
                for k in np.flatnonzero(value > best + 1e-9):
                    best[k], feature[t, first + k], threshold[t, first + k] = value[k], f, edges[f][cut[k]]
            node = 2 * node + 1 + (rows[np.arange(n), feature[t, node]] > threshold[t, node])
        end = node - inner
        leaf[t] = -rate * np.bincount(end, g, leaves) / (np.bincount(end, h, leaves) + RIDGE)
        margin += leaf[t][end]
    return Trees(start, feature, threshold, leaf)


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float32).reshape(-1, len(FEATURES)).astype(np.float64)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees from the statistics of labelled documents; ``labels``: ``doc_id`` and ``label``."""
    marks = labels.filter(F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.avg(label) >= 0.5).cast("int").alias("__label"))
    order = F.crc32(F.concat(F.lit("sample"), text_or_empty(F.col("doc_id").cast("string"))).cast("binary"))
    labelled = stats.join(marks, "doc_id").withColumn("__order", order)
    # A bound on the checksum leaves little more than the sample, so tasks send little.
    below = int(2**32 * min(1.0, 1.3 * sample / max(1, labelled.count())))
    rows = labelled.filter(F.col("__order") < F.lit(below)).orderBy("__order", "doc_id", "stats").limit(sample).select(
        "stats", "__label").toPandas()
    return fit_trees(_matrix(rows["stats"].tolist()), rows["__label"].to_numpy(np.float64))


def scored(stats: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id, score, predicted`` from stored statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = trees.score(_matrix(batch.column("stats").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``docs`` that the trees put into class 1, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in packed.slices(batches):
            score = trees.score(statistics(piece.column("text")).astype(np.float32).astype(np.float64))
            yield piece.filter(pa.array(score >= 0.5))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn(
        "text", F.col("text").cast("string")).schema)
