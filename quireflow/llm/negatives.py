"""Operator 11: hard negatives by Fagin's threshold algorithm.

Vectors are cut into blocks, and each block holds one sorted list of its rows per dimension. For
an anchor the lists are read in step, from the top where its component is positive and from the
bottom where it is negative; each row met is scored whole, by random access. The sum of what the
lists have come down to bounds the score of all rows not met yet. A search ends when this bound
falls strictly below the score of the last row wanted, as an equal score could still win by id.

Two passes over the same lists: the first finds every anchor's positives, whose scores give the
windows of the second, which finds the negatives in each. Anchors travel to the blocks of
vectors in blocks of their own; what a pair of blocks finds is one packed row, and these rows
are merged ``FAN`` at a time, so no task and no row grows with the table.

Scores are sums of whole numbers and exact. Defined cases: rows with a null label, a null vector
or a component that is null or not finite take no part; of two vectors of different length the
longer one is cut, as if the other had zeros; an anchor's other rows are those of another id,
and of rows that share one id each is an anchor, a positive or a negative by itself; a null id
is no anchor, and comes after all others in ties; without positives or negatives there are no
rows; scores beyond 2^60 raise an OverflowError; an empty table gives an empty result. Columns
beside the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import stored

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100     # per cent of the positive's score
SCALE = 256
ROWS, ANCHORS = 2048, 256  # rows of a block
FAN = 64
FIRST_DEPTH = 8
_ABSENT = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max
BLOCK = "block int, dims int, ids binary, labels binary, kind string, vectors binary, lists binary"


# Blocks

def _block(batches: Iterator[pa.RecordBatch], lists: bool) -> Iterator[pa.RecordBatch]:
    """All rows of the task as one block; ``lists``: with each dimension's rows in order."""
    held = [batch for batch in batches if len(batch)]
    if not held:
        return
    table = pa.Table.from_batches(held)
    vectors = table["vector"].combine_chunks()
    ends = vectors.offsets.to_numpy().astype(np.int64)
    width = np.diff(ends)
    dims = int(width.max())
    cells = np.floor(vectors.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.float64) * SCALE)
    if len(cells) and np.abs(cells).max() >= 2.0**60:
        raise OverflowError("a component is beyond what scores can hold")
    whole = np.zeros((len(table), dims), np.int64)
    whole[np.repeat(np.arange(len(table)), width), np.arange(len(cells)) - np.repeat(ends[:-1] - ends[0], width)] = cells
    top = int(np.abs(whole).max()) if whole.size else 0
    kind = next(f"<i{b}" for b in (2, 4, 8) if top < 1 << (8 * b - 1))
    order = np.argsort(whole, axis=0, kind="stable").T.astype("<i4").tobytes() if lists else None
    ids = table["id"].fill_null(_NO_ID).to_numpy()
    yield pa.RecordBatch.from_arrays([
        pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([dims], pa.int32()),
        pa.array([ids.tobytes()], pa.binary()), pa.array([table["label"].to_numpy().tobytes()], pa.binary()),
        pa.array([kind]), pa.array([whole.astype(kind).tobytes()], pa.binary()), pa.array([order], pa.binary()),
    ], names=["block", "dims", "ids", "labels", "kind", "vectors", "lists"])


def _blocks(rows: DataFrame, each: int, lists: bool, name: str) -> tuple[DataFrame, int]:
    """``rows`` as blocks of about ``each`` rows, stored, and the number of blocks."""
    count = max(1, -(-rows.count() // each))
    made = rows.repartition(count).mapInArrow(lambda batches: _block(batches, lists), BLOCK)
    return stored(made, name), count


class _Rows:
    """One block, unpacked."""

    def __init__(self, row: dict, prefix: str = ""):
        self.ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
        self.labels = np.frombuffer(row[f"{prefix}labels"], np.int64)
        self.vectors = np.frombuffer(row[f"{prefix}vectors"], row[f"{prefix}kind"]).reshape(
            len(self.ids), row[f"{prefix}dims"]).astype(np.int64)
        lists = row[f"{prefix}lists"]
        self.lists = np.frombuffer(lists, "<i4").reshape(row[f"{prefix}dims"], len(self.ids)) if lists is not None else None


# The search

def rounds(rows: _Rows, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Rounds of sorted and random access: the rows met for the first time, their scores, and
    a bound on the scores of all rows not met yet (``_ABSENT`` when there are none)."""
    n, dims = rows.vectors.shape
    dims = min(dims, len(anchor))
    vectors, anchor = rows.vectors[:, :dims], anchor[:dims]
    reach = int(np.abs(vectors).max(initial=0)) * int(np.abs(anchor).max(initial=0)) * dims
    if reach >= 1 << 60:
        raise OverflowError("a score is beyond 2^60")
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    if not len(up) + len(down):  # no list to read: every score is 0
        yield np.arange(n), np.zeros(n, np.int64), _ABSENT
        return
    seen, left, depth, step = np.zeros(n, bool), n, 0, FIRST_DEPTH
    while left:
        to = min(n, depth + step)
        met = np.concatenate([rows.lists[up, n - to:n - depth].ravel(), rows.lists[down, depth:to].ravel()])
        fresh = np.unique(met[~seen[met]])
        seen[fresh] = True
        left -= len(fresh)
        bound = _ABSENT
        if left:
            bound = int(anchor[up] @ vectors[rows.lists[up, n - to], up]) + int(
                anchor[down] @ vectors[rows.lists[down, to - 1], down])
        yield fresh, vectors[fresh] @ anchor, bound
        depth, step = to, 2 * step


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, the smaller id first among equals."""
    if len(scores) > k:  # only what can be among them has to be sorted
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = scores >= least
        scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _best(found: tuple, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    return first(np.concatenate([found[0], scores]), np.concatenate([found[1], ids]), k)


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def positives_in(rows: _Rows, anchor: np.ndarray, own_id: int, label: int, k: int):
    found = _NONE
    for fresh, scores, bound in rounds(rows, anchor):
        fit = (rows.labels[fresh] == label) & (rows.ids[fresh] != own_id)
        found = _best(found, scores[fit], rows.ids[fresh[fit]], k)
        if len(found[0]) == k and bound < found[0][-1]:
            break
    return found


def negatives_in(rows: _Rows, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int):
    """The first ``k`` rows of other labels with a score within each window."""
    found, open_ = [_NONE] * len(windows), set(range(len(windows)))
    if not open_:
        return found
    for fresh, scores, bound in rounds(rows, anchor):
        other = rows.labels[fresh] != label
        s, ids = scores[other], rows.ids[fresh[other]]
        for w in list(open_):
            low, high = windows[w]
            fit = (s >= low) & (s <= high)
            if fit.any():
                found[w] = _best(found[w], s[fit], ids[fit], k)
            if bound < low or (len(found[w][0]) == k and bound < found[w][0][-1]):
                open_.discard(w)
        if not open_:
            break
    return found


# Passes over pairs of blocks

FOUND = "a_block int, part int, scores binary, ids binary"


def _filled(found: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[bytes, bytes]:
    scores = np.full((len(found), k), _ABSENT)
    ids = np.full((len(found), k), _NO_ID)
    for i, (s, x) in enumerate(found):
        scores[i, :len(s)], ids[i, :len(s)] = s, x
    return scores.tobytes(), ids.tobytes()


def _window(score: int, low: int, high: int) -> tuple[int, int] | None:
    """Whole scores from ``low`` to ``high`` per cent of a score; None if there are none."""
    least, most = -(-low * score // 100), high * score // 100
    return (least, most) if least <= most else None


def _search(k: int, positives: int | None = None, low: int = LOW, high: int = HIGH):
    """First pass (``positives`` None): ``k`` positives per anchor. Second: ``k`` negatives for
    each of the positives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                rows, anchors, found = _Rows(row), _Rows(row, "a_"), []
                if positives is not None:
                    hits = np.frombuffer(row["a_scores"], np.int64).reshape(-1, positives)
                for i, anchor in enumerate(anchors.vectors):
                    label = int(anchors.labels[i])
                    if positives is None:
                        found.append(positives_in(rows, anchor, int(anchors.ids[i]), label, k))
                        continue
                    wanted = [_window(int(s), low, high) if s != _ABSENT else None for s in hits[i]]
                    distinct = sorted({w for w in wanted if w})
                    by = dict(zip(distinct, negatives_in(rows, anchor, label, distinct, k)))
                    found += [by.get(w, _NONE) for w in wanted]
                scores, ids = _filled(found, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["a_block"]], pa.int32()), pa.array([row["block"]], pa.int32()),
                    pa.array([scores], pa.binary()), pa.array([ids], pa.binary())], names=["a_block", "part", "scores", "ids"])
    return run


def _merged(k: int):
    def run(table: pa.Table) -> pa.Table:
        scores = np.concatenate([np.frombuffer(s, np.int64).reshape(-1, k) for s in table["scores"].to_pylist()], axis=1)
        ids = np.concatenate([np.frombuffer(s, np.int64).reshape(-1, k) for s in table["ids"].to_pylist()], axis=1)
        real = [s != _ABSENT for s in scores]
        s, x = _filled([first(a[r], b[r], k) for a, b, r in zip(scores, ids, real)], k)
        return pa.table({"a_block": table["a_block"][:1], "part": table["part"][:1], "scores": pa.array([s], pa.binary()),
                         "ids": pa.array([x], pa.binary())})
    return run


def _pass(vectors: DataFrame, blocks: int, anchors: DataFrame, search, k: int, name: str) -> DataFrame:
    """``a_block, scores, ids``: the first ``k`` of what the search finds in all blocks."""
    to_blocks = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = vectors.repartition(blocks, "block").join(to_blocks.repartition(blocks, "block"), "block")
    found, parts = pairs.mapInArrow(search, FOUND), blocks
    while True:
        parts = -(-parts // FAN)
        found = found.withColumn("part", F.pmod("part", F.lit(parts)).cast("int")).groupBy("a_block", "part").applyInArrow(
            _merged(k), FOUND)
        if parts == 1:
            return stored(found.drop("part"), name)


def _rows_out(positives: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        for batch in batches:
            for row in batch.to_pylist():
                anchors = np.frombuffer(row["a_ids"], np.int64)
                ps, pi = (np.frombuffer(row[c], np.int64).reshape(-1, positives) for c in ("a_scores", "a_found"))
                ns, ni = (np.frombuffer(row[c], np.int64).reshape(-1, positives, k) for c in ("scores", "ids"))
                a, p, r = np.nonzero(ns != _ABSENT)

                def ids(values: np.ndarray) -> pa.Array:
                    return pa.array(values, pa.int64(), mask=values == _NO_ID)

                yield pa.RecordBatch.from_arrays([
                    ids(anchors[a]), ids(pi[a, p]), pa.array((r + 1).astype(np.int32)), ids(ni[a, p, r]),
                    pa.array(ps[a, p]), pa.array(ns[a, p, r])], names=names)
    return run


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has the integer columns ``vec_id`` and ``label`` and an array ``vector`` of
    numbers; ``is_anchor`` is a condition on it. ``low`` and ``high`` bound a negative's score,
    in per cent of the positive's."""
    usable = F.forall(F.col(vector).cast("array<double>"),
                      lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), (is_anchor & F.col(vec_id).isNotNull()).alias("anchor"))
    blocks, count = _blocks(rows.drop("anchor"), ROWS, True, "lists")
    anchors, _ = _blocks(rows.where("anchor").drop("anchor"), ANCHORS, False, "anchors")
    anchors = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    liked = _pass(blocks, count, anchors, _search(positives), positives, "positives")
    anchors = stored(anchors.join(liked.select("a_block", F.col("scores").alias("a_scores"), F.col("ids").alias("a_found")),
                                  "a_block"), "windows")
    near = _pass(blocks, count, anchors, _search(negatives, positives, low, high), negatives, "negatives")
    return anchors.select("a_block", "a_ids", "a_scores", "a_found").join(near, "a_block").mapInArrow(
        _rows_out(positives, negatives), "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")


def oracle() -> str:
    return f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
      list_sum(list_transform(list_zip(a.q, b.q, true), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}"""
