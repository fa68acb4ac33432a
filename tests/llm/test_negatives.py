"""Hard negatives: odd rows, and the whole search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, anchor boolean, block int"


def brute(rows, positives=5, negatives_=5):
    """Every score of every anchor, in plain Python."""
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label, *_ in rows
              if label is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    first = lambda found, k: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1]))[:k]
    out = []
    for i, q, label in usable:
        if i is None or i % 100:
            continue
        others = [(sum(a * b for a, b in zip(q, v)), j, other) for j, v, other in usable if j != i]
        for ps, pid, _ in first([o for o in others if o[2] == label], positives):
            near = [o for o in others if o[2] != label and 80 * ps <= 100 * o[0] <= 100 * ps]
            out += [(i, pid, r, nid, ps, ns) for r, (ns, nid, _) in enumerate(first(near, negatives_), 1)]
    return sorted(out, key=str)


def found(df, **kw):
    return sorted((tuple(r) for r in negatives.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()), key=str)


def table(n, dims, seed, labels=3, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    return [(i, [float(x) for x in (centre[i % labels] + spread * rng.normal(size=dims)).astype(np.float32)], i % labels,
             1, True, 7) for i in range(n)]


@pytest.mark.parametrize("rows, anchors", [(2048, 256), (64, 2), (1, 1)])
def test_blocks_change_nothing(spark, monkeypatch, rows, anchors):
    monkeypatch.setattr(negatives, "ROWS", rows)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    data = table(130 if rows == 1 else 900, 6, seed=rows)
    df = spark.createDataFrame(data, SCHEMA)
    want = brute(data)
    assert want and found(df) == want


def test_odd_rows(spark):
    data = table(250, 5, seed=4) + [
        (300, None, 1, 1, True, 7), (400, [1.0, None, 0.0, 0.0, 0.0], 1, 1, True, 7), (500, [float("nan")] * 5, 1, 1, True, 7),
        (600, [float("inf")] * 5, 2, 1, True, 7), (700, [1.0] * 5, None, 1, True, 7), (None, [0.5] * 5, 0, 1, True, 7),
        (None, [0.5] * 5, 1, 1, True, 7), (800, [], 1, 1, True, 7), (900, [0.0] * 5, 0, 1, True, 7),
        (1000, [1.0, 1.0], 1, 1, True, 7), (1001, [1.0] * 9, 1, 1, True, 7), (-200, [2.0, -1.0, 0.5, 3.0, -2.0], 2, 1, True, 7),
    ]
    assert found(spark.createDataFrame(data, SCHEMA)) == brute(data)


def test_ties_and_copies(spark):
    """A third of the rows is one vector, under two labels: ids decide."""
    same = [(i, [0.5, -0.25, 1.0], i % 2, 1, False, 0) for i in range(0, 600)]
    data = same + [(1000 + i, [0.5, -0.25, 0.9 - i / 1000], i % 2, 1, False, 0) for i in range(300)]
    got = found(spark.createDataFrame(data, SCHEMA))
    assert got == brute(data) and [r[3] for r in got if r[0] == 100 and r[1] == 0] == [1, 3, 5, 7, 9]


def test_rows_that_share_an_id(spark):
    data = table(120, 4, seed=9) + [(100, [0.4, 0.1, 0.3, 0.2], 1, 1, True, 7), (50, [0.9, 0.9, 0.9, 0.9], 0, 1, True, 7)]
    assert found(spark.createDataFrame(data, SCHEMA)) == brute(data)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0, 1, True, 7)], [(100, [1.0], 0, 1, True, 7)]])
def test_too_few_rows(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == []


def test_search_stops_before_the_end():
    """Where few rows stand out the lists are not read through."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-20, 20, (2000, 4))
    vectors[:10] = [200, 150, -180, 120]
    rows = negatives._Rows({
        "ids": np.arange(2000).tobytes(), "labels": np.zeros(2000, np.int64).tobytes(), "kind": "<i8", "dims": 4,
        "vectors": vectors.tobytes(), "lists": np.argsort(vectors, axis=0, kind="stable").T.astype("<i4").tobytes()})
    anchor = np.array([3, 1, -2, 2])
    met = 0
    best = negatives._NONE
    for fresh, scores, bound in negatives.rounds(rows, anchor):
        met += len(fresh)
        best = negatives._best(best, scores, fresh, 5)
        unseen = np.setdiff1d(np.arange(2000), fresh)
        if len(best[0]) == 5 and bound < best[0][-1]:
            break
    assert met < 200 and len(unseen) and best[1].tolist() == [0, 1, 2, 3, 4]
    scores, ids = negatives.positives_in(rows, anchor, -1, 0, 5)
    assert (scores == np.sort(vectors @ anchor)[::-1][:5]).all() and ids.tolist() == [0, 1, 2, 3, 4]


def test_scores_out_of_range_are_an_error(spark):
    data = [(100, [1e9], 0, 1, True, 7), (1, [1e9], 0, 1, True, 7)]
    with pytest.raises(Exception, match="beyond"):
        found(spark.createDataFrame(data, SCHEMA))
