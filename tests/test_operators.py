"""Operators on small tables written by hand, checked against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.functions import bitmaps, events, hashing, text, vectors
from quireflow.operators import (
    classify, embed, encode, evaluate, gate, labels, prepare, ranking, registry, score, sequences,
    splits, tabular,
)
from quireflow import contracts


def pages(spark, rows):
    return spark.createDataFrame(rows, "text string, label string, dcn string, page double")


# ---- dedup ----------------------------------------------------------------------------

def test_bronze_keeps_first_of_each_text_and_label(spark):
    rows = [("t", "a", "d2", 1.0), ("t", "a", "d1", 2.0), ("t", "b", "d3", 1.0), ("t", None, "d4", 1.0),
            ("t", None, "d3", 9.0), (None, "a", "d5", 1.0), ("", "a", "d6", 1.0)]
    got = {tuple(r) for r in prepare.bronze(pages(spark, rows)).collect()}
    assert got == {("t", "a", "d1", 2.0), ("t", "b", "d3", 1.0), ("t", None, "d3", 9.0), ("", "a", "d6", 1.0)}


def test_bronze_keeps_texts_where_they_are(spark):
    rows = [("t", "a", "d", float(i)) for i in range(5)] + [("t", "a", "d", 0.0), ("u", "b", "d", 1.0)]
    kept = prepare.bronze(pages(spark, rows[:5] + rows[6:]))
    assert sorted(r.page for r in kept.collect()) == [0.0, 1.0]
    assert "Exchange hashpartitioning(_d" not in physical(kept)  # few repeats: not even these travel
    assert sorted(r.page for r in prepare.bronze(pages(spark, rows)).collect()) == [0.0, 1.0]  # a row that repeats whole


def test_bronze_against_a_dict(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["hot", f"t{rnd.randint(0, 60)}", f"own {i}", None]), rnd.choice(["a", "b", None]),
             rnd.choice(["d1", "d2", None]), rnd.choice([1.0, 2.0, None])) for i in range(900)]
    least = lambda r: (r[2] is not None, r[2] or "", r[3] is not None, r[3] or 0.0)
    want = {}
    for r in rows:
        if r[0] is not None and (r[:2] not in want or least(r) < least(want[r[:2]])):
            want[r[:2]] = r
    got = [tuple(r) for r in prepare.bronze(pages(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want.values()))
    assert prepare.bronze(pages(spark, rows[:1] * 0)).collect() == []
    swapped = prepare.bronze(pages(spark, rows).select("page", "dcn", "label", "text"), order=("page",))
    assert swapped.columns == ["page", "dcn", "label", "text"] and swapped.count() == len(want)


def _text_exchanges(plan):
    """Exchanges that move texts between tasks, and whether the filter stands below each."""
    found, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        below = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "text#" in node.output().toString():
            found.append("_bitmap" in node.toString() and "Filter" in node.toString())
        nodes += below
    return found


def test_only_suspects_travel(spark):
    """With broadcast joins off: a text without a copy is in no exchange, however many copies
    others have."""
    rows = [("hot", "a", "d", float(i)) for i in range(5000)] + [(f"own {i}", "a", "d", float(i)) for i in range(3000)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        kept = prepare.bronze(pages(spark, rows))
        moved = _text_exchanges(kept._jdf.queryExecution().executedPlan())
        assert moved and all(moved) and kept.count() == 3001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("items, bits", [(0, 1 << 15), (2048, 1 << 15), (2049, 1 << 16), (10**12, 1 << 29)])
def test_bitmap_size_has_a_bound(items, bits):
    assert bitmaps.size_for(items) == bits


def test_bitmap_has_all_its_items(spark):
    made = spark.range(40_000).select(F.xxhash64("id").alias("code"), "id")
    bits = bitmaps.size_for(20_000)
    asked = bitmaps.marked(made, F.col("code"), bitmaps.build(made.where("id % 2 = 0"), "code", bits), bits)
    hits = {r["even"]: r["hits"] for r in asked.groupBy((F.col("id") % 2 == 0).alias("even")).agg(
        F.sum(F.col("_hit").cast("int")).alias("hits")).collect()}
    assert hits[True] == 20_000 and hits[False] < 20_000 / 14
    assert asked.columns == ["code", "id", "_hit"]


# ---- chunk numbers --------------------------------------------------------------------

def test_shared_pages_number_through(spark):
    rnd = random.Random(1)
    rows = [(i, "hot" if i % 3 else f"d{i}", 1.0, " ".join("w" * rnd.randint(0, 90)), "l") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, dcn string, page double, text_processed string, label string")
    got = prepare.gold_shared(df, "id", 10, 2, full_split=True, drop_empty=True).collect()
    per_page = {}
    for r in got:
        per_page.setdefault(r.dcn, []).append(r["index"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_page.values())
    assert len(got) == sum(-(-len(t.split()) // 8) for _, _, _, t, _ in rows)
    # A row's chunks are neighbours, in text order.
    by_row = {}
    for r in got:
        by_row.setdefault(r.id, []).append(r["index"])
    assert all(max(v) - min(v) == len(v) - 1 for v in by_row.values())


def test_full_split_keeps_every_word(spark):
    rows = [(f"d{n}", 1.0, " ".join(f"w{i}" for i in range(n)), "l") for n in (0, 1, 149, 150, 151, 200, 299, 300, 1000)]
    df = spark.createDataFrame(rows, "dcn string, page double, text_processed string, label string")
    got = prepare.gold(df, 200, 50, full_split=True, drop_empty=True).collect()
    for dcn, _, whole, _ in rows:
        parts = [r.text_chunk.split() for r in sorted(got, key=lambda r: r["index"]) if r.dcn == dcn]
        assert all(parts) and {w for p in parts for w in p} == set(whole.split())


def test_global_index(spark):
    df = spark.createDataFrame([(random.Random(i).random() < 0.4, i) for i in range(1000)], "hot boolean, i int")
    got = ranking.global_index(df.repartition(5), F.col("hot").desc(), "i").collect()
    want = sorted(((r.hot, r.i) for r in got), key=lambda t: (not t[0], t[1]))
    assert [(r.hot, r.i) for r in sorted(got, key=lambda r: r.idx)] == want
    assert sorted(r.idx for r in got) == list(range(1000))


# ---- labels ---------------------------------------------------------------------------

def test_label_index_orders_by_count_then_name(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "b", "a", "a", "c", None]], "label string")
    want = {"a": 0, "b": 1, "c": 2}
    found = labels.label_index(df)
    assert {r.label: r.label_id for r in found.collect()} == want
    ids = spark.createDataFrame([(2,), (0,), (9,)], "i int")
    assert {r.i: r.name for r in labels.decode_label(ids, found, "i", "name").collect()} == {2: "c", 0: "a", 9: None}


def test_unseen_and_null_labels_drop_out(spark):
    known = labels.label_index(spark.createDataFrame([("a",), ("b",)], "label string"))
    rows = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "label string, i int")
    joined = labels.attach_label_id(rows, known)
    assert [(r.i, r.label_id) for r in joined.collect()] == [(1, 0)]


def physical(df):
    plan = df._jdf.queryExecution().toString()
    return plan[plan.index("== Physical"):]


def test_params_stay_rows(spark):
    rows = [(1, "a", "x"), (1, "b", "y"), (2, "a", "z"), (2, "a", "zz")] + [(3, f"k{i}", "v") for i in range(2000)]
    df = spark.createDataFrame(rows, "run_id int, key string, value string")
    assert registry.run_params(df).count() == 2003
    assert registry.params_of(df, 1) == {"a": "x", "b": "y"} and registry.params_of(df, 2) == {"a": "zz"}


# ---- encoding -------------------------------------------------------------------------

def test_encode(spark):
    df = spark.createDataFrame([(1, "x y x z"), (2, ""), (3, None), (4, "x y z x y")], "i int, t string")
    tokens = text.words(F.col("t"))
    vocab = encode.vocabulary(df.where("i = 1"), tokens)
    assert {r.token: r.token_id for r in vocab.collect()} == {"x": 4, "y": 5, "z": 6}
    vocab = vocab.where("token <> 'z'")
    got = {r.i: (r.input_ids, r.attention_mask) for r in encode.encode(df, ["i"], tokens, vocab, 6).collect()}
    assert got[1] == ([2, 4, 5, 4, 1, 3], [1] * 6)
    assert got[2] == got[3] == ([2, 3, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0])
    assert got[4] == ([2, 4, 5, 1, 4, 3], [1] * 6)


# ---- splits ---------------------------------------------------------------------------

def test_split_is_a_stable_partition(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = {r.k: r.split for r in splits.with_split(df, "k").collect()}
    two = {r.k: r.split for r in splits.with_split(df.where("k < 100").repartition(3), "k").collect()}
    assert all(one[k] == v for k, v in two.items())
    share = {s: sum(v == s for v in one.values()) / 5000 for s in ("train", "val", "test")}
    assert sum(share.values()) == 1 and abs(share["train"] - 0.9) < 0.02 and abs(share["val"] - 0.05) < 0.02
    other = {r.k: r.split for r in splits.with_split(df, "k", seed=7).collect()}
    assert other != one


# ---- vectors and sequences ------------------------------------------------------------

def test_argmax_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([5.0],)], "v array<double>")
    assert [r.a for r in df.select(vectors.argmax(F.col("v")).alias("a")).collect()] == [1, 0]


def test_softmax_survives_large_scores(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 0.0],)], "v array<double>")
    p = vectors.with_softmax(df, "v", "p").first().p
    assert p == [0.5, 0.5, 0.0]


def test_stack_in_segments_loses_nothing(spark):
    rows = [("hot", i, [float(i)]) for i in range(1, 1001)] + [("d", 2, [2.0]), ("d", 1, [1.0])]
    df = spark.createDataFrame(rows, "dcn string, i int, v array<double>").repartition(6)
    got = sequences.stack(df, ["dcn"], "i", "v", segment=64).orderBy("dcn", "segment").collect()
    assert [v for r in got if r.dcn == "hot" for v in r.emb] == [[float(i)] for i in range(1, 1001)]
    assert max(len(r.emb) for r in got) == 64
    assert [r.emb for r in got if r.dcn == "d"] == [[[1.0], [2.0]]]


def test_pad_batches(spark):
    rows = [(i, [[float(i), 0.0]] * (i % 4 + 1)) for i in range(10)]
    df = spark.createDataFrame(rows, "i int, seq array<array<float>>")
    got = {r.i: r for r in sequences.pad_batches(df, ["i"], "seq", dim=2, batch_size=4).collect()}
    assert len(got) == 10
    for i, r in got.items():
        batch = [j for j in range(10) if j // 4 == i // 4]
        longest = max(j % 4 + 1 for j in batch)
        assert (r.batch_id, r.timesteps, r.steps) == (i // 4, longest, i % 4 + 1)
        assert len(r.padded) == longest and all(p == [-99.0, -99.0] for p in r.padded[r.steps:])


def test_pool(spark):
    rows = [("a", 2, [1.0, 5.0]), ("a", 1, [3.0, 1.0]), ("b", 1, [0.0, -2.0])]
    df = spark.createDataFrame(rows, "k string, i int, v array<double>")
    got = {r.k: r for r in sequences.pool(df, ["k"], "v", order="i").collect()}
    assert (got["a"]["mean"], got["a"]["max"], got["a"]["first"], got["a"].vectors) == ([2.0, 3.0], [3.0, 5.0], [3.0, 1.0], 2)
    assert got["b"]["max"] == [0.0, -2.0]


def test_hashed_embedding_has_unit_length(spark):
    df = spark.createDataFrame([("x y x",), ("",)], "t string")
    a, b = [r.embedding for r in embed.hashed_embedding(df, text.words(F.col("t"))).collect()]
    assert len(a) == 256 and math.isclose(sum(x * x for x in a), 1.0, rel_tol=1e-6) and not any(b)


# ---- scoring --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def text_model(spark):
    rows = [(f"cats purr {i} softly", "cat", "d", float(i)) for i in range(8)]
    rows += [(f"dogs bark {i} loudly", "dog", "d", float(10 + i)) for i in range(6)]
    train = pages(spark, rows)
    return classify.fit_text_model(train, "text"), train


def test_every_row_is_scored_on_all_routes(spark, text_model):
    model, train = text_model
    odd = pages(spark, [("", "x", "e", 1.0), ("bark " * 900, "x", "e", 2.0)])
    everything = train.unionByName(odd)
    native = {
        (r.dcn, r.page): (r.pred_label, r.pred_score)
        for r in score.score_pages(everything.withColumnRenamed("text", "Request"), model).collect()
    }
    counted = score.count_arrays(classify.page_counts(everything, "text"))
    load = score.count_predictor(model)
    scored = score.score_by_partition(counted.repartition(3), ["dcn", "page"], "counts", load)
    rows = score.with_names(scored, model, "class_id", "Label").collect()
    assert all(r.ElapsedTime > 0 for r in rows)
    mapped = {(r.dcn, r.page): (r.Label, r.Score) for r in rows}
    called = counted.select("dcn", "page", score.score_column("counts", load, 256).alias("predictions"))
    rows = score.with_names(score.unpack_struct(called), model, "class_id", "pred_label").collect()
    assert all(r.pred_elapsed_time > 0 for r in rows)
    column = {(r.dcn, r.page): (r.pred_label, r.pred_score) for r in rows}
    assert set(native) == set(mapped) == set(column) and len(native) == 16
    for key, (label, p) in native.items():
        assert mapped[key][0] == column[key][0] == label
        assert math.isclose(mapped[key][1], p, rel_tol=1e-5) and math.isclose(column[key][1], p, rel_tol=1e-9)
    assert native[("e", 2.0)][0] == "DOG" and native[("e", 1.0)][0] == "CAT"


def test_first_pooling_reads_one_chunk(spark):
    df = pages(spark, [(" ".join(["word"] * 700), "x", "d", 1.0)])
    sizes = [
        classify.page_tokens(df, "text", pooling=p).select(F.size("tokens").alias("n")).first().n
        for p in ("all", "first")
    ]
    assert sizes == [4 * 200 + 100, 200]


def test_nearest_centroid_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 5)).astype("float32")
    y = rng.integers(0, 4, size=200)
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(200)], "i int, y int, v array<float>")
    model = classify.fit_centroids(df, "y", "v")
    got = {r.i: r.predicted for r in classify.classify_by_centroid(df, model, "v").collect()}
    c = np.stack([x[y == k].astype("float64").mean(axis=0) for k in range(4)])
    want = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert got == dict(enumerate(want.tolist()))


def _nearest(x, c, scale=1.0):
    scores = -((x[:, None, :] - c[None]) ** 2).sum(axis=2) * scale
    shifted = np.exp(scores - scores.max(axis=1)[:, None])
    return scores.argmax(axis=1), shifted / shifted.sum(axis=1)[:, None]


@pytest.mark.parametrize("classes, rows, scale", [(1024, 4096, 1.0), (1, 3, 1.0), (3, 50, 1000.0)])
def test_nearest_class_in_blocks(spark, monkeypatch, classes, rows, scale):
    monkeypatch.setattr(classify, "CLASSES", classes)
    monkeypatch.setattr(classify, "ROWS", rows)
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(120, 3)), rng.integers(0, 7, size=120)
    data = [(i, f"c{y[i]}", x[i].tolist(), 1) for i in range(120)]
    odd = [(200, None, x[0].tolist(), 1), (201, "c1", None, 1), (202, "unseen", x[1].tolist(), 1)]
    schema = "i int, y string, v array<double>, own int"
    model = classify.fit_centroids(spark.createDataFrame(data, schema), "y", "v")
    rows_ = classify.nearest_class(spark.createDataFrame(data + odd, schema), model, "v", "y", scale).collect()
    got = {r.i: r for r in rows_}
    c = np.stack([x[y == k].mean(axis=0) for k in range(7)])
    best, p = _nearest(x, c, scale)
    assert len(rows_) == 123 and [got[i].predicted for i in range(120)] == [f"c{b}" for b in best]
    assert np.allclose([got[i].probability for i in range(120)], p.max(axis=1))
    true = np.maximum(p[np.arange(120), y], 1e-300)
    assert np.allclose([min(got[i].loss, 600) for i in range(120)], np.minimum(-np.log(true), 600))
    assert got[200].predicted == got[0].predicted and got[200].loss is None and got[202].loss is None
    assert (got[201].predicted, got[201].loss) == (None, None)


def test_nearest_of_fifty_thousand_classes(spark, monkeypatch):
    """The class vectors stay a table of blocks; nobody collects them."""
    monkeypatch.setattr(classify, "SCORES_BYTES", 1 << 20)
    rng = np.random.default_rng(5)
    c = rng.normal(size=(50_000, 4)).astype("float32").astype("float64")
    known = spark.createDataFrame([(f"{k:05d}", v.tolist()) for k, v in enumerate(c)], "y string, v array<double>")
    model = classify.fit_centroids(known, "y", "v")
    assert model.classes == 50_000 and model.blocks.count() == 49
    with pytest.raises(ValueError, match="nearest_class"):
        model.scores("v")
    x = rng.normal(size=(300, 4))
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    got = {r.i: r for r in classify.nearest_class(asked, model, "v").collect()}
    best, p = _nearest(x, c)
    assert [got[i].predicted for i in range(300)] == [f"{b:05d}" for b in best]
    assert np.allclose([got[i].probability for i in range(300)], p.max(axis=1))


def test_linear_steps_against_numpy(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(90, 3)).astype("float32"), rng.integers(0, 3, 90)
    split = ["train" if i % 3 else "val" for i in range(90)]
    df = spark.createDataFrame([(x[i].tolist(), int(y[i]), split[i]) for i in range(90)], "v array<float>, y int, split string")
    model = classify.fit_linear(df.repartition(4), "v", "y", 3, epochs=4, rate=0.5)
    w, ones = np.zeros((3, 4)), np.hstack([x.astype(float), np.ones((90, 1))])
    train = np.array([s == "train" for s in split])
    for epoch in range(5):
        p = np.exp(ones @ w.T)
        p /= p.sum(axis=1, keepdims=True)
        loss = -np.log(p[np.arange(90), y])
        seen = {s: (n, loss_s) for e, s, n, _, loss_s in model.history if e == epoch}
        assert seen["train"] == (60, pytest.approx(loss[train].mean())) and seen["val"] == (30, pytest.approx(loss[~train].mean()))
        if epoch < 4:
            w -= 0.5 * ((p - np.eye(3)[y])[train].T @ ones[train]) / 60
    assert np.allclose(w, model.weights)
    rows = classify.linear_metrics(spark, model, "r").collect()
    assert len(rows) == 5 * 2 * 2
    got = [r.prediction for r in classify.linear_scores(df, model, "v").collect()]
    assert got == (ones @ w.T).argmax(axis=1).tolist()


# ---- evaluation -----------------------------------------------------------------------

def test_report_with_missing_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    pairs = evaluate.confusion(df, "y", "p")
    got = {r.cls: (r.precision, r.recall, r.f1, r.support) for r in evaluate.class_report(pairs).collect()}
    assert got["a"] == (1.0, 0.5, 2 / 3, 2.0)
    assert got["b"] == (1 / 3, 1.0, 0.5, 1.0)
    assert got["c"] == (0.0, 0.0, 0.0, 1.0)
    assert got["accuracy"] == (0.5, 0.5, 0.5, 0.5)
    assert got["macro avg"] == pytest.approx(((1 + 1 / 3) / 3, 0.5, (2 / 3 + 0.5) / 3, 4.0))
    assert got["weighted avg"] == pytest.approx(((2 + 1 / 3) / 4, 0.5, (4 / 3 + 0.5) / 4, 4.0))
    listed = spark.createDataFrame([("a",), ("b",), ("c",), ("never",)], "cls string")
    more = {r.cls: r.support for r in evaluate.class_report(pairs, listed).collect()}
    assert more["never"] == 0.0 and more["micro avg"] == 4.0 and "accuracy" not in more


def test_confusion_share_sums_to_one_per_actual(spark):
    df = spark.createDataFrame([(i % 3, (i * i) % 3) for i in range(50)], "y int, p int")
    shares = evaluate.confusion_share(evaluate.confusion(df, "y", "p")).groupBy("actual").agg(F.sum("share").alias("s"))
    assert all(math.isclose(r.s, 1.0) for r in shares.collect())


def test_batched_loss_is_a_mean_of_means(spark):
    df = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, 3.0), (1, 1, 1, 10.0)], "b int, y int, p int, l double")
    r = evaluate.accuracy_and_loss(df, "y", "p", "l", batch="b").first()
    assert r.acc == pytest.approx(2 / 3) and r.loss == 6.0


def test_loss_of_a_vanishing_probability(spark):
    df = spark.createDataFrame([([0.0, -5000.0], 1), ([0.0, 0.0], 0)], "s array<double>, y int")
    assert [round(r.l, 6) for r in df.select(evaluate.cross_entropy("s", "y").alias("l")).collect()] == [5000.0, round(math.log(2), 6)]


def test_regression_metrics_count_gaps_apart(spark):
    rows = [("a", 1.0, 3.0), ("a", 2.0, None), ("a", 4.0, 4.0), ("c", 5.0, 4.0), ("c", 5.0, 6.0), ("n", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, y double, p double")
    got = {r.k: r for r in evaluate.regression_metrics(df, "y", "p", "k").collect()}
    assert (got["a"].rows, got["a"].incomplete, got["a"].mse, got["a"].mae) == (2, 1, 2.0, 1.0)
    assert got["c"].r2 is None and got["c"].mse == 1.0 and got["n"].mse is None and got["n"].incomplete == 1


def test_wide_matrix_refuses_unlisted_classes(spark):
    pairs = evaluate.confusion(spark.createDataFrame([(1, 1), (2, 1)], "y int, p int"), "y", "p")
    assert evaluate.confusion_wide(pairs, [1, 2]).count() == 1
    with pytest.raises(Exception, match="outside the list"):
        evaluate.confusion_wide(pairs, [1]).collect()


# ---- registry -------------------------------------------------------------------------

def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame([
        ("m", "9", "Production", "r9", "READY"), ("m", "10", "Production", "r10", "READY"),
        ("m", "11", "Staging", "r11", "READY"), ("n", "1", "None", "r1", "READY"),
    ], "name string, version string, stage string, run_id string, status string")
    assert {r.name: r.version for r in registry.latest_versions(df).collect()} == {"m": "11", "n": "1"}
    assert registry.require_latest(df, "m", "Production").version == "10"
    with pytest.raises(LookupError):
        registry.require_latest(df, "n", "Production")


def test_transitions_replay_like_a_log(spark):
    """Brute force: apply the moves one by one."""
    rnd = random.Random(5)
    stages = ["None", "Staging", "Production", "Archived"]
    versions = [(f"m{i % 4}", str(i), rnd.choice(stages)) for i in range(40)]
    moves = []
    for k in range(120):
        name, version, _ = rnd.choice(versions)
        moves.append((name, version, rnd.choice(stages), k // 2, k, rnd.random() < 0.6))
    state = {(n, v): s for n, v, s in versions}
    for name, version, to, _, _, archive in sorted(moves, key=lambda m: (m[3], m[4])):
        if archive and to in ("Staging", "Production"):
            for key in state:
                if key[0] == name and key[1] != version and state[key] == to:
                    state[key] = "Archived"
        state[(name, version)] = to
    got = registry.apply_transitions(
        spark.createDataFrame(versions, "name string, version string, stage string"),
        spark.createDataFrame(moves, "name string, version string, to_stage string, ts int, move_id int, archive_existing boolean"),
    ).collect()
    assert {(r.name, r.version): r.stage for r in got} == state


def test_event_messages(spark):
    rows = [
        ('{"event":"MODEL_VERSION_TRANSITIONED_STAGE","model_name":"m","version":"3","to_stage":"Staging"}', "payload", "Staging", 4, "accepted"),
        ('{"event":"MODEL_VERSION_TRANSITIONED_STAGE","model_name":"m","version":"3"}', "invalid", None, None, "no stage"),
        ('{"event":"MODEL_VERSION_TRANSITIONED_STAGE","model_name":"m","version":"3","to_stage":"Attic"}', "payload", "Attic", None, "stage without target"),
        ('{"event":"OTHER","model_name":"m","version":"3","to_stage":"Production"}', "payload", "Production", None, "other event"),
        ("{}", "defaults", "S", None, "no event"),
        ("nonsense", "defaults", "S", None, "no event"),
        (None, "defaults", "S", None, "no event"),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, m string")
    df = df.withColumn("p", events.parse_message(F.col("m")))
    resolved = events.resolve_transition(F.col("p"), F.lit("d"), F.lit("0"), F.lit("S"))
    got = df.select("i", resolved.alias("r"), events.route(F.col("p")).alias("t")).orderBy("i").collect()
    assert [(g.r.origin, g.r.stage, g.t.target, g.t.reason) for g in got] == [r[1:] for r in rows]


# ---- gate -----------------------------------------------------------------------------

def test_gate_rejects_lost_rows_and_bad_scores(spark):
    given = pages(spark, [("a", "l", "d", 1.0), ("b", "l", "d", 2.0)])
    schema = "dcn string, page double, pred_label string, pred_score double, pred_elapsed_time double"
    good = spark.createDataFrame([("d", 1.0, "L", 0.4, 1.0), ("d", 2.0, "L", 1.0, 1.0)], schema)
    bad = spark.createDataFrame([("d", 1.0, None, 1.4, 1.0), ("d", 1.0, "L", 0.4, 1.0)], schema)
    names = ["schema", "not_empty", "rows_kept", "no_extra_rows", "labels_present", "scores_in_range"]

    def run(scored):
        checks = gate.check_rows(given, scored, contracts.PREDICTION_COLUMNS, ["dcn", "page"])
        return {r.check: r.ok for r in checks.collect()}, gate.decide(checks, "Production").first().decision

    assert run(good) == (dict.fromkeys(names, True), "approve")
    checks, decision = run(bad)  # as many rows as given, but one lost and one doubled
    assert decision == "reject" and [k for k, ok in checks.items() if ok] == ["schema", "not_empty"]
    contract = T.StructType([*given.select("dcn", "page").schema.fields, *contracts.PREDICTION_COLUMNS.fields])
    none = gate.predictions_or_empty(spark, lambda: good.withColumn("page", F.raise_error(F.lit("x")).cast("double")), contract)
    assert run(none)[1] == "reject" and gate.is_empty(none)
    assert gate.predictions_or_empty(spark, lambda: good, contract).count() == 2
    assert run(good.drop("pred_score"))[0]["schema"] is False


# ---- tabular --------------------------------------------------------------------------

def test_unseen_category_is_all_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([("b",), ("a",)], "c string")
    model = Pipeline(stages=tabular.one_hot_stages(["c"])).fit(train)
    out = model.transform(spark.createDataFrame([("a",), ("b",), ("z",)], "c string"))
    assert [r.v for r in out.select(vector_to_array("c_hot").alias("v")).collect()] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_standardise_and_parse(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = tabular.standardise(df, tabular.scale_params(df, ["a", "b"])).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]
    assert tabular.as_bool("True") and not tabular.as_bool("False")
    got = tabular.coerce_numeric(spark.createDataFrame([("1.5",), ("x",), (None,)], "a string"), ["a"]).collect()
    assert [r.a for r in got] == [1.5, None, None]


def test_exact_median(spark):
    for values, want in [([5.0, 1.0, 3.0], 3.0), ([4.0, 1.0, 2.0, 2.5], 2.25), ([None, 7.0], 7.0), ([None], None)]:
        df = spark.createDataFrame([(v,) for v in values], "a double")
        assert tabular.exact_median(df, "a") == want
    assert [r.a for r in tabular.impute_exact_median(df, df, ["a"]).collect()] == [None]


def test_forest_takes_logged_parameters(spark):
    rows = [(float(i % 10), "ab"[i % 2], str(i % 7) if i % 5 else "?", 10.0 * (i % 10) + (i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, kind string, y string, price double")
    params = {
        "preprocessor__numerical__imputer__strategy": "median", "preprocessor__onehot__handle_unknown": "ignore",
        "preprocessor__remainder": "passthrough", "regressor__bootstrap": "False", "regressor__max_depth": "6",
        "regressor__max_features": "1.0", "regressor__min_samples_leaf": "0.001",
        "regressor__n_estimators": "3", "regressor__random_state": "1",
    }
    model = tabular.retrain(df, params, ["y"], ["kind"], "price", passthrough=["x"])
    scored = model.transform(tabular.coerce_numeric(df, ["y"])).withColumn("split", F.lit("all"))
    r = evaluate.regression_metrics(scored, "price", "prediction", "split").first()
    assert r.rows == 200 and r.r2 > 0.95 and r.rmse == pytest.approx(math.sqrt(r.mse))
    forest = model.stages[-1]
    assert forest.getNumTrees == 3 and forest.getOrDefault("bootstrap") is False
    # The passed-through column is part of the input, the dropped one is not.
    narrow = tabular.retrain(df, {**params, "preprocessor__remainder": "drop"}, ["y"], ["kind"], "price", passthrough=["x"])
    assert model.stages[-1].numFeatures == narrow.stages[-1].numFeatures + 1


def test_walked_forest_is_the_fitted_one(spark):
    rows = [(i, float(i % 13), "abc"[i % 3], float(i * 7 % 31), float((i * i) % 101) + 5.0 * (i % 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, x double, kind string, z double, price double")
    params = {
        "preprocessor__numerical__imputer__strategy": "mean", "preprocessor__onehot__handle_unknown": "ignore",
        "regressor__bootstrap": "True", "regressor__max_depth": "5", "regressor__max_features": "0.7",
        "regressor__min_samples_leaf": "0.001", "regressor__n_estimators": "7", "regressor__random_state": "3",
    }
    model = tabular.retrain(df, params, ["x", "z"], ["kind"], "price")
    nodes = tabular.forest_nodes(spark, model.stages[-1])
    assert nodes.count() == sum(t.numNodes for t in model.stages[-1].trees)
    assert nodes.where("(feature IS NULL) <> (left IS NULL) OR left >= right").count() == 0
    scored = model.transform(df)
    expected = {r.k: r.prediction for r in scored.select("k", "prediction").collect()}
    walked = tabular.walk_forest(nodes, scored.drop("prediction"), "k", depth=5).collect()
    assert len(walked) == len(expected)
    assert all(r.prediction == pytest.approx(expected[r.k], abs=1e-9) and len(r.leaves) == 7 for r in walked)
    assert tabular.walk_forest(nodes, scored.limit(0), "k", depth=5).count() == 0


def test_bucket_depends_on_key_only(spark):
    df = spark.range(10)
    a = [r.b for r in df.select(hashing.stable_bucket(7, "id").alias("b")).collect()]
    b = [r.b for r in df.repartition(4).orderBy("id").select(hashing.stable_bucket(7, "id").alias("b")).collect()]
    assert a == b and all(0 <= x < 7 for x in a)
