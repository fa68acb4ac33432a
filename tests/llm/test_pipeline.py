"""Every stored stage of the pipeline against a brute-force version on the same input."""

from collections import Counter

import pytest

import corpus_pipeline
from quireflow.llm import quality
from quireflow.llm.common import load, remainder, stored
from tests.llm.test_operators import _contamination, brute_classes, repeats, words

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def layers(spark):
    """The rows before the first stage and after each one."""
    docs = load(spark, FOLDER, "documents")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        found.append((name, docs))
    return {name: df for name, df in found}


def rows(df):
    assert df.columns == COLUMNS
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_quality_walks_every_row(spark, layers, folder):
    docs = load(spark, folder, "documents")
    labels = load(spark, folder, "labels").filter(remainder("doc_id", 3) != 1)
    trees = quality.fit(quality.features(docs), labels)
    stats = dict(quality.features(docs).select("doc_id", "stats").collect())
    kept = []
    for r in rows(docs):
        row, total = quality._matrix([stats[r[0]]])[0].tolist(), trees.start
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        if total >= 0:
            kept.append(r)
    after = layers["quality"] if folder == FOLDER else corpus_pipeline.quality(spark, docs, folder)
    assert Counter(rows(after)) == Counter(kept)
    marks = {r.doc_id: r.quality for r in load(spark, folder, "labels").collect()}
    good, bad = ([r[0] for r in rows(docs) if marks.get(r[0]) == q] for q in (1, 0))
    ids = {r[0] for r in kept}
    assert len(ids.intersection(good)) >= 0.98 * len(good)
    if folder != FOLDER:  # the smallest table has too few labels to learn bad ones from
        assert len(ids.intersection(bad)) <= 0.1 * len(bad)


def test_near_dedup_by_all_pairs(layers):
    before = rows(layers["quality"])
    classes = brute_classes([(r[0], r[1]) for r in before])
    least = {}
    for i, c in classes.items():
        least[c] = min(i, least.get(c, i))
    assert Counter(rows(layers["near_dedup"])) == Counter(r for r in before if least[classes[r[0]]] == r[0])


def test_substring_dedup_by_all_windows(layers):
    before = rows(layers["near_dedup"])
    gone = {i: n for i, _, n, _ in repeats([(r[0], r[1]) for r in before])}
    after = {r[0]: r for r in rows(layers["substring_dedup"])}
    assert len(after) == len(before) and set(after) == {r[0] for r in before}
    for r in before:
        now = after[r[0]]
        if gone[r[0]]:
            assert len(words(now[1])) == len(words(r[1])) - gone[r[0]] and now[4] == len(now[1])
            assert now[2:4] == r[2:4]
        else:
            assert now == r


def test_contaminated_documents_go(spark, layers):
    before = rows(layers["substring_dedup"])
    items = [tuple(r) for r in load(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    hit = {i for i, n, h, _ in _contamination([(r[0], r[1]) for r in before], items) if h and 20 * h >= n}
    assert Counter(rows(layers["decontaminate"])) == Counter(r for r in before if r[0] not in hit)


def test_mix_takes_whole_rows_near_the_targets(layers):
    before, taken = rows(layers["decontaminate"]), Counter(rows(layers["mix"]))
    assert set(taken) <= set(before) and max(taken.values()) <= 3
    sizes, largest = Counter(), 0
    for r in before:
        sizes[r[3]] += len(words(r[1]))
        largest = max(largest, len(words(r[1])))
    got = Counter()
    for r, n in taken.items():
        got[r[3]] += n * len(words(r[1]))
    # The targets again: shares by weight, what is above three times a source's size dealt anew.
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while True:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share > 3 * sizes[s]}
        if not full:
            break
        target |= {s: 3 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    target |= {s: weight[s] * share for s in open_}
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(got[s] - target[s]) <= 3 * largest for s in order)
