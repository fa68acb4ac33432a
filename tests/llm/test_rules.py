"""Quality rules: counts against a plain version, learning on its own, odd rows, held-out accuracy."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quireflow.llm import catalog, rules
from quireflow.llm.common import load, remainder
from tests.llm.test_operators import ODD, SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [r[1] for r in ODD] + [
    "a b c d e f a b c d e", "x " * 40, "one\none\n\n \none\r\none\n two", "# $$ *|< >&% #", "a b c d e\na b c d e f",
    "É É É É É É", "UPPER lower 123! what?", "\x1c\x85\xa0 a\x0bb\x0cc", "a b c d\na b c d", None, "",
]


def plain(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)} if len(ws) < 3000 else None
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": None if covered is None else len(covered),
        "n_lines": len(lines), "n_upper": len(re.findall("[A-Z]", text)), "n_digits": len(re.findall("[0-9]", text)),
        "n_marks": len(re.findall("[!?]", text)), "n_marked_words": sum(w[-1] in "#*$%&|<>!?" for w in ws),
        "n_short_words": sum(len(w) <= 3 for w in ws), "n_distinct_words": len(set(ws)), "longest_word": max(map(len, ws), default=0),
    }


def test_counts_against_plain_python():
    texts = pa.array(TEXTS)
    for at in (0, 3, 9):
        got = rules.counts(texts.slice(at))
        for i, text in enumerate(TEXTS[at:]):
            for name, want in plain(text).items():
                if want is not None:
                    assert got[name][i] == want, (name, text[:80])


def test_counts_on_real_texts(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in rules.measure(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        for name, want in plain(r.text).items():
            assert want is None or got[r.doc_id][f"__{name}"] == want, (name, r.doc_id)


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(rules, "_PRIMES", (np.uint64(0), np.uint64(0)))  # every window has the same hash
    ids, lengths = np.array([1, 2, 3, 1, 2, 3, 4, 1, 2, 1, 2, 3]), np.array([7, 5])
    got = rules.repeated(ids, lengths, window=2)
    assert got.tolist() == [True] * 6 + [False] + [True] * 4 + [False]


def test_learned_list_follows_the_labels():
    rng = np.random.default_rng(8)
    names = list(rules.RATIOS)
    rows = rng.random((3000, len(names)))
    symbols, upper, length = (names.index(x) for x in ("symbols_per_word", "upper_share", "word_length"))
    bad = (rows[:, symbols] > 0.9) | ((rows[:, upper] > 0.8) & (rows[:, length] <= 0.3))
    found = rules.learn(rows, bad)
    dropped = np.any([rules._covers(r, rows) for r in found], axis=0)
    assert (dropped == bad).mean() > 0.99 and not (dropped & ~bad).mean() > 0.005
    assert {c.name for r in found for c in r} >= {"symbols_per_word", "upper_share", "word_length"}
    assert rules.learn(rows, bad) == found


@pytest.mark.parametrize("bad", [np.zeros(50, bool), np.ones(50, bool), np.zeros(0, bool)])
def test_nothing_to_learn(bad):
    assert rules.learn(np.zeros((len(bad), len(rules.RATIOS))), bad) == []


def test_noise_gives_no_rule():
    rng = np.random.default_rng(2)
    assert rules.learn(rng.random((900, len(rules.RATIOS))), rng.random(900) < 0.3) == []


def test_expression_agrees_with_arrays(spark):
    """The emitted branches, in order, say what the learned conditions say."""
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    made = [(rules.Condition("words", True, 300.5), rules.Condition("word_length", False, 5.5)),
            (rules.Condition("distinct_words", False, 0.5),)]
    measured = rules.measure(docs)
    rows = rules.judged(measured, made).select(
        "*", *[rules.statistic(s).alias(f"stat_{s}") for s in rules.RATIOS]).collect()
    values = np.array([[r[f"stat_{s}"] for s in rules.RATIOS] for r in rows])
    hit = [rules._covers(r, values) for r in made]
    want = np.where(hit[0], 1, np.where(hit[1], 2, 0))
    for r, number in zip(rows, want):
        failed = r["__n_words"] < 10 or 100 * r["__n_repeat_words"] > 20 * r["__n_words"]
        assert r["__base_failed"] == failed and r["__rule"] == (0 if failed else number)
        assert r["__kept"] == (not failed and number == 0)
    assert rules.describe(made)[0] == "words > 300.5 and word_length <= 5.5"


def test_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    clash = odd.withColumns({"__n_words": F.lit("mine"), "__kept": F.lit(1), "__row": F.lit(2)})
    kept = rules.keep_good(clash, [])
    assert kept.columns == clash.columns
    want = [r for r in ODD if (p := plain(r[1]))["n_words"] >= 10 and (p["n_repeat_words"] is not None)
            and 100 * p["n_repeat_words"] <= 20 * p["n_words"]]
    assert sorted(str(r.text) for r in kept.collect()) == sorted(str(r[1]) for r in want)
    assert rules.keep_good(odd.limit(0), []).count() == 0
    labels = spark.createDataFrame([(1, None), (1, 0), (1, 1), (1, 0), (None, 0)], "doc_id long, quality int")
    assert rules.fit(rules.measure(odd), labels) == []
    assert rules.fit(rules.measure(odd.limit(0)), labels.limit(0)) == []


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    verdicts = catalog.op12_quality_rules(spark, d).where(remainder("doc_id", 3) == 1)
    labels = load(spark, d, "labels").where("quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    # Of the rows that the base rule leaves, hardly one is judged otherwise than labelled.
    rows = verdicts.where("NOT base_failed").join(labels, "doc_id").collect()
    assert len(rows) > 1000 and np.mean([r.kept == r.good for r in rows]) > 0.99
    assert np.mean([r.kept for r in rows if r.good]) > 0.995
