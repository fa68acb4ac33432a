"""Source divergence: packing and runs on their own, odd rows, and the audit against brute force."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quireflow.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, docs long, p long, size long"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, least, top=50):
    docs = [(lang or "", source or "", terms(text)) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen, by_source = Counter(), defaultdict(Counter)
        for d in docs:
            if d[0] == lang:
                seen.update(set(d[2]))
                by_source[d[1]].update(d[2])
        kept = sorted(t for t, n in seen.items() if n >= least)

        def shares(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (size + 5 * len(kept)) for t in kept}

        q = shares(sum(by_source.values(), Counter()))
        p = {s: shares(c) for s, c in by_source.items()}
        for s, counts in by_source.items():
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in p if o != s]
            over = [(t, p[s][t] - q[t]) for t in kept if counts[t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(items[:limit], 1)]
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in divergence.audit(df, **kw).collect())


def row(text, lang="en", source="a"):
    return (1, text, lang, source, "clash", 5, 6, 7, 8)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    vocabulary = ["a", "Is", "wordword", "wordwords", "sixteen" * 2 + "xx", "seventeenletters", "x" * 17, "É" * 9, "über",
                  "x" * 33, "y" * 400, "你好", "日" * 30, "z" * 8, "z" * 9, "zzzzzzz"]
    rows = []
    for i in range(160):
        n = int(rng.integers(0, 30))
        text = rng.choice([" ", ", ", "\n", "1", "_"]).join(rng.choice(vocabulary, n))
        rows.append(row(text, "en" if i % 3 else "de", "hot" if i % 2 else f"s{i % 5}"))
    return rows + [row(None), row(""), row("12 34"), row("only one here", None, None), row("only", "", "é"), row("x", "fr"),
                   row("a " * 5000, "en", "long"), row("w" * 300_000, "en", "long"), *[row("Same same SAME", "en", "copies")] * 40]


def test_terms_of_slices():
    texts = pa.array(["Zero", None, " Aa\tB1B ", "", "É\xa0Zz\x1c\x85q", "end", "start", "[a]{b}`c@D"] * 40)
    for at in (0, 1, 2, 117, 300):
        part = texts.slice(at, 9)
        got = divergence.Terms(part)
        which = np.arange(len(got.starts))
        want = [(i, t) for i, text in enumerate(part.to_pylist()) for t in terms(text)]
        assert list(zip(got.texts.tolist(), got.strings(which).to_pylist())) == want


def test_radix_order_is_stable():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 2**64, (2, 5000), dtype=np.uint64) % np.uint64(3**30) * rng.integers(0, 3, (2, 5000)).astype(np.uint64)
    order = divergence.radix_order([a, b], np.arange(5000))
    assert (order == np.lexsort((np.arange(5000), b, a))).all()


def test_runs_of_all_lengths(data):
    texts = [r[1] for r in data]
    groups = np.arange(len(texts)) % 3
    t = divergence.Terms(pa.array(texts))
    n, docs = Counter(), Counter()
    for which, of, count, inside in divergence.counted(t, groups):
        for key in zip(of.tolist(), t.strings(which).to_pylist(), count.tolist(), inside.tolist()):
            assert key[:2] not in n
            n[key[:2]], docs[key[:2]] = key[2], key[3]
    want_n, want_docs = Counter(), Counter()
    for g, text in zip(groups.tolist(), texts):
        want_n.update((g, x) for x in terms(text))
        want_docs.update({(g, x) for x in terms(text)})
    assert n == want_n and docs == want_docs


@pytest.mark.parametrize("least, cells, stretch, piece", [(30, 1 << 17, 512, 16 << 20), (1, 20, 2, 200), (3, 1, 1, 1), (10**6, 9, 3, 50)])
def test_audit_against_brute_force(spark, data, monkeypatch, least, cells, stretch, piece):
    for name, value in {"CELLS": cells, "STRETCH": stretch, "PIECE_BYTES": piece}.items():
        monkeypatch.setattr(divergence, name, value)
    want = brute(data, least, top=7)
    assert found(spark.createDataFrame(data, SCHEMA), least=least, top=7) == want
    assert any(r[2] == "pair" for r in want)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_shares_are_exact(spark):
    cases = list(itertools.product([0, 7, 10**12, 3 * 10**17], [1, 49, 2**40]))
    df = spark.createDataFrame([(n, n * 2 + 1, v) for n, v in cases], "n long, size long, v long")
    from pyspark.sql import functions as F
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("size"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (2 * n + 1 + 5 * v) for n, v in cases]
