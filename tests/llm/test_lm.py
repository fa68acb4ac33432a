"""Scores of the whole language model against a plain version with dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quireflow.llm import catalog, lm
from quireflow.llm.common import load, remainder
from tests.llm.test_operators import words

FOLDER = "/root/testdata/sf0.001"


def plain_scores(rows, order):
    """Scores by id: n-gram counts, weights by expectation-maximisation on the fold, mixture."""
    docs = []
    for i, text in rows:
        tokens = [*[0] * (order - 1), *words(text, True), None]      # begin marks, and the end
        grams = [tuple(tokens[at - order + 1:at + 1]) for at in range(order - 1, len(tokens))]
        docs.append((i, zlib.crc32(str(i).encode()) % 7, grams))

    def counted(wanted):
        counts, n_docs = [Counter() for _ in range(order)], 0
        for _, code, grams in docs:
            if wanted(code):
                n_docs += 1
                for k in range(order):
                    counts[k].update(g[order - 1 - k:] for g in grams)
        return counts, sum(counts[0].values()), n_docs

    def parts(gram, model):
        counts, total, n_docs = model
        before, estimates = total, []
        for k in range(order):
            if k:
                context = gram[order - 1 - k:-1]
                before = n_docs if context[-1] == 0 else counts[k - 1][context]
            estimates.append(counts[k][gram[order - 1 - k:]] / before if before else 0.0)
        return min(before.bit_length(), lm.CONTEXT_BUCKETS - 1), estimates

    whole, rest = counted(lambda c: c != 2), counted(lambda c: c not in (2, 3))
    uniform = 1 / (len(whole[0][0]) + 1)
    held = [parts(gram, rest) for _, code, grams in docs if code == 3 for gram in grams]
    weights = {b: (1 / (order + 1),) * (order + 1) for b in range(lm.CONTEXT_BUCKETS)}
    for _ in range(lm.ROUNDS):
        used = defaultdict(lambda: [0.0] * (order + 1))
        for b, estimates in held:
            share = [w * p for w, p in zip(weights[b], (uniform, *estimates))]
            for k, part in enumerate(share):
                used[b][k] += part / sum(share)
        weights |= {b: tuple(x / sum(u) for x in u) for b, u in used.items()}
    for b in range(lm.CONTEXT_BUCKETS):          # buckets without a token in the fold
        if b not in used:
            weights[b] = weights[max((o for o in used if o < b), default=min(used))]
    out = {}
    for i, _, grams in docs:
        found = [parts(gram, whole) for gram in grams]
        out[i] = sum(math.log10(max(weights[b][0], 1e-9) * uniform + sum(w * p for w, p in zip(weights[b][1:], estimates)))
                     for b, estimates in found)
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_against_the_plain_model(spark, order):
    docs = load(spark, FOLDER, "documents").filter("doc_id % 3 = 0")
    left = remainder("doc_id", 7)
    use = F.when(left == 2, lm.HELD_OUT).when(left == 3, lm.FOLD).otherwise(lm.TRAIN)
    want = plain_scores([tuple(r) for r in docs.select("doc_id", "text").collect()], order)
    got = {r.doc_id: r.score for r in lm.score(docs, use, order).collect()}
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], rel=1e-5) for i in want)


def test_the_query_against_the_plain_model(spark):
    rows = [tuple(r) for r in load(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    want = plain_scores(rows, 3)
    got = {r.doc_id: r.score for r in catalog.op2_lm_score(spark, FOLDER).collect()}
    assert set(got) == set(want) and len(got) == len(rows)
    assert all(got[i] == pytest.approx(want[i], rel=1e-5) for i in want)
