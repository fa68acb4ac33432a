"""Each text operator on odd rows, on empty tables, and against a brute-force version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quireflow.llm import (catalog, chat, decontaminate, fingerprints, licenses, lm, mixing, neardup, packed, quality,
                           substrings, urlfilter)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"shared{i}" for i in range(30))
BASE = [f"w{i % 37}x{i}" for i in range(200)]
NEAR = BASE[:50] + ["changed"] + BASE[51:]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, target double, shard long, "
          "words string, __kept2 string")


def _row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), 1, 0.5, 9, "extra", None)


ODD = [
    _row(1, " ".join(BASE)), _row(2, " ".join(NEAR), "b"), _row(3, None), _row(4, ""), _row(5, " \t\n\x0b "),
    _row(6, "short text here"), _row(6, "short text here"), _row(None, "No id. " + PASSAGE, None),
    _row(7, f"lead in {PASSAGE} tail"), _row(8, f"other {PASSAGE.upper()} and {PASSAGE}", None),
    _row(9, "one two " * 4000, "b"), _row(10, " ".join(BASE)), _row(11, "İ ÉÀ straße 你好 world \x1c x"),
    _row(2, "same id, another text", "c"), _row(12, "x" * 300_000, ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Benchmark and labels beside the odd documents."""
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, "short text"), (3, None), (None, "lonely")],
                          "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 1, 0), (7, 0, 1), (7, None, 0)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(ODD, SCHEMA).write.parquet(f"{at}/documents.parquet")
    return at


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else (text or ""))


def kept(rows, key="doc_id"):
    return sorted((r[key] for r in rows), key=lambda x: (x is None, x))


# Packed arrays

def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 10_000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (packed.unsqueeze_sorted(packed.squeeze_sorted(keys)) == keys).all()
        for top in (1, 300, 70_000, 2**40):
            values = rng.integers(0, top, n)
            assert (packed.unsqueeze(packed.squeeze(values)) == values).all()
    top = np.array([0, 2**64 - 1], np.uint64)
    assert (packed.unsqueeze_sorted(packed.squeeze_sorted(top)) == top).all()


def test_words_of_slices():
    texts = pa.array(["Zero", None, " Aa\tBB \n", "", "É\xa0Z z\x1c\x85q"] * 50)
    for at in (0, 1, 2, 117):
        found, lengths = packed.words_of(texts.slice(at, 7), lower=True)
        want = [words(t, True) for t in texts.slice(at, 7).to_pylist()]
        assert found.to_pylist() == sum(want, []) and lengths.tolist() == [len(w) for w in want]


def test_buckets_cover_all_keys():
    keys = np.sort(np.random.default_rng(2).integers(0, 2**64, 999, dtype=np.uint64))
    assert sum(p.stop - p.start for _, p in packed.by_bucket(keys, 4)) == 999
    assert all((keys[p] >> np.uint64(60) == b).all() for b, p in packed.by_bucket(keys, 4))


# 1 mixing

def test_mix_odd_rows(odd):
    rows = mixing.plan(odd).collect()
    assert len(rows) == len(ODD)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.source, [r.source_size, r.target, 0, 0])
        sizes[r.source][2] += r.size
        sizes[r.source][3] += r.copies * r.size
    total = sum(v[2] for v in sizes.values())
    assert all(v[0] == v[2] and v[1] <= 3 * v[0] + 1e-6 for v in sizes.values())
    assert math.isclose(sum(v[1] for v in sizes.values()), total)
    assert all(0 <= r.copies <= 3 for r in rows)
    again = mixing.plan(odd.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.copies)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in rows)


def test_mix_exchanges_texts_once(spark):
    """Numbered rows are joined with the few counts of their partitions where they lie."""
    texts = [" ".join(hashlib.sha256(f"{i}-{k}".encode()).hexdigest() for k in range(10)) for i in range(600)]
    docs = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")  # below the size of the texts
    try:
        mixed = mixing.mix(docs)
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        kept = [tuple(r) for r in mixed.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    taken = Counter(kept)
    wanted = {r.doc_id: r.copies for r in mixing.plan(docs).collect() if r.copies}
    assert taken == {(i, texts[i], "ab"[i % 2]): n for i, n in wanted.items()}


def test_targets_share_the_excess(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 500), ("c", 0), (None, 490)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got["a"] == 30 and got["c"] == 0  # weights 5, 2, 1, 5: a is capped
    assert math.isclose(got["b"], 970 * 2 / 7) and math.isclose(got[None], 970 * 5 / 7)


# 2 language model

def _lm_use():
    code = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return F.when(code == 2, lm.HELD_OUT).when(code == 3, lm.FOLD).otherwise(lm.TRAIN)


def test_lm_base_against_counts(spark, odd):
    rows = lm.score(odd, _lm_use()).collect()
    texts = [(r[0], words(r[1], True) + ["\n"]) for r in ODD]
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in texts]
    counts = Counter(w for (_, t), h in zip(texts, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, h, len(t), sum(counts[w] > 0 for w in t), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6))
                   for (i, t), h in zip(texts, held))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_lm_learns_word_order(spark):
    rng = np.random.default_rng(0)
    text = [" ".join(np.ravel([(f"a{k}", f"b{k}") for k in rng.integers(0, 40, 60)])) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    for order in (2, 3):
        rows = [r for r in lm.score(docs, _lm_use(), order).collect() if r.held_out]
        assert rows and all(r.score > r.base_score + 20 for r in rows)


def test_lm_without_training(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm.score(docs, F.lit(lm.HELD_OUT)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score)


# 3 decontamination

def test_fm_index_against_search():
    rng = np.random.default_rng(3)
    for _ in range(20):
        text = rng.integers(0, 4, 200)
        text[0] = 0
        index = decontaminate.FMIndex(text, 4, sample=5)
        codes = rng.integers(1, 4, (30, 4))
        lengths = rng.integers(1, 5, 30)
        for i in range(30):
            codes[i, :4 - lengths[i]] = 0
        alive, low, high = index.search(codes, lengths)
        found = {int(a): sorted(index.locate(np.arange(lo, hi)).tolist()) for a, lo, hi in zip(alive, low, high)}
        for i in range(30):
            phrase = codes[i, 4 - lengths[i]:]
            want = [p for p in range(200 - len(phrase) + 1) if (text[p:p + len(phrase)] == phrase).all()]
            assert found.get(i, []) == want


def _contamination(texts, items):
    pattern = re.compile(decontaminate.PATTERN)
    phrases = {}
    for item, text in items:
        ws = pattern.findall((text or "").translate(LOWER))
        for i in range(max(1, len(ws) - 12) if ws else 0):
            phrases.setdefault(tuple(ws[i:i + 13]), set()).add("" if item is None else str(item))
    for doc_id, text in texts:
        ws, hit, names = pattern.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i:i + n]) in phrases:
                    hit.update(range(i, i + n))
                    names |= phrases[tuple(ws[i:i + n])]
        yield doc_id, len(ws), len(hit), tuple(sorted(names))


@pytest.mark.parametrize("block", [1_000_000, 3])
def test_contamination_of_odd_rows(spark, odd, folder, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.verdicts(decontaminate.find(odd, bench, ["doc_id", "size"]))
    got = Counter((r["doc_id"], r["__n_words"], r["__n_hit"], tuple(r["__items"])) for r in found.collect())
    items = [(1, PASSAGE), (2, "short text"), (3, None), (None, "lonely")]
    assert got == Counter(_contamination([(r[0], r[1]) for r in ODD], items))


def test_long_items_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 20)
    text = " ".join(f"t{i}" for i in range(100))
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(text.split()[i:i + 13])) for i in range(88)], "doc_id long, text string")
    assert decontaminate.verdicts(decontaminate.find(docs, bench, ["doc_id"])).filter("__n_hit = 13").count() == 88


# 4 licenses

def test_license_rules(spark):
    texts = {
        1: "Intro. Released under the MIT License.\nMore", 2: "Apache License\nVersion 2.0, January 2004\n",
        3: "Version 2.0, January 2004\nApache License\n", 4: None, 5: "",
        6: "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
           "Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your "
           "option) any later version.", 7: "MIT License",
        8: "Licensed under CC BY-NC 4.0. Released under the MIT License!",
    }
    docs = spark.createDataFrame([(k, v, "c") for k, v in texts.items()], "doc_id long, text string, licenses2 string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert got == {1: ["MIT"], 2: ["Apache-2.0"], 3: [], 4: [], 5: [], 6: ["GPL-3.0"], 7: [], 8: ["CC-BY-NC-4.0", "MIT"]}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", "   ", ";; "])
def test_published_licenses_in_comments(spark, mark):
    texts = {"MIT": MIT, "BSD": BSD, "Apache-2.0": APACHE, "GPL-3.0": GPL}
    commented = {k: "\n".join((mark + line).rstrip() for line in v.split("\n")) for k, v in texts.items()}
    docs = spark.createDataFrame(list(commented.items()), "doc_id string, text string")
    assert {r.doc_id: r.licenses for r in licenses.scan(docs).collect()} == {k: [k] for k in texts}


# 5 quality

def test_trees_learn_a_rule_and_are_walked_in_order():
    rng = np.random.default_rng(4)
    rows = rng.random((3000, len(quality.FEATURES)))
    labels = ((rows[:, 3] > 0.4) & (rows[:, 7] < 0.7)).astype(float)
    trees = quality.fit_trees(rows[:2000], labels[:2000])
    score = trees.score(rows[2000:])
    assert ((score >= 0.5) == labels[2000:]).mean() > 0.98
    one, inner = rows[2000], trees.feature.shape[1]
    total = trees.start
    for t in range(len(trees.feature)):
        node = 0
        while node < inner:
            node = 2 * node + 1 + int(one[trees.feature[t, node]] > trees.threshold[t, node])
        total += trees.leaf[t, node - inner]
    assert math.isclose(score[0], 1 / (1 + math.exp(-total)))


def test_statistics_count_kinds():
    texts = pa.array([None, "", "AB cd. 12\nxy!", "é"])
    got = quality.statistics(texts.slice(1, 3))
    names = quality.FEATURES
    assert (got[0] == 0).all() and (quality.statistics(texts)[0] == 0).all()
    row = dict(zip(names, got[1]))
    assert math.isclose(row["upper"], 2 / 13) and math.isclose(row["shout"], 1 / 13) and row["longest_word"] == 3
    assert math.isclose(dict(zip(names, got[2]))["other"], 1.0)


def test_quality_held_out_accuracy(spark):
    out = catalog.op5_quality(spark, "/root/testdata/sf0.01").filter("held_out")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    right, n = out.join(marks, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 50 and right > 0.95


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 0), (6, 0)], [(1, None)]])
def test_quality_without_two_classes(spark, odd, rows):
    marks = spark.createDataFrame(rows, "doc_id long, quality int")
    stats = quality.features(odd)
    got = quality.scored(stats, quality.fit(stats, marks)).collect()
    assert len(got) == len(ODD) and len({r.score for r in got}) == 1 and 0 <= got[0].score <= 1


# 6 chat

def test_chats_come_back(spark):
    turns = [(1, 0, "user", "a </s> [INST] \\ <\\/s> <|im_end|><|im_sep|>x"), (1, 1, "assistant", "\\\\</s>\n<<|im_end|>"),
             (2, 0, "assistant", None), (2, None, None, "q"), (2, 0, "assistant", None), (None, 5, "user\n<|im_sep|>", ""),
             (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "a1"), (3, 3, "user", "v"), (3, 4, "assistant", "a2")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = {r.conv_id: r for r in chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn(
        "learned", chat.learned_text(F.col("segments"))).collect()}
    for conv, row in out.items():
        mine = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        assert [(b.role, b.text) for b in row.back] == [(t[2], t[3]) for t in mine]
        assert row.learned == "".join(t[3] for t in mine if t[2] == "assistant")
        assert "".join(s.text for s in row.segments) == row.formatted
    assert {c: r.valid for c, r in out.items()} == {1: True, 2: False, None: False, 3: True}
    text = out[1].formatted
    assert text.count("<|im_end|>") == 2 and "</s>" not in text and "[INST]" not in text


def test_overlapping_control_strings(spark):
    template = chat.Template(reserved=("aba", "<|<|"))
    df = spark.createDataFrame([(1, 0, "user", "ababa <|<|<| a\\ba")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df, template).withColumn("back", chat.read_turns(F.col("formatted"), template)).first()
    assert row.back[0].text == "ababa <|<|<| a\\ba" and "aba" not in row.segments[1].text and "<|<|" not in row.segments[1].text
    with pytest.raises(ValueError):
        chat.Template(reserved=("\\x",))


# 7 near-duplicates

def bag(text):
    ws = words(text, True)
    return Counter(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))) if ws else Counter()


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**44, 60, dtype=np.uint64)
    a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    doc, weight = np.repeat([0, 1], 60), np.concatenate([a, b])
    some = weight > 0
    times = neardup.signatures(np.tile(keys, 2)[some], weight[some], doc[some], 2, places=4096)
    assert abs((times[0] == times[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_classes_of_odd_rows(odd, none):
    rows = neardup.classes(odd).collect()
    ids = Counter((r.doc_id, r.class_id) for r in rows)
    assert len(rows) == len(ODD) and ids[(1, 1)] == 1 and ids[(2, 1)] == 1 and ids[(10, 1)] == 1 and ids[(2, 2)] == 1
    assert ids[(6, 6)] == 2 and ids[(4, 3)] == 1 and ids[(5, 5)] == 1 and ids[(None, 7)] == 1  # 26 of 31 shingles
    left = neardup.keep_one(odd)
    assert left.columns == odd.columns and kept(left.collect()) == [1, 2, 3, 5, 6, 7, 8, 9, 11, 12]
    assert neardup.classes(none).count() == 0 and neardup.keep_one(none).count() == 0


def test_star_of_satellites_round_a_hub(spark):
    """Texts made from one hub are like the hub and not all like each other."""
    rng = np.random.default_rng(6)
    base = [f"b{i}" for i in range(300)]
    docs = [(0, " ".join(base))]
    for k in range(1, 60):
        mine = list(base)
        for spot in rng.choice(60, 5, replace=False):
            mine[5 * spot] = f"k{k}s{spot}"
        docs.append((k, " ".join(mine)))
    docs += [(100 + k, " ".join(f"c{k}d{i}" for i in range(50)) + " " + PASSAGE) for k in range(80)]
    rows = neardup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    bags = {i: bag(t) for i, t in docs}
    like = [k for k in range(1, 60) if 5 * sum((bags[0] & bags[k]).values()) >= 4 * sum((bags[0] | bags[k]).values())]
    got = {r.doc_id: r.class_id for r in rows}
    assert len(like) > 40 and all(got[k] == 0 for k in like) and all(got[100 + k] == 100 + k for k in range(80))


def brute_classes(texts):
    """The class of each id by all pairs at 0.8."""
    bags = [(i, bag(t)) for i, t in texts]
    sizes, classes = [sum(b.values()) for _, b in bags], {i: i for i, _ in bags}

    def root(i):
        while classes[i] != i:
            i = classes[i]
        return i

    for x, (i, a) in enumerate(bags):
        for y in range(x):
            if a and bags[y][1] and 5 * min(sizes[x], sizes[y]) >= 4 * max(sizes[x], sizes[y]):
                shared = sum(min(n, bags[y][1][k]) for k, n in a.items() if k in bags[y][1])
                if 9 * shared >= 4 * (sizes[x] + sizes[y]):
                    one, two = sorted((root(i), root(bags[y][0])))
                    classes[two] = one
    return {i: root(i) for i in classes}


def test_pairs_among_pages_of_one_template(spark):
    """Each page is under 0.8 to the template and to all others, but for one planted partner
    at 0.80 to 0.85, and some for a chain of them."""
    rng = np.random.default_rng(8)
    docs = []

    def page(at, own):
        return " ".join([f"t{i}" for i in range(at)] + own + [f"t{i}" for i in range(at + len(own), 300)])

    for k in range(400):
        at = int(rng.integers(10, 250))
        own = [f"p{k}w{i}" for i in range(32)]
        docs.append((k, page(at, own)))
        for copy in range(3 if k % 40 == 0 else 1 if k < 120 else 0):
            fresh = int(rng.integers(22, 29))
            own = own[:32 - fresh] + [f"q{k}c{copy}w{i}" for i in range(fresh)]
            docs.append((1000 + 10 * k + copy, page(at, own)))
    rows = neardup.classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    want = brute_classes(docs)
    assert sum(i != c for i, c in want.items()) > 120
    assert {r.doc_id: r.class_id for r in rows} == want


def test_classes_promise_no_count_of_links(odd):
    assert neardup.classes(odd.limit(2)).columns == ["doc_id", "class_id", "class_size"]


def test_prefix_pairs_hold_all_similar_pairs(spark):
    rng = np.random.default_rng(9)
    docs = []
    for k in range(150):
        mine = [f"v{x}" for x in rng.integers(0, 12, 60)] if k % 3 == 0 else docs[-1][1].split()
        for spot in rng.integers(0, len(mine), 2 if k % 3 else 0):
            mine[spot] = f"z{k}" if k % 2 else "v1 v1 v1"
        docs.append((k, " ".join(mine)))
    docs += [(1000 + k, "again " * (20 + k)) for k in range(12)] + [(2000, "one"), (2001, "one two three four five six")]
    bags = spark.createDataFrame(docs, "node long, text string").mapInArrow(neardup._bags, "node long, bag binary")
    got = {(r.a, r.b) for r in neardup._prefix_pairs(bags.withColumn("label", F.col("node"))).collect()}
    real = [(i, bag(t)) for i, t in docs]
    want = {(i, j) for i, a in real for j, b in real if i < j and 5 * sum((a & b).values()) >= 4 * sum((a | b).values())}
    assert len(want) > 40 and want <= got


# 8 fingerprints

def test_fingerprints_of_odd_rows(spark, odd, none):
    rows = fingerprints.with_next(odd).collect()
    assert len(rows) == len(ODD)
    order = sorted(((r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest(), r[1] or "") for r in ODD))
    want = Counter()
    for i, row in enumerate(order):
        text, other = row[3], order[(i + 1) % len(order)][3]
        want[(row[1] if row[0] else None, len(text), hashlib.sha256(
            fingerprints.edited(text, other).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.with_next(none).count() == 0
    assert fingerprints.with_next(odd.limit(1)).first().near_next == 1.0


def test_chunks_resist_shifts():
    rng = np.random.default_rng(7)
    text = " ".join(f"word{k}" for k in rng.integers(0, 5000, 2000))
    a, b = fingerprints.chunks(text), fingerprints.chunks("in front " + text)
    assert fingerprints.containment(a, b) > 0.97 and fingerprints.containment(a, a) == 1.0
    assert fingerprints.containment({}, {}) == 1.0 and fingerprints.containment({}, a) == 0.0
    data = np.frombuffer(text.encode(), np.uint8)
    ends = fingerprints.cuts(fingerprints.gear(data))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= fingerprints.GREATEST and (sizes[:-1] >= fingerprints.LEAST).all()
    slow = 0
    for c in data[100:132]:
        slow = (slow * 2 + int(fingerprints._GEAR[c])) & 0xFFFFFFFF
    assert fingerprints.gear(data)[131] == slow


# 9 URL filter

def test_url_filter_as_of(spark):
    entries = spark.createDataFrame(
        [("bad.com", "block", "x", "2024-01-01"), ("bad.com", "allow", "y", "2024-06-01"), ("sub.bad.com", "block", "z", "2024-03-01"),
         ("bad.com", "allow", "w", "2024-01-01"), (None, "block", "n", "2024-01-01"), ("late.com", "block", "n", None)],
        "name string, action string, category string, d string").withColumn("listed_at", F.to_date("d")).drop("d")
    pages = [(1, "https://bad.com/a", "2023-12-31"), (2, "http://u:p@www.BAD.com:80/a", "2024-01-01"), (3, "http://a.sub.bad.com", "2024-02-01"),
             (4, "http://a.sub.bad.com/?q", "2024-03-01"), (5, "http://bad.com", "2024-07-01"), (6, None, "2024-07-01"),
             (7, "http://bad.com", None), (8, "http://notbad.com", "2024-02-01"), (9, "http://late.com", "2025-01-01"),
             (1, "https://bad.com/a", "2023-12-31")]
    caps = spark.createDataFrame(pages, "page_id long, url string, d string").withColumn("fetched_at", F.to_date("d")).withColumn("host", F.lit("clash"))
    got = Counter((r.page_id, r.blocked, r.category) for r in urlfilter.judge(caps, entries).collect())
    assert got == Counter([(1, False, None), (1, False, None), (2, True, "x"), (3, True, "x"), (4, True, "z"), (5, False, "y"),
                           (6, False, None), (7, False, None), (8, False, None), (9, False, None)])
    spans = urlfilter.intervals(entries).filter("name = 'bad.com'").orderBy("valid_from").collect()
    assert [(str(r.valid_from), str(r.valid_to), r.action) for r in spans] == [
        ("2024-01-01", "2024-06-01", "block"), ("2024-06-01", "None", "allow")]
    assert urlfilter.judge(caps, entries.limit(0)).filter("blocked").count() == 0
    assert urlfilter.judge(caps.limit(0), entries).count() == 0


# 10 substrings

def repeats(texts, window=13):
    least = {}
    order = lambda i: math.inf if i is None else i
    for i, text in texts:
        ws = words(text)
        for at in range(len(ws) - window + 1):
            k = tuple(ws[at:at + window])
            least[k] = min(least.get(k, math.inf), order(i))
    for i, text in texts:
        ws, gone = words(text), set()
        for at in range(len(ws) - window + 1):
            if least[tuple(ws[at:at + window])] < order(i):
                gone.update(range(at, at + window))
        left = " ".join(w for p, w in enumerate(ws) if p not in gone)
        yield i, len(ws), len(gone), hashlib.sha256(left.encode()).hexdigest()


def test_substrings_of_odd_rows(odd, none):
    got = Counter(tuple(r) for r in substrings.digest(substrings.remove_repeats(odd.repartition(3))).collect())
    assert got == Counter(repeats([(r[0], r[1]) for r in ODD]))
    assert substrings.remove_repeats(none).count() == 0


def test_substrings_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CELL_BITS", 12)
    monkeypatch.setattr(substrings, "KEYS_PER_BUCKET", 500)
    monkeypatch.setattr(packed, "SHARD_BYTES", 5_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(4)
    got = Counter(tuple(r) for r in substrings.digest(substrings.remove_repeats(docs)).collect())
    assert got == Counter(repeats([(r.doc_id, r.text) for r in docs.collect()]))


# All of them on empty tables, and the pipeline's stages

def test_empty_tables(spark, none, folder):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0
    assert lm.score(none, F.lit(lm.TRAIN)).count() == 0
    assert decontaminate.find(none, bench).count() == 0
    assert decontaminate.verdicts(decontaminate.find(none, bench.limit(0))).count() == 0
    assert licenses.scan(none).count() == 0
    assert quality.features(none).count() == 0
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(chats).count() == 0


def test_nothing_hit_by_an_empty_benchmark(spark, odd):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.verdicts(decontaminate.find(odd, bench)).filter("__contaminated").count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_and_no_rows(spark, odd, none, folder, name, stage):
    out = stage(spark, odd, folder)
    assert out.columns == odd.columns
    got = kept(out.collect())
    every = kept(ODD, 0)
    if name == "quality":
        assert set(got) <= set(every)
    elif name == "near_dedup":
        assert got == [1, 2, 3, 5, 6, 7, 8, 9, 11, 12]
    elif name == "substring_dedup":
        assert got == every
        texts = {(r.doc_id, r.text) for r in out.collect()}
        assert (10, "") in texts and (3, None) in texts and (7, f"lead in {PASSAGE} tail") in texts
        assert (8, f"other {PASSAGE.upper()} and") in texts and (None, "No id.") in texts
    elif name == "decontaminate":
        assert got == [1, 2, 2, 3, 4, 5, 9, 10, 11, 12]
    assert stage(spark, none, folder).count() == 0


def test_pipeline_runs_stage_after_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() > 0
