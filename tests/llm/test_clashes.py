"""Columns of the input that have the names operators work with; entries with ends of their own."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quireflow.llm import decontaminate, licenses, neardup, substrings, urlfilter

NAMES = ["licenses", "sentence_ids", "__n_words", "__spans", "__items", "__n_removed", "__kept", "__id2", "__digest2", "__in_1",
         "__n_hit", "__contaminated", "shard", "size", "part", "rows", "answers", "least", "flags"]
PASSAGE = " ".join(f"shared{i}" for i in range(20))


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"begin {i} {PASSAGE} end {i}" if i % 2 else f"own text of number {i}", "en", "a") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in NAMES})


def untouched(rows, names):
    return all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names)


def test_operators_replace_only_what_they_name(spark, clashing):
    bench = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE)], "item_id long, text string")
    for made, results in (
        (licenses.scan(clashing), {"licenses", "sentence_ids"}),
        (substrings.remove_repeats(clashing), {"__n_words", "__n_removed", "__kept"}),
        (decontaminate.find(clashing, bench), {"__n_words", "__spans", "__items"}),
    ):
        rows = made.collect()
        assert len(rows) == 8 and untouched(rows, set(NAMES) - results)
        assert sorted(made.columns) == sorted(clashing.columns)
    found = {r.doc_id: r for r in decontaminate.verdicts(decontaminate.find(clashing, bench)).collect()}
    assert all(found[i]["__items"] == (["1"] if i % 2 else []) for i in range(8))
    left = {r.doc_id: r["__n_removed"] for r in substrings.remove_repeats(clashing).collect()}
    assert [left[i] for i in range(8)] == [0, 0, 0, 21, 0, 21, 0, 21]  # the passage and "end"


def test_stages_keep_all_columns(spark, clashing, tmp_path):
    spark.createDataFrame([(1, "something else altogether here")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        made = stage(spark, clashing, str(tmp_path))
        assert made.columns == clashing.columns, name
        assert untouched(made.collect(), NAMES), name
    assert neardup.keep_one(clashing).columns == clashing.columns


def test_copies_of_a_benchmark_item_count_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    items = [(1, PASSAGE)] * 500 + [(2, " ".join(f"o{i}" for i in range(25)))]
    blocks = list(decontaminate.blocks(spark.createDataFrame(items, "item_id long, text string")))
    assert len(blocks) == 2


def test_entries_with_ends_of_their_own(spark):
    rnd, start = random.Random(3), date(2023, 1, 1)
    day = lambda: start + timedelta(days=rnd.randint(0, 60))
    entries, seen = [], set()
    for _ in range(80):
        name, at = rnd.choice(["bad.com", "x.bad.com", "b.org"]), day()
        if (name, at) not in seen:
            seen.add((name, at))
            entries.append((name, rnd.choice(["block", "allow"]), "c", at, rnd.choice([None, day()])))
    captures = [(i, f"http://{rnd.choice(['x.bad.com', 'bad.com', 'b.org', 'y.x.bad.com'])}/p", day()) for i in range(200)]

    def holds(name, at):
        """The name's newest entry at that time, unless it has ended."""
        before = [e for e in entries if e[0] == name and e[3] <= at]
        newest = max(before, key=lambda e: e[3], default=None)
        return None if newest is None or (newest[4] is not None and newest[4] <= at) else newest

    def judged(url, at):
        labels = url.split("/")[2].split(".")
        for i in range(len(labels) - 1):
            found = holds(".".join(labels[i:]), at)
            if found:
                return found[0], found[1], found[3]
        return None, None, None

    made = urlfilter.judge(
        spark.createDataFrame(captures, "page_id long, url string, fetched_at date"),
        spark.createDataFrame(entries, "name string, action string, category string, listed_at date, delisted_at date"))
    got = {r.page_id: (r.listed_name, r.action, r.valid_from) for r in made.collect()}
    assert got == {i: judged(url, at) for i, url, at in captures}
    assert len({v[1] for v in got.values()}) == 3
