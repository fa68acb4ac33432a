"""Fingerprints against a plain version that hashes byte by byte, also under a hot id."""

import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from quireflow.llm import catalog, fingerprints
from quireflow.llm.common import load


def plain_cuts(data):
    """Ends of chunks: the hash at a byte sums shifted gear values of the 32 bytes up to it."""
    gear = [int(g) for g in fingerprints._GEAR]
    hashes, h = [], 0
    for b in data:
        h = ((h << 1) + gear[b]) & 0xFFFFFFFF
        hashes.append(h)
    ends, start = [], 0
    while start < len(data):
        end = min(start + fingerprints.GREATEST, len(data))
        for i in range(start + fingerprints.LEAST, end):
            bits = fingerprints.STRICT_BITS if i < start + fingerprints.USUAL else fingerprints.LOOSE_BITS
            if hashes[i] >> (32 - bits) == 0:
                end = i + 1
                break
        ends.append(end)
        start = end
    return ends


def plain_chunks(text):
    data, start, found = text.encode(), 0, {}
    for end in plain_cuts(data):
        found[xxhash.xxh3_64_intdigest(data[start:end])] = end - start
        start = end
    return found


def shown(found):
    return " ".join(f"{d:016x}:{n}" for d, n in sorted(found.items()))


def likeness(a, b):
    return sum(n for d, n in a.items() if d in b) / sum(a.values()) if a else float(not b)


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for (i, text), (_, other) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[:len(text) - half] + other[:half]
        mine, its, theirs = plain_chunks(text), plain_chunks(changed), plain_chunks(other)
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), shown(mine), shown(its),
                    round(likeness(mine, its), 9), round(likeness(mine, theirs), 9)))
    return Counter(out)


def got(df):
    return Counter((*r[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect())


def test_the_query_against_the_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in load(spark, folder, "documents").select("doc_id", "text").collect()]
    assert got(catalog.op8_fingerprint(spark, folder)) == plain(rows)


@pytest.mark.parametrize("hot", [7, None, 999])
def test_a_third_of_rows_under_one_id(spark, hot):
    rows = [(i, f"text {i} " + "ab cd " * (i % 90)) for i in range(400)]
    rows += [(hot, f"hot {i} " + "xy z " * (i % 70)) for i in range(200)] + [(hot, "same text"), (hot, "same text"), (hot, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(fingerprints.with_next(docs)) == plain(rows)


def test_an_id_fills_several_stretches():
    import numpy as np
    import pyarrow as pa
    number = fingerprints._stretch(np.array([3, 5, 5, 5, 9])).func
    places = pa.array([0, 0, 0, 1 << 31, (1 << 32) - 1, 0, 0, (1 << 32) - 1], pa.int64())
    found = number(pa.array([1, 3, 5, 5, 5, 6, 9, 9], pa.int64()), places).to_pylist()
    assert found == [0, 1, 2, 3, 4, 4, 5, 5]
