"""Cleaners and chunker on hand-written edges and random texts."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireflow.functions import text
from quireflow.operators import prepare

STOP = ["the", "of", "a"]


def apply(spark, column, values, **kwargs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", column(F.col("t"), **kwargs).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


# (text, all paragraphs, last paragraph)
EDGES = [
    ("a.\n b", "a. b", "a. b"),
    ("a.\nb", "a. b", "b"),
    ("a.\n\nb", "a. b", "b"),
    ("a.\r\nb", "a. b", "a. b"),
    (" 12 foo", "12 foo", "12 foo"),
    ("12 foo", "foo", "foo"),
    ("x.\n12 foo", "x. foo", "foo"),
    ("x - y ,z ... q", "x-y,z. q", "x-y,z. q"),
    ("", "", ""),
    ("  \t ", "", ""),
    ("...", ".", "."),
    ("café naïve", "caf nave", "caf nave"),
    ("one\ntwo", "one two", "one two"),
    ("end.\n", "end.", ""),
    ("a -\nb : c", "a-b: c", "a-b: c"),
    ("a -\n b", "a- b", "a- b"),
    (None, None, None),
]


@pytest.mark.parametrize("mode,column", [("all", 1), ("last", 2)])
def test_training_edges(spark, mode, column):
    got = apply(spark, text.clean_training, [e[0] for e in EDGES], paragraphs=mode, stop_words=[])
    assert got == [e[column] for e in EDGES]


def test_stop_words_and_noise_are_exact(spark):
    values = ["the cat of The hat, of", "Scan Date x scan date y", "scan   date z"]
    got = apply(spark, text.clean_training, values, paragraphs="all", stop_words=STOP,
                noise_phrases=["scan date"])
    assert got == ["cat The hat,", "Scan Date x y", "z"]
    # The serving cleaner lower-cases first, so case does not protect the phrase there.
    got = apply(spark, text.clean_serving, values, stop_words=STOP, noise_phrases=["scan date"])
    assert got == ["cat hat", "x y", "z"]


def test_noise_with_outer_blanks(spark):
    got = apply(spark, text.clean_training, ["  of x", "y of x"], paragraphs="all",
                stop_words=[], noise_phrases=[" of"])
    assert got == ["of x", "y x"]


def test_serving_edges(spark):
    values = ["a,b C.D", "It's 4 o'clock!", "", "Été", "x\n\ny\t z", None]
    assert apply(spark, text.clean_serving, values, stop_words=[]) == [
        "ab cd", "it s o clock", "", "t", "x y z", None
    ]


def model_training(t, mode):
    """The rules written once more, paragraph by paragraph."""
    t = " " + re.sub(r"[^\x20-\x7e\t\n\r\x0b\x0c]", "", t)
    parts = re.split(r"(?<=\.)\n(?! )", t)
    cleaned = []
    for p in parts if mode == "all" else parts[-1:]:
        p = re.sub(r"\A\s?\d+", "", p.replace("\n", " ")).strip()
        p = re.sub(r"\s?-\s?", "-", p)
        p = re.sub(r"\s?([,:;.])", r"\1", p)
        p = re.sub(r"\.+", ".", re.sub(r"\s+", " ", p)).replace("x-x", "")
        cleaned.append(" ".join(w for w in p.split() if w not in STOP))
    return " ".join(c for c in cleaned if c)


def model_serving(t):
    t = re.sub(r"[^a-zA-Z]", " ", re.sub(r"[,.!?]", "", t.lower()))
    t = re.sub(r"\s+", " ", t).replace("ab c", "")
    return " ".join(w for w in t.split() if w not in STOP)


TEXTS = st.lists(st.text(alphabet="abcx.,-:; \n\t\r\x0b0123Aé", max_size=40), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_cleaners_follow_the_rules(spark, values):
    for mode in ("all", "last"):
        got = apply(spark, text.clean_training, values, paragraphs=mode, stop_words=STOP,
                    noise_phrases=["x-x"])
        assert got == [model_training(v, mode) for v in values]
    got = apply(spark, text.clean_serving, values, stop_words=STOP, noise_phrases=["ab c"])
    assert got == [model_serving(v) for v in values]


def test_sentences(spark):
    got = apply(spark, text.split_sentences, ["One. Two!  Three? four", "none", "A.b. c"])
    assert got == [["One.", "Two!", "Three?", "four"], ["none"], ["A.b.", "c"]]


# ---- chunks ---------------------------------------------------------------------------

def chunks_of(spark, counts, *args, **kwargs):
    df = spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in counts], "n int, t string")
    kwargs = {"full_split": False} | kwargs  # the compatible chunker, unless told otherwise
    out = prepare.with_chunks(df, "t", *args, **kwargs).select("n", "chunks").collect()
    return {r.n: r.chunks for r in out}


def test_chunk_counts(spark):
    made = chunks_of(spark, [0, 1, 149, 150, 200, 201, 299, 300, 450], 200, 50)
    assert {n: len(c) for n, c in made.items()} == {
        0: 1, 1: 1, 149: 1, 150: 1, 200: 1, 201: 1, 299: 1, 300: 2, 450: 3
    }
    assert made[0] == [""]
    assert [len(c.split()) for c in made[450]] == [200, 200, 150]
    assert made[300][1].split()[0] == "w150"
    # The tail beyond the last full stride is left out by default ...
    assert len(made[299][0].split()) == 200


def test_full_split_keeps_the_tail(spark):
    made = chunks_of(spark, [149, 299, 300, 301], 200, 50, full_split=True)
    assert {n: len(c) for n, c in made.items()} == {149: 1, 299: 2, 300: 3, 301: 3}
    assert made[300][2] == "" and made[301][2] == "w300"
    trimmed = chunks_of(spark, [300], 200, 50, full_split=True, drop_empty=True)
    assert len(trimmed[300]) == 2


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 400), st.integers(1, 60), st.data())
def test_full_split_covers_every_word(spark, n, maxlen, data):
    overlap = data.draw(st.integers(0, maxlen - 1))
    chunks = chunks_of(spark, [n], maxlen, overlap, full_split=True)[n]
    stride = maxlen - overlap
    words = [w for i, c in enumerate(chunks) for w in c.split()[: stride if i < len(chunks) - 1 else None]]
    assert words == [f"w{i}" for i in range(n)]


@pytest.mark.parametrize("overlap", [5, 6, -1])
def test_overlap_must_be_smaller(spark, overlap):
    with pytest.raises(ValueError):
        chunks_of(spark, [1], 5, overlap)
