"""Operator 3: benchmark decontamination with an FM-index per shard of documents.

A shard's words become symbols of the benchmark's vocabulary; every other word, and every
border between documents, is a separator. Runs too short to hold a test phrase fall out. Over
the rest stands an FM-index: suffix array, Burrows-Wheeler transform, a wavelet matrix for
ranks, and sampled suffix positions. All test phrases are searched backwards at once; their
occurrences are located by walking to the next sample, and merge into removal spans.

A phrase is a window of 13 words of a benchmark item, or the whole of a shorter item. The
benchmark goes to the tasks in blocks of a bounded number of words, one pass over the
documents for each block, so it may have any size; nothing is shuffled.

Defined cases: a null text or item has no words; an item without words has no phrase; items
of equal id count as one, a null id is named by the empty string; repeated documents are
treated each for itself; with an empty benchmark nothing is hit; an empty table gives an
empty result. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.llm import packed
from quireflow.llm.common import set_aside, lower_ascii, stored, text_or_empty

WINDOW = 13
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_WORDS = 1_000_000   # words of the benchmark that go to the tasks at once
PIECE = 10_000            # words of one item that stay together
SAMPLE = 8
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                  for c in range(256))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in a row, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts.slice(0, 0), texts])
    _, offsets, data = texts.buffers()
    plain = (data.to_pybytes() if data else b"").translate(_TO_WORDS)
    return packed.words_of(pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(plain)]))


class Phrases:
    """A block of test phrases: vocabulary, phrases as symbols, and the items of each."""

    def __init__(self, pieces: list[tuple[str, list[str]]], window: int = WINDOW):
        self.symbol: dict[str, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in pieces:
            codes = [self.symbol.setdefault(w, len(self.symbol) + 1) for w in words]
            for i in range(max(1, len(codes) - window + 1)):
                found.setdefault(tuple(codes[i:i + window]), set()).add(item)
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.codes = np.zeros((len(found), window), np.int64)  # set to the right
        for row, phrase in zip(self.codes, found):
            row[window - len(phrase):] = phrase


class WaveletMatrix:
    """Ranks of a symbol in any prefix of a sequence, many at a time."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = ((sequence >> shift) & 1).astype(bool)
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, ones, len(sequence) - int(ones[-1])))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        start = np.zeros_like(end)
        for shift, ones, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = ones[start], ones[end]
            start, end = np.where(one, zeros + a, start - a), np.where(one, zeros + b, end - b)
        return end - start


class FMIndex:
    """Over a sequence of symbols in which 0 is a separator that no phrase contains."""

    def __init__(self, sequence: np.ndarray, symbols: int, sample: int = SAMPLE):
        n = len(sequence)
        gap = sequence == 0
        # Separators differ and come first, so every two suffixes differ at one at the latest.
        rank = np.where(gap, np.cumsum(gap) - 1, int(gap.sum()) + sequence)
        order = np.argsort(rank, kind="stable")
        step = 1
        while True:
            ranked = rank[order]
            new = np.ones(n, bool)
            new[1:] = ranked[1:] != ranked[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1
            rank = rank * (n + 1) + after
            order = np.argsort(rank, kind="stable")
            step *= 2
        self.n, self.last = n, sequence[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])
        self.tree = WaveletMatrix(self.last, symbols)
        # No walk passes a separator: the place after one is always a sample.
        self.known = (order % sample == 0) | (self.last == 0)
        self.place = np.cumsum(self.known) - 1
        self.samples = order[self.known]

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, with their ranges of suffixes."""
        alive = np.arange(len(codes))
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), self.n, np.int64)
        for back in range(1, codes.shape[1] + 1):
            on = lengths[alive] >= back
            symbol = codes[alive[on], -back]
            low[on] = self.first[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.first[symbol] + self.tree.rank(symbol, high[on])
            left = low < high
            alive, low, high = alive[left], low[left], high[left]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.known[rows])
        while len(walking):
            symbol = self.last[rows[walking]]
            rows[walking] = self.first[symbol] + self.tree.rank(symbol, rows[walking])
            steps[walking] += 1
            walking = walking[~self.known[rows[walking]]]
        return self.samples[self.place[rows]] + steps


def occurrences(tokens: np.ndarray, starts: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Places (word numbers) and phrase numbers of all occurrences in documents that begin at
    ``starts``; token 0 is any word outside the vocabulary."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(tokens) or not len(phrases.lengths):
        return nothing
    known = tokens > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    begins[starts[starts < len(tokens)]] = known[starts[starts < len(tokens)]]
    run = np.cumsum(begins)[known]                      # run number of each known word
    at = np.flatnonzero(known)
    size = np.bincount(run)
    at, run = (x[size[run] >= phrases.lengths.min()] for x in (at, run))
    if not len(at):
        return nothing
    here = np.unique(tokens[at])
    compact = np.zeros(len(phrases.symbol) + 1, np.int64)
    compact[here] = np.arange(1, len(here) + 1)
    border = np.ones(len(at), bool)
    border[1:] = run[1:] != run[:-1]
    spot = np.arange(len(at)) + np.cumsum(border)       # a separator before each run
    sequence, word = np.zeros(len(at) + int(border.sum()), np.int64), np.zeros(len(at) + int(border.sum()), np.int64)
    sequence[spot], word[spot] = compact[tokens[at]], at
    index = FMIndex(sequence, len(here) + 1)
    codes = compact[phrases.codes]
    possible = np.flatnonzero(((codes > 0) | (phrases.codes == 0)).all(axis=1))
    alive, low, high = index.search(codes[possible], phrases.lengths[possible])
    count = high - low
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
    return word[index.locate(rows)], np.repeat(possible[alive], count)


def _spans(covered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """Covered words as merged spans per document, counted from the document's first word."""
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    cut = np.zeros(len(covered) + 1, bool)
    cut[starts] = True                                   # a span ends where its document ends
    on = np.concatenate([covered, [False]])
    before = np.concatenate([[False], covered])
    first = np.flatnonzero((edge == 1) | (cut & on & before))
    last = np.flatnonzero((edge == -1) | (cut & on & before))
    doc = np.searchsorted(ends, first, "right")
    offsets = np.searchsorted(doc, np.arange(len(starts) + 1))
    base = starts[doc] if len(doc) else doc
    both = pa.StructArray.from_arrays([pa.array(first - base, pa.int32()), pa.array(last - base, pa.int32())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), both)


def _search(block, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        for piece in packed.slices(batches):
            words, lengths = words_of(piece.column("text"))
            coded = words.dictionary_encode()
            names = np.fromiter((phrases.symbol.get(w, 0) for w in coded.dictionary.to_pylist()), np.int64,
                                len(coded.dictionary))
            tokens = names[coded.indices.to_numpy()] if len(names) else np.zeros(0, np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            place, phrase = occurrences(tokens, starts, phrases)
            edge = np.zeros(len(tokens) + 1, np.int64)
            np.add.at(edge, place, 1)
            np.add.at(edge, place + phrases.lengths[phrase], -1)
            for d, spans in enumerate(piece.column("__spans").to_pylist()):
                for s in spans or ():
                    edge[starts[d] + s["start"]] += 1
                    edge[starts[d] + s["end"]] -= 1
            covered = np.cumsum(edge[:-1]) > 0
            items = [set(x or ()) for x in piece.column("__items").to_pylist()]
            hits = np.unique(np.stack([np.searchsorted(ends, place, "right"), phrase], axis=1), axis=0)
            for d, p in hits.tolist():
                items[d].update(phrases.items[p])
            yield pa.RecordBatch.from_arrays([
                *[piece.column(c) for c in keep], pa.array(lengths, pa.int64()), _spans(covered, starts, ends),
                pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=[*keep, "__n_words", "__spans", "__items"])
    return run


def blocks(benchmark: DataFrame, window: int = WINDOW) -> Iterator[tuple[bool, Phrases]]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words, one at a time, and whether it
    is the last. Long items go in pieces that overlap by a window less one word, so each
    phrase is whole in one of them. There is one block at least."""
    words = F.regexp_extract_all(lower_ascii(text_or_empty(F.col("text").cast("string"))), F.lit(PATTERN), F.lit(0))
    items = benchmark.select(text_or_empty(F.col("item_id").cast("string")).alias("item"), words.alias("words")).filter(
        F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)), F.lit(PIECE))
    pieces = items.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), F.lit(PIECE + window - 1)).alias("words"))
    pieces = pieces.distinct()  # copies of an item say nothing new, and would share a block
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_WORDS))
    number = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    for block in range(count):
        rows = pieces.filter(number == block).collect()  # about BLOCK_WORDS words
        yield block == count - 1, Phrases([(r.item, r.words) for r in rows], window)


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) plus ``__n_words``, ``__spans`` (words to
    remove, end exclusive) and ``__items`` (ids of the items found, sorted)."""
    docs, back = set_aside(docs if keep is None else docs.select(*dict.fromkeys([*keep, "text"])), *(keep or ()), "text")
    keep = docs.columns if keep is None else keep
    docs = docs.withColumn("text", F.col("text").cast("string"))
    found = docs.withColumns({"__n_words": F.lit(0).cast("long"), "__spans": F.lit(None).cast(SPANS),
                              "__items": F.lit(None).cast("array<string>")})
    extra = found.schema.fields[-3:]
    for last, block in blocks(benchmark, window):
        shown = keep if last else docs.columns
        schema = T.StructType([*[docs.schema[c] for c in shown], *extra])
        found = found.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(block), shown), schema)
        if not last:  # one block in the workers' memory at a time
            found = stored(found, "block")
    return back(found)


def verdicts(found: DataFrame) -> DataFrame:
    """``found`` plus ``__n_hit`` and ``__contaminated``: a twentieth of the words or more."""
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("__n_hit", hit).withColumn(
        "__contaminated", (F.col("__n_hit") > 0) & (20 * F.col("__n_hit") >= F.col("__n_words")))
