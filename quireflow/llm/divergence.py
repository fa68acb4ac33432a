"""Operator 13: source divergence audit over length-bucketed, packed terms.

Which words set a source apart from its language, and which sources of a language are far from
each other? A task cuts its texts into terms and counts them by length: terms of up to 8 bytes
are one uint64, of up to 16 bytes two, sorted by radix (16 bits a pass) and counted in runs.
Longer terms lie in buckets by length, each sorted bytewise. Spark adds up the runs.

Every language keeps the terms of at least ``least`` of its documents. A term's share in a
group, in parts of ``SCALE``, is ``1 + floor(SCALE * (count + extra) / (size + extra * terms))``,
all in whole numbers. ``pair`` rows sum the differences of shares between two sources of a
language over all kept terms; ``term`` rows are the terms that a source has more of than its
language.

Sources are compared in blocks of terms: a task holds all sources' shares of one block and
adds up differences for one stretch of sources, so its memory has a bound for any number of
terms, and no row stands for a pair of sources and a term.

Defined cases: a null text, language or source is empty, and empty ones are groups like others;
a text without terms makes its group occur, with counts of 0; a language without kept terms has
``pair`` rows of value 0 and no ``term`` rows; rows that repeat are documents like others; an
empty table gives an empty result. Other columns are not read. A task's memory grows with its
longest text, by some 30 bytes for each of that text's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm import packed
from quireflow.llm.common import stored, text_or_empty

LEAST_DOCS = 30
EXTRA = 5
SCALE = 1_000_000_000
TOP = 50
CELLS = 1 << 17        # shares that a task compares at once
STRETCH = 512          # sources that a task compares with all others
PIECE_BYTES = 16 << 20
U64 = np.uint64

# Letters are A-Z, a-z and everything outside ASCII; the table lower-cases A-Z, 0 ends a term.
_LETTERS = np.zeros(256, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


class Terms:
    """All terms of some texts: where each begins, its length, and the text it is in."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pa.concat_arrays([texts.slice(0, 0), texts])  # a copy: offsets begin at 0
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[:len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[:ends[-1]] if data and ends[-1] else np.zeros(0, np.uint8)
        self.data = np.concatenate([_LETTERS[raw], np.zeros(16, np.uint8)])
        letter = self.data[:len(raw)] > 0
        begin, finish = letter.copy(), letter.copy()
        begin[1:] &= ~letter[:-1]
        finish[:-1] &= ~letter[1:]
        cuts = ends[(ends > 0) & (ends < len(raw))]  # a term ends where its text does
        begin[cuts], finish[cuts - 1] = letter[cuts], letter[cuts - 1]
        self.starts = np.flatnonzero(begin)
        self.lengths = np.flatnonzero(finish) + 1 - self.starts
        self.texts = np.searchsorted(ends, self.starts, "right") - 1

    def word(self, which: np.ndarray, first: int) -> np.ndarray:
        """Bytes ``first`` to ``first + 7`` of each term as one number, in byte order."""
        starts, lengths = self.starts[which] + first, self.lengths[which] - first
        out = np.zeros(len(which), U64)
        for j in range(8):
            byte = np.where(j < lengths, self.data[np.minimum(starts + j, len(self.data) - 1)], 0)
            out |= byte.astype(U64) << U64(56 - 8 * j)
        return out

    def strings(self, which: np.ndarray) -> pa.Array:
        lengths = self.lengths[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[which] - ends[:-1], lengths) + np.arange(ends[-1])
        return pa.LargeStringArray.from_buffers(
            len(which), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.data[at]))

    def fixed(self, which: np.ndarray, width: int) -> np.ndarray:
        """Terms as byte strings of one width, filled up with zeros."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(ends, lengths)
        out = np.zeros(len(which) * width, np.uint8)
        out[np.repeat(np.arange(len(which)) * width, lengths) + within] = self.data[
            np.repeat(self.starts[which], lengths) + within]
        return out.view(f"S{width}")


def radix_order(words: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` sorted by the words, the first one leading; ties keep their places.

    One pass for each 16 bits, the last first; numpy sorts 16-bit numbers by counting."""
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> U64(shift)) & U64(0xFFFF)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def counted(terms: Terms, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of equal terms within a group: ``(a term of each, groups, occurrences, texts)``.

    ``groups`` numbers the group of each text."""
    of = groups[terms.texts]
    by_group = np.argsort(of, kind="stable")  # texts stay in order within a group
    length = terms.lengths[by_group]
    buckets = [(by_group[length <= 8], 1), (by_group[(length > 8) & (length <= 16)], 2)]
    wide = length > 16
    widths = 1 << np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
    buckets += [(by_group[wide & (widths == w)], int(w)) for w in np.unique(widths[wide])]
    for which, size in buckets:
        if not len(which):
            continue
        if size <= 2:
            keys = [terms.word(which, 8 * j) for j in range(size)]
            order = radix_order(keys, np.arange(len(which)))
        else:
            keys = [terms.fixed(which, size)]
            order = np.argsort(keys[0], kind="stable")
        which = which[order]
        new = np.ones(len(which), bool)
        new[1:] = of[which[1:]] != of[which[:-1]]
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        first = new.copy()
        first[1:] |= terms.texts[which[1:]] != terms.texts[which[:-1]]
        runs = np.flatnonzero(new)
        yield (which[runs], of[which[runs]], np.diff(np.append(runs, len(which))),
               np.add.reduceat(first, runs, dtype=np.int64))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, the latter within the group.

    Each group has a row of the empty term, with counts of 0, too."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in packed.slices(batches, PIECE_BYTES):
            coded = [piece.column(c).dictionary_encode() for c in ("lang", "source")]
            lang, source = (c.indices.to_numpy().astype(np.int64) for c in coded)
            pairs, groups = np.unique((lang << 32) | source, return_inverse=True)
            langs = coded[0].dictionary.take(pa.array(pairs >> 32))
            sources = coded[1].dictionary.take(pa.array(pairs & 0xFFFFFFFF))
            none = pa.array(np.zeros(len(pairs), np.int64))
            yield pa.RecordBatch.from_arrays([langs, sources, pa.array([""] * len(pairs)), none, none], names=names)
            terms = Terms(piece.column("text"))
            for which, of, n, texts in counted(terms, groups):
                of = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(of), sources.take(of), terms.strings(which).cast(pa.string()), pa.array(n), pa.array(texts)],
                    names=names)

    slim = docs.select(*[text_or_empty(F.col(c).cast("string")).alias(c) for c in ("text", "lang", "source")])
    rows = slim.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, size: Column, terms: Column, extra: int = EXTRA) -> Column:
    """A term's share in parts of ``SCALE``, exact; null where there are no terms."""
    whole = "decimal(38,0)"
    top = (count.cast(whole) + extra) * F.lit(SCALE).cast("decimal(10,0)")
    below = size.cast(whole) + terms.cast(whole) * extra
    ratio = F.call_function("div", top.cast(whole), F.nullif(below.cast(whole), F.lit(0).cast(whole)))
    return (ratio + 1).cast("long")


def _distances(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of differences between the sources of one stretch and all sources of a language,
    over one block of terms."""
    lang, _, stretch = (k.as_py() for k in key)
    order = pc.sort_indices(right["source"])
    sources = right["source"].combine_chunks().take(order)
    mine = np.flatnonzero(right["own"].combine_chunks().take(order).to_numpy(zero_copy_only=False) == stretch)
    coded = left["term"].combine_chunks().dictionary_encode()
    base = right["base"].combine_chunks().take(order).to_numpy(zero_copy_only=False)
    shares = np.repeat(base[:, None], len(coded.dictionary), axis=1)
    shares[pc.index_in(left["source"].combine_chunks(), sources).to_numpy(), coded.indices.to_numpy()] = left["p"].to_numpy()
    n, found = len(sources), []
    for i in mine:
        far = np.abs(shares - shares[i]).sum(axis=1)
        others = np.delete(np.arange(n), i)
        found.append((np.full(n - 1, i), others, far[others]))
    a, b, value = (np.concatenate(x).astype(np.int64) if found else np.zeros(0, np.int64)
                   for x in (zip(*found) if found else ((), (), ())))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": sources.take(pa.array(a)),
                     "item": sources.take(pa.array(b)), "value": pa.array(value)})


def audit(docs: DataFrame, least: int = LEAST_DOCS, extra: int = EXTRA, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: all ``pair`` rows, and ``term`` rows to ``top``."""
    counts = stored(term_counts(docs), "terms")
    kept = stored(
        counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("__docs"), F.sum("n").alias("lang_n"))
        .where(F.col("__docs") >= least).drop("__docs"), "kept")
    found = stored(counts.where("term <> ''").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "found")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_size"))
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = stored(
        counts.where("term = ''").select("lang", "source").join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
        .fillna(0, ["terms", "lang_size", "size"]), "groups")
    # A language's kept terms go out in blocks, its sources in stretches.
    spread = groups.groupBy("lang").agg(F.count("*").alias("__sources"), F.max("terms").alias("__terms")).select(
        "lang", F.greatest(F.ceil(F.col("__sources") * F.col("__terms") / CELLS), F.lit(1)).cast("int").alias("blocks"),
        F.ceil(F.col("__sources") / STRETCH).cast("int").alias("stretches"))
    groups = stored(groups.join(spread, "lang"), "groups")

    rated = found.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("size"), F.col("terms"), extra))
    over = F.col("p") - share(F.col("lang_n"), F.col("lang_size"), F.col("terms"), extra)
    per_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        rated.select("lang", "source", F.col("term").alias("item"), over.alias("value")).where("value > 0")
        .withColumn("rank", F.row_number().over(per_group)).where(F.col("rank") <= top)
    )
    each = F.explode(F.sequence(F.lit(0), F.col("stretches") - 1))
    left = rated.select(
        "lang", "source", "term", "p", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"),
        each.alias("stretch"))
    right = groups.select(
        "lang", "source", F.coalesce(share(F.lit(0), F.col("size"), F.col("terms"), extra), F.lit(0)).alias("base"),
        F.pmod(F.xxhash64("source"), "stretches").cast("int").alias("own"), "blocks", each.alias("stretch"),
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    key = ["lang", "block", "stretch"]
    pairs = (
        left.groupBy(*key).cogroup(right.groupBy(*key))
        .applyInArrow(_distances, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(per_group))
    )
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*names).unionByName(
        terms.withColumn("part", F.lit("term")).select(*names))


def oracle(least: int = LEAST_DOCS, extra: int = EXTRA, top: int = TOP) -> str:
    def p(count: str, size: str) -> str:
        return f"1 + ({SCALE}::HUGEINT * ({count} + {extra})) // ({size} + {extra} * v)"

    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  g AS (SELECT DISTINCT lang, source FROM d),
  t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {least}),
  l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_size FROM kept GROUP BY lang),
  c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
  s AS (SELECT g.lang, g.source, coalesce(v, 0) AS v, lang_size, coalesce(sum(n), 0) AS size
    FROM g LEFT JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
  p AS (SELECT s.lang, s.source, term, coalesce(n, 0) AS n, {p('coalesce(n, 0)', 'size')} AS p, {p('lang_n', 'lang_size')} AS q
    FROM s JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
  pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL SELECT a.lang, a.source, b.source, 0 FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
  rows AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM rows QUALIFY part = 'pair' OR rank <= {top}"""
