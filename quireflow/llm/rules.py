"""Operator 12: quality rules as a learned decision list.

Each text is measured once, within its row. Rules are learned from labelled statistics by
sequential covering: a rule grows by the threshold condition of most information gain until it
covers no good text of the growing part, is pruned back to the prefix that does best on the
pruning part, and stays if nearly all it covers there is bad. What it covers is taken away and
the next rule is learned from the rest. The list comes out as one Spark conditional expression,
whose branches stand in the order learned; a text that no rule meets is kept.

Learning uses at most ``SAMPLE`` labelled rows, those first in order of a checksum of the id,
of texts that pass the base rule. The base rule drops texts of fewer than ``LEAST_WORDS`` words
and those with more than ``MOST_REPEATED`` per cent of their words in repeated windows.

Ids, languages and sources are no statistics. Defined cases: a null text is empty; an empty text
has all statistics 0 and fails the base rule; a document with several labels has their mean,
rounded; null labels are ignored; without labels, or with one class only, no rule is learned;
an empty table gives an empty result. Other columns are carried along by ``keep_good`` and may
have any names but those of ``COUNTS`` behind two underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.llm import packed
from quireflow.llm.common import text_or_empty

SAMPLE = 20_000
LEAST_WORDS, MOST_REPEATED, REPEAT_WINDOW = 10, 20, 5
MOST_RULES, MOST_CONDITIONS = 20, 4
LEAST_COVERED, LEAST_PRECISION = 5, 0.95
U64 = np.uint64

#: Counts of a text; lines are those with a word.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks", "n_marked_words", "n_short_words", "n_distinct_words", "longest_word"]
#: What rules may look at: a name, and the two counts it is the ratio of.
RATIOS = {
    "words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"), "repeated_words": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"), "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"), "marked_words": ("n_marked_words", "n_words"),
    "short_words": ("n_short_words", "n_words"), "distinct_words": ("n_distinct_words", "n_words"),
    "longest_word": ("longest_word", None),
}
_KINDS = {"n_symbols": b"#*$%&|<>", "n_upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n_digits": b"0123456789", "n_marks": b"!?"}
_PRIMES = (U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93))  # odd multipliers that spread ids


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, which may be empty."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return total[ends[1:]] - total[ends[:-1]]


def repeated(ids: np.ndarray, lengths: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Marks the words of each text that lie in a window found twice or more in that text.

    ``ids`` are the words' numbers, equal for equal words only. Windows are ordered by a hash;
    neighbours of one hash are compared word by word."""
    ends = np.cumsum(lengths)
    texts = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(np.repeat(ends, lengths) - np.arange(len(ids)) >= window)
    covered = np.zeros(len(ids) + 1, np.int64)
    if not len(at):
        return covered[:-1] > 0
    key = texts[at].astype(U64) * _PRIMES[1]
    for j in range(window):
        key = (key + ids[at + j].astype(U64) + U64(1)) * _PRIMES[0]
        key ^= key >> U64(29)

    def same_windows(order: np.ndarray) -> np.ndarray:
        a, b = at[order[1:]], at[order[:-1]]
        return reduce(lambda x, j: x & (ids[a + j] == ids[b + j]), range(window), texts[a] == texts[b])

    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    real = same_windows(order)
    if (same & ~real).any():  # two windows of one hash: order by the words themselves
        order = np.lexsort([ids[at + j] for j in range(window)] + [texts[at]])
        real = same_windows(order)
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= real
    twice[order[:-1]] |= real
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + window, -1)
    return np.cumsum(covered[:-1]) > 0


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts.slice(0, 0), texts])  # a copy: offsets begin at 0
    n = len(texts)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[:n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[:ends[-1]] if data and ends[-1] else np.zeros(0, np.uint8)
    out = {}
    for name, kind in _KINDS.items():
        table = np.zeros(256, bool)
        table[list(kind)] = True
        out[name] = _sums(table[raw], np.diff(ends))
    words, lengths = packed.words_of(texts)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Measures of a word are worked out once for each distinct one.
    names = coded.dictionary
    size = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    marked = pc.match_substring_regex(names, r"[#*$%&|<>!?]$").to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(n), lengths)
    first = np.unique(of * max(1, len(names)) + ids) // max(1, len(names))
    longest = np.zeros(n, np.int64)
    some = np.flatnonzero(lengths)
    if len(some):
        longest[some] = np.maximum.reduceat(size[ids], (np.cumsum(lengths) - lengths)[some])
    lines = pc.split_pattern(texts, "\n")
    line_of = np.repeat(np.arange(n), np.diff(lines.offsets.to_numpy()))
    flat = lines.flatten()
    real = pc.not_equal(pc.ascii_trim_whitespace(flat), "")
    line_of = line_of[real.to_numpy(zero_copy_only=False)]
    line_ids = flat.filter(real).dictionary_encode()
    distinct = np.unique(line_of * max(1, len(line_ids.dictionary)) + line_ids.indices.to_numpy(zero_copy_only=False))
    n_lines = np.bincount(line_of, minlength=n)
    out |= {
        "n_words": lengths, "word_chars": _sums(size[ids], lengths), "n_lines": n_lines,
        "n_dup_lines": n_lines - np.bincount(distinct // max(1, len(line_ids.dictionary)), minlength=n),
        "n_repeat_words": _sums(repeated(ids, lengths), lengths), "n_marked_words": _sums(marked[ids], lengths),
        "n_short_words": _sums((size <= 3)[ids], lengths), "n_distinct_words": np.bincount(first, minlength=n),
        "longest_word": longest,
    }
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, plus the ``COUNTS`` of it behind two underscores."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    others = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in packed.slices(batches):
            found = counts(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(f.name) for f in others], *[pa.array(found[c].astype(np.int64)) for c in COUNTS]],
                names=[*[f.name for f in others], *[f"__{c}" for c in COUNTS]])

    return docs.mapInArrow(run, T.StructType([*others, *[T.StructField(f"__{c}", T.LongType()) for c in COUNTS]]))


def base_failed() -> Column:
    return (F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words"))


def statistic(name: str) -> Column:
    """A statistic that rules look at; a ratio over nothing is 0."""
    above, below = RATIOS[name]
    value = F.col(f"__{above}").cast("double")
    return F.when(F.col(f"__{below}") > 0, value / F.col(f"__{below}")).otherwise(0.0) if below else value


# Learning

@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        return statistic(self.name) > self.threshold if self.above else statistic(self.name) <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, rows: np.ndarray) -> np.ndarray:
    names = list(RATIOS)
    return reduce(lambda a, c: a & c.holds(rows[:, names.index(c.name)]), rule, np.ones(len(rows), bool))


def _best_condition(rows: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The condition of most gain: bad rows covered, times the bits that each comes to need less."""
    p, n = int(bad.sum()), int((~bad).sum())
    before, best, gain = np.log2(p / (p + n)), None, 1e-9
    for f, name in enumerate(RATIOS):
        order = np.argsort(rows[:, f], kind="stable")
        values, hits = rows[order, f], np.cumsum(bad[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])  # between two different values
        for above in (False, True):
            pos = p - hits[cuts] if above else hits[cuts]
            size = len(values) - (cuts + 1) if above else cuts + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                worth = np.where(pos > 0, pos * (np.log2(pos / size) - before), 0.0)
            if len(worth) and worth.max() > gain:
                at = cuts[int(worth.argmax())]
                gain, best = float(worth.max()), Condition(name, above, float((values[at] + values[at + 1]) / 2))
    return best


def _grown(rows: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    covered = np.ones(len(rows), bool)
    while len(rule) < MOST_CONDITIONS and bad[covered].any() and (~bad[covered]).any():
        more = _best_condition(rows[covered], bad[covered])
        if more is None:
            break
        rule += (more,)
        covered = _covers(rule, rows)
    return rule


def _pruned(rule: Rule, rows: np.ndarray, bad: np.ndarray) -> Rule:
    """The prefix that tells bad from good rows best; the shortest among equals."""
    def value(prefix: Rule) -> float:
        covered = _covers(prefix, rows)
        p, n = int(bad[covered].sum()), int((~bad[covered]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=value) if rule else rule


def learn(rows: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Rules that cover bad rows; every third row is for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(rows), bool)
    pruning = np.arange(len(rows)) % 3 == 2
    while len(rules) < MOST_RULES:
        grow, prune = left & ~pruning, left & pruning
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _pruned(_grown(rows[grow], bad[grow]), rows[prune], bad[prune])
        if not rule:
            break
        covered = _covers(rule, rows)
        seen, hits = int((covered & prune).sum()), int((covered & prune & bad).sum())
        if seen < LEAST_COVERED or hits < LEAST_PRECISION * seen:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(measured: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """Rules from measured documents (stored) and ``labels``: ``doc_id`` and ``label``, 0 is bad."""
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.avg(label) < 0.5).alias("__bad"))
    order = F.crc32(F.concat(F.lit("rules"), text_or_empty(F.col("doc_id").cast("string"))).cast("binary"))
    rows = measured.where(~base_failed()).select(
        F.col("doc_id").cast("long").alias("doc_id"), *[statistic(s).alias(s) for s in RATIOS],
    ).join(marks, "doc_id").withColumn("__order", order)
    # A bound on the checksum leaves little more than the sample, so tasks send little.
    below = int(2**32 * min(1.0, 1.3 * sample / max(1, rows.count())))
    taken = rows.where(F.col("__order") < below).orderBy("__order", "doc_id", *RATIOS).limit(sample).toPandas()
    return learn(taken[list(RATIOS)].to_numpy(np.float64), taken["__bad"].to_numpy(bool))


# The list as a Spark expression

def rule_number(rules: list[Rule]) -> Column:
    """The first rule that a measured document meets, from 1; 0 if it meets none."""
    number = F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        number = F.when(reduce(lambda a, b: a & b, [c.column() for c in rule]), k).otherwise(number)
    return number


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(map(str, rule)) for rule in rules]


def judged(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """``measured`` plus ``__base_failed, __rule, __kept``."""
    return measured.withColumn("__base_failed", base_failed()).withColumn(
        "__rule", F.when(F.col("__base_failed"), 0).otherwise(rule_number(rules))
    ).withColumn("__kept", ~F.col("__base_failed") & (F.col("__rule") == 0))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor a learned one drops."""
    held = docs.select(F.struct("*").alias("__row"), F.col("text").cast("string").alias("text"))
    return judged(measure(held), rules).where("__kept").select("__row.*")
