"""Text cleaning as Column expressions.

Two cleaners exist on purpose: ``clean_training`` prepares pages for model building,
``clean_serving`` prepares them at scoring time. Their rules differ, so a model must be
scored with the cleaner it was built with.

The regular expressions run inside whole-stage codegen. Only the stop-word filter is a
higher-order function, and it looks words up in a hash set.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers for paragraph handling. Neither can occur once non-printables are gone.
_BREAK = "\x01"
_KEEP = "\x02"


def english_stop_words() -> list[str]:
    """Spark's own English list (needs a running session)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def keep_printable(c: Column) -> Column:
    """Drop every character outside printable ASCII and the six ASCII blanks."""
    return F.regexp_replace(c, r"[^\x20-\x7E\t\n\r\x0B\f]+", "")


def mark_paragraphs(c: Column) -> Column:
    """Open every paragraph with a marker and fold the newlines inside it to blanks.

    A newline breaks a paragraph when the line before ends with a full stop and the line
    after does not start with a blank. The first paragraph gains one leading blank, which
    decides whether a page number at the very start still counts as a header number.
    """
    t = F.concat(F.lit(f"{_BREAK} "), c)
    t = F.replace(t, F.lit(".\n "), F.lit(f".{_KEEP} "))
    t = F.replace(t, F.lit(".\n"), F.lit(f".{_BREAK}"))
    return F.replace(F.replace(t, F.lit(_KEEP), F.lit(" ")), F.lit("\n"), F.lit(" "))


def last_paragraph(marked: Column) -> Column:
    return F.concat(F.lit(_BREAK), F.substring_index(marked, _BREAK, -1))


# The patterns below match only what they change. A pattern that also matches, say, every
# single blank costs a replacement per word.

def drop_header_number(c: Column) -> Column:
    """Remove digits that open a paragraph, after at most one blank."""
    return F.regexp_replace(c, rf"{_BREAK}\s?\d+", _BREAK)


def strip_blanks(c: Column) -> Column:
    """Remove all kinds of white space at both ends of each paragraph."""
    return F.regexp_replace(F.regexp_replace(c, rf"{_BREAK}\s+", _BREAK), rf"\s+({_BREAK}|\z)", "$1")


def rejoin_hyphens(c: Column) -> Column:
    return F.regexp_replace(c, r"\s?-\s?", "-")


def tighten_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"\s([,:;.])", "$1")


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(c, r"\s{2,}|[\t\n\r\x0B\f]", " ")


def collapse_dots(c: Column) -> Column:
    return F.regexp_replace(c, r"\.{2,}", ".")


def letters_only(lowered: Column) -> Column:
    """Everything but ASCII letters becomes blanks, in a text that is lower case already."""
    return F.regexp_replace(lowered, r"[^a-z ]+", " ")


def drop_phrases(c: Column, phrases: Sequence[str]) -> Column:
    """Delete fixed phrases such as a scanner's stamp (exact, case-sensitive)."""
    return reduce(lambda t, p: F.replace(t, F.lit(p), F.lit("")), phrases, c)


def words(c: Column, stop_words: Sequence[str] = (), plain: bool = False) -> Column:
    """Tokens between white space, never an empty one, without the stop words.

    Stop words match exactly and case-sensitively; punctuation stays attached to its word.
    ``plain`` says that blanks are the only white space there can be.
    """
    wanted = (lambda w: (w != "") & ~w.isin(list(stop_words))) if stop_words else (lambda w: w != "")
    # Tab, newline, vertical tab, form feed, carriage return, and the paragraph marker.
    spaced = c if plain else F.regexp_replace(c, r"[\x01\x09-\x0D]", " ")
    return F.filter(F.split(spaced, " "), wanted)


def training_words(
    c: Column,
    paragraphs: str = "last",
    noise_phrases: Sequence[str] = (),
    stop_words: Sequence[str] | None = None,
) -> Column:
    """Words left by the training-side cleaner.

    ``paragraphs='last'`` keeps only a page's last paragraph (the compatible result),
    ``'all'`` keeps every paragraph (what the rules are evidently meant to do).
    """
    if paragraphs not in ("last", "all"):
        raise ValueError("paragraphs must be 'last' or 'all'")
    stop_words = english_stop_words() if stop_words is None else stop_words
    t = mark_paragraphs(keep_printable(c))
    if paragraphs == "last":
        t = last_paragraph(t)
    t = drop_header_number(t)
    # Cutting the text into words removes extra blanks in any case. They only matter
    # before that when a phrase to delete could meet them.
    if any(p != p.strip() for p in noise_phrases):
        t = strip_blanks(t)
    t = tighten_punctuation(rejoin_hyphens(t))
    if noise_phrases:
        t = collapse_blanks(t)
    t = drop_phrases(collapse_dots(t), noise_phrases)
    return words(t, stop_words)


def serving_words(
    c: Column,
    noise_phrases: Sequence[str] = (),
    stop_words: Sequence[str] | None = None,
) -> Column:
    """Words left by the scoring-side cleaner: lower case, letters only."""
    stop_words = english_stop_words() if stop_words is None else stop_words
    t = letters_only(F.regexp_replace(F.lower(c), r"[,.!?]+", ""))
    if noise_phrases:
        t = drop_phrases(collapse_blanks(t), noise_phrases)
    return words(t, stop_words, plain=True)


def clean_training(c: Column, *args, **kwargs) -> Column:
    """``training_words`` as one text."""
    return F.array_join(training_words(c, *args, **kwargs), " ")


def clean_serving(c: Column, *args, **kwargs) -> Column:
    """``serving_words`` as one text."""
    return F.array_join(serving_words(c, *args, **kwargs), " ")


def split_sentences(c: Column) -> Column:
    """Sentences, cut after ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(c, r"(?<=[.!?])\s+")
