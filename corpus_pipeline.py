"""The training-text pipeline: five stages over ``documents``, each stored before the next.

Every stage takes all rows its predecessor kept and returns the columns it was given:

1. ``quality``: rows that the classifier puts into class 0 go. It learns from the labels of
   rows whose crc32(doc_id) mod 3 is not 1.
2. ``near_dedup``: one row of each class of near-duplicates stays, that of the smallest id.
3. ``substring_dedup``: words in windows that a smaller ``doc_id`` has go; texts without such
   words stay as they are. A text may become empty; its row stays.
4. ``decontaminate``: rows with a twentieth or more of their words in benchmark phrases go.
5. ``mix``: each row as often as the mix of sources takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm import decontaminate as contamination
from quireflow.llm import mixing, neardup, substrings
from quireflow.llm import quality as classifier
from quireflow.llm.common import load, remainder, set_aside, stored

ORACLE_SQL = None  # a fitted classifier and hashed near-duplicates are beyond SQL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
    return classifier.accepted(docs, classifier.fit(classifier.features(docs), labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held, back = set_aside(docs, "doc_id", "text", "n_chars")
    cut = F.col("__n_removed") > 0
    left = substrings.remove_repeats(held).withColumn("text", F.when(cut, F.col("__kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")))
    return back(left.select(*held.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held, back = set_aside(docs, "doc_id", "text")
    found = contamination.verdicts(contamination.find(held, load(spark, sf_dir, "benchmark")))
    return back(found.filter(~F.col("__contaminated")).select(*held.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
