"""Checks before a model moves on, and the decision they lead to."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.session import stored

# The comments that go with the two decisions.
ACCEPTED = "All tests passed!  Moving to {stage}."
REJECTED = "Tests failed, moving to archived.  Check the job run to see what happened."


def schema_matches(df: DataFrame, contract: T.StructType) -> bool:
    """Does the frame offer every column of the contract, in its type?"""
    have = {f.name: f.dataType for f in df.schema.fields}
    return all(have.get(f.name) == f.dataType for f in contract.fields)


@dataclass(frozen=True)
class Scored:
    """Scored rows as stored, and what was counted while they were written."""

    rows: DataFrame
    out: int
    bare: int
    wild: int


def store_scored(scored: DataFrame) -> Scored:
    """Run the scoring once: the rows are stored, and rows, missing labels and scores out of
    range are counted on the way."""
    label = F.col("pred_label") if "pred_label" in scored.columns else F.lit(None).cast("string")
    number = F.col("pred_score").cast("double") if "pred_score" in scored.columns else F.lit(None).cast("double")
    watch = Observation()
    rows = stored(scored.observe(
        watch, F.count(F.lit(1)).alias("out"), F.count_if(label.isNull()).alias("bare"),
        F.count_if(~F.coalesce(number.between(0.0, 1.0), F.lit(False))).alias("wild")), "scored")
    return Scored(rows, **watch.get)


def check_rows(
    pages: DataFrame, scored: DataFrame | Scored, contract: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """One row per check ``(check, ok, detail)`` about a scored set of pages.

    Counts come from the scoring pass itself (``store_scored``, done here if it has not been).
    Only the keys are read again: both sides are counted per key in one aggregate over their
    union, so a lost row is not made up for by a doubled one.
    """
    if isinstance(scored, DataFrame):
        scored = store_scored(scored)
    keys = list(keys)
    zero = F.lit(0).cast("bigint")
    fits = schema_matches(scored.rows, contract)
    sides = pages.select(*keys, F.lit(1).alias("side")).unionByName(scored.rows.select(*keys, F.lit(-1).alias("side")))
    gaps = sides.groupBy(*keys).agg(F.sum("side").alias("gap"))
    facts = gaps.agg(*[F.coalesce(F.sum(c), zero).alias(n) for n, c in {
        "lost": F.greatest("gap", zero), "extra": F.greatest(-F.col("gap"), zero)}.items()]).withColumns(
        {n: F.lit(getattr(scored, n)).cast("bigint") for n in ("out", "bare", "wild")})

    def check(name: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), ok.alias("ok"), detail.cast("string").alias("detail"))

    return facts.select(F.explode(F.array(
        check("schema", F.lit(fits), F.lit("Schema OK" if fits else "Schema validation failed")),
        check("not_empty", F.col("out") > 0, F.col("out")),
        check("rows_kept", F.col("lost") == 0, F.col("lost")),
        check("no_extra_rows", F.col("extra") == 0, F.col("extra")),
        check("labels_present", F.col("bare") == 0, F.col("bare")),
        check("scores_in_range", F.col("wild") == 0, F.col("wild")),
    )).alias("c")).select("c.*")


def decide(checks: DataFrame, stage: str) -> DataFrame:
    """``(decision, comment)``: approve only if every check holds."""
    good = F.coalesce(F.bool_and("ok"), F.lit(False))
    return checks.agg(good.alias("_ok")).select(
        F.when(F.col("_ok"), "approve").otherwise("reject").alias("decision"),
        F.when(F.col("_ok"), ACCEPTED.format(stage=stage)).otherwise(REJECTED).alias("comment"),
    )


def is_empty(df: DataFrame) -> bool:
    """Reads no more than it takes to see one row."""
    return df.isEmpty()


def empty_predictions(spark, contract: T.StructType) -> DataFrame:
    """What a failed scoring run stands for: the prediction columns without rows."""
    return spark.createDataFrame([], contract)


def predictions_or_empty(spark, run: Callable[[], DataFrame], contract: T.StructType) -> DataFrame:
    """The scored rows, stored, or the empty frame if scoring fails or gives none."""
    try:
        scored = stored(run(), "scored")
    except PySparkException:
        return empty_predictions(spark, contract)
    return empty_predictions(spark, contract) if is_empty(scored) else scored
