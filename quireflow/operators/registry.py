"""Training runs, model versions and stage moves kept as plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIVE_STAGES = ["Staging", "Production"]


def metric_rows(df: DataFrame, run_id: str, by: str, **metrics: Column) -> DataFrame:
    """Long rows ``(run_id, step, metric, value)``: the metrics of each group of ``by``."""
    wide = df.groupBy(by).agg(*[c.cast("double").alias(n) for n, c in metrics.items()])
    return wide.select(
        F.lit(run_id).alias("run_id"), F.col(by).cast("string").alias("step"),
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in metrics
        ])).alias("m"),
    ).select("run_id", "step", "m.metric", "m.value")


def best_run(runs: DataFrame, metric: str = "test_acc") -> DataFrame:
    """The one run with the highest non-negative metric; ties go to the smaller run id."""
    return runs.where(F.col(metric) >= 0).orderBy(F.col(metric).desc(), "run_id").limit(1)


def best_run_per(runs: DataFrame, group: str, metric: str = "test_acc") -> DataFrame:
    """The same per group, combined before the exchange."""
    best = F.min_by(F.struct("run_id", metric), F.struct(-F.col(metric), F.col("run_id")))
    return (
        runs.where(F.col(metric) >= 0).groupBy(group).agg(best.alias("_b"))
        .select(group, "_b.run_id", f"_b.{metric}")
    )


def latest_versions(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Newest version per model, versions compared as numbers; optionally of one stage."""
    if stage is not None:
        versions = versions.where(F.col("stage") == stage)
    rest = [c for c in versions.columns if c != "name"]
    newest = F.max_by(F.struct(*rest), F.col("version").cast("bigint"))
    return versions.groupBy("name").agg(newest.alias("_v")).select("name", "_v.*")


def ready_versions(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("status") == "READY")


def require_latest(versions: DataFrame, name: str, stage: str | None = None):
    """The newest version of one model as a Row; fails when there is none."""
    found = latest_versions(versions.where(F.col("name") == name), stage).first()
    if found is None:
        raise LookupError(f"no version of {name!r} in stage {stage!r}")
    return found


def apply_transitions(versions: DataFrame, moves: DataFrame) -> DataFrame:
    """Stages after all moves, each archiving the versions it displaces.

    ``moves`` has ``(name, version, to_stage, ts, move_id, archive_existing)``. A version
    stands where its last move put it, unless a later move of the same model into that
    stage archived it. Two small aggregates and their joins; no per-model history is
    gathered anywhere.
    """
    at = F.struct("ts", "move_id")
    last = moves.groupBy("name", "version").agg(
        F.max_by("to_stage", at).alias("_to"), F.max(at).alias("_at")
    )
    displacing = (
        moves.where(F.col("archive_existing") & F.col("to_stage").isin(ACTIVE_STAGES))
        .groupBy("name", F.col("to_stage").alias("_stage")).agg(F.max(at).alias("_sweep"))
    )
    stood = versions.join(last, ["name", "version"], "left").withColumn(
        "_stage", F.coalesce("_to", "stage")
    )
    swept = F.col("_sweep").isNotNull() & (
        F.col("_at").isNull() | (F.col("_sweep") > F.col("_at"))
    )
    return (
        stood.join(displacing, ["name", "_stage"], "left")
        .withColumn("stage", F.when(swept, "Archived").otherwise(F.col("_stage")))
        .select(*versions.columns)
    )


def run_params(params: DataFrame) -> DataFrame:
    """Parameters as rows ``(run_id, key, value)``, one per run and key (the greatest value)."""
    return params.groupBy("run_id", "key").agg(F.max("value").alias("value"))


def params_of(params: DataFrame, run_id) -> dict[str, str]:
    """The parameters of one chosen run, for configuring a job."""
    rows = run_params(params.where(F.col("run_id") == F.lit(run_id))).collect()
    return {r["key"]: r["value"] for r in rows}


def production_params(versions: DataFrame, params: DataFrame) -> DataFrame:
    """Parameter rows behind each model's newest Production version; a version whose run
    logged none has one row without key."""
    newest = latest_versions(versions, "Production").select("name", "version", "run_id")
    wanted = params.join(newest.select("run_id").distinct(), "run_id", "left_semi")
    return newest.join(run_params(wanted), "run_id", "left").select(
        "name", "version", "run_id", "key", "value"
    )
