"""Registered queries: runs, versions, events, parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from quireflow.functions import events
from quireflow.operators import prepare, registry, tabular
from quireflow.plans.tables import (
    MOVES_SQL, RUNS_SQL, VERSIONS_SQL, load, messages, moves, runs, versions,
)


def best_run(spark, d):
    return registry.best_run(runs(spark, d))


def best_run_per_experiment(spark, d):
    return registry.best_run_per(runs(spark, d), "experiment")


def latest_version(spark, d):
    return registry.latest_versions(versions(spark, d))


def latest_production(spark, d):
    return registry.latest_versions(versions(spark, d), "Production")


def ready_versions(spark, d):
    return registry.ready_versions(versions(spark, d))


def stage_transitions(spark, d):
    return registry.apply_transitions(versions(spark, d), moves(spark, d)).select("name", "version", "stage")


def parse_events(spark, d):
    """Messages resolved to model, version and stage; unusable ones take the defaults."""
    parsed = messages(spark, d).withColumn("p", events.parse_message(F.col("message")))
    resolved = events.resolve_transition(
        F.col("p"), F.lit("fallback"), F.col("event_id").cast("string"), F.lit("Staging")
    )
    return parsed.select("event_id", resolved.alias("r")).select("event_id", "r.*")


def route_events(spark, d):
    parsed = messages(spark, d).withColumn("p", events.parse_message(F.col("message")))
    return parsed.select("event_id", events.route(F.col("p")).alias("r")).select(
        "event_id", F.coalesce("r.target", F.lit(-1)).alias("target"), "r.reason"
    )


def _params(spark, d):
    """Logged parameters read off ``lineitem``: a run per order, a key per line."""
    return load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("p"), F.col("l_linenumber").cast("string")).alias("key"),
        F.col("l_quantity").cast("int").cast("string").alias("value"),
    )


def params_map(spark, d):
    return registry.run_params(_params(spark, d))


def production_params(spark, d):
    return registry.production_params(versions(spark, d), _params(spark, d))


def column_list_parse(spark, d):
    """List literals stored as text, one per order, parsed to arrays."""
    stored = F.concat(
        F.lit("['"), F.col("o_orderstatus"), F.lit("', '"), F.col("o_orderpriority"), F.lit("']")
    )
    parsed = load(spark, d, "orders").select("o_orderkey", tabular.column_list(stored).alias("cols"))
    return parsed.select(
        "o_orderkey", F.size("cols").alias("n"), F.get("cols", F.lit(0)).alias("first_name"),
        F.get("cols", F.lit(1)).alias("second_name"),
    )


def stray_headers(spark, d):
    """Rows that repeat the column's own name, here ``view``, drop out."""
    kinds = load(spark, d, "events").select("event_id", F.col("event_type").alias("view"))
    return prepare.drop_stray_headers(kinds, "view")


QUERIES = {
    f.__name__: f for f in (
        best_run, best_run_per_experiment, latest_version, latest_production, ready_versions,
        stage_transitions, parse_events, route_events, params_map, production_params,
        column_list_parse, stray_headers,
    )
}


def oracles() -> dict[str, str]:
    latest = """SELECT name, arg_max(version, version::BIGINT) AS version, arg_max(stage, version::BIGINT) AS stage,
      arg_max(status, version::BIGINT) AS status, arg_max(run_id, version::BIGINT) AS run_id FROM {} GROUP BY name"""
    params = """(SELECT l_orderkey AS run_id, 'p' || l_linenumber AS key, max(l_quantity::INT::VARCHAR) AS value
      FROM lineitem GROUP BY ALL)"""
    production = latest.format(f"(SELECT * FROM {VERSIONS_SQL} WHERE stage = 'Production')")
    k = "json_extract_string(props, '$.k')"
    return {
        "best_run": f"SELECT * FROM {RUNS_SQL} WHERE test_acc >= 0 ORDER BY test_acc DESC, run_id LIMIT 1",
        "best_run_per_experiment": f"""SELECT experiment, run_id, test_acc FROM (SELECT *, row_number() OVER
          (PARTITION BY experiment ORDER BY test_acc DESC, run_id) AS rn FROM {RUNS_SQL} WHERE test_acc >= 0) WHERE rn = 1""",
        "latest_version": latest.format(VERSIONS_SQL),
        "latest_production": production,
        "ready_versions": f"SELECT * FROM {VERSIONS_SQL} WHERE status = 'READY'",
        "stage_transitions": f"""WITH m AS (SELECT * FROM {MOVES_SQL}),
          l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, version ORDER BY ts DESC, move_id DESC) AS rn
            FROM m) WHERE rn = 1),
          s AS (SELECT v.name, v.version, coalesce(l.to_stage, v.stage) AS stage, l.ts, l.move_id
            FROM {VERSIONS_SQL} v LEFT JOIN l USING (name, version))
          SELECT name, version, CASE WHEN EXISTS (SELECT 1 FROM m WHERE m.name = s.name AND m.to_stage = s.stage
              AND m.archive_existing AND m.to_stage IN ('Staging', 'Production')
              AND (s.ts IS NULL OR m.ts > s.ts OR (m.ts = s.ts AND m.move_id > s.move_id)))
            THEN 'Archived' ELSE stage END AS stage FROM s""",
        "parse_events": f"""SELECT event_id,
          CASE WHEN event_type = 'error' THEN 'fallback' ELSE 'model_' || user_id END AS model_name,
          CASE WHEN event_type = 'error' THEN event_id::VARCHAR ELSE {k} END AS version,
          CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'click' THEN 'Archived'
            WHEN 'view' THEN NULL ELSE 'Staging' END AS stage,
          CASE event_type WHEN 'error' THEN 'defaults' WHEN 'view' THEN 'invalid' ELSE 'payload' END AS origin FROM events""",
        "route_events": """SELECT event_id,
          CASE event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE -1 END AS target,
          CASE event_type WHEN 'error' THEN 'no event' WHEN 'click' THEN 'other event' WHEN 'view' THEN 'no stage'
            ELSE 'accepted' END AS reason FROM events""",
        "params_map": f"SELECT * FROM {params}",
        "production_params": f"""SELECT p.name, p.version, p.run_id, x.key, x.value FROM ({production}) p
          LEFT JOIN {params} x USING (run_id)""",
        "column_list_parse": """SELECT o_orderkey, 2::INT AS n, o_orderstatus AS first_name,
          o_orderpriority AS second_name FROM orders""",
        "stray_headers": "SELECT event_id, event_type AS \"view\" FROM events WHERE event_type <> 'view'",
    }
