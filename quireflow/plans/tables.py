"""The test tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A phrase that does occur in the generated texts, to exercise phrase removal.
NOISE = ("of the",)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as page records: source is the control number, doc_id the page."""
    return load(spark, folder, "documents").select(
        "text", F.col("lang").alias("label"), F.col("source").alias("dcn"),
        F.col("doc_id").cast("double").alias("page"),
    )


def turn_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``conversations`` as page records: conversation and turn are the key, role the label."""
    return load(spark, folder, "conversations").select(
        "text", F.col("role").alias("label"), F.col("conv_id").cast("string").alias("dcn"),
        F.col("turn").cast("double").alias("page"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Training runs read off ``orders``: some metrics are negative, many tie."""
    metric = F.when(F.col("o_orderstatus") == "P", F.lit(-1.0)).otherwise(
        (F.round(F.col("o_totalprice") * 100).cast("bigint") % 1000) / F.lit(1000.0)
    )
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("experiment"),
        metric.alias("test_acc"),
    )


RUNS_SQL = """(SELECT o_orderkey AS run_id, o_orderpriority AS experiment,
  CASE WHEN o_orderstatus = 'P' THEN -1.0::DOUBLE
       ELSE (round(o_totalprice * 100)::BIGINT % 1000) / 1000.0::DOUBLE END AS test_acc
  FROM orders)"""


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Model versions read off ``orders``: a model per customer and month of the year,
    the version number kept as text."""
    status = F.col("o_orderstatus")
    return load(spark, folder, "orders").select(
        F.concat_ws("-", "o_custkey", F.month("o_orderdate")).alias("name"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.when(status == "F", "Production").when(status == "O", "Staging")
        .otherwise("None").alias("stage"),
        F.when(F.col("o_orderpriority") == "5-LOW", "PENDING_REGISTRATION")
        .otherwise("READY").alias("status"),
        F.col("o_orderkey").alias("run_id"),
    )


VERSIONS_SQL = """(SELECT o_custkey::VARCHAR || '-' || month(o_orderdate)::VARCHAR AS name,
  o_orderkey::VARCHAR AS version,
  CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'None' END AS stage,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'PENDING_REGISTRATION' ELSE 'READY' END AS status,
  o_orderkey AS run_id FROM orders)"""


def moves(spark: SparkSession, folder: str) -> DataFrame:
    """Stage moves: every event moves the version with its number."""
    kind = F.col("event_type")
    stage = (
        F.when(kind.isin("purchase", "click"), "Production").when(kind == "signup", "Staging")
        .when(kind == "error", "Archived").otherwise("None")
    )
    events = load(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("version"), stage.alias("to_stage"), "ts",
        F.col("event_id").alias("move_id"), (F.col("value") < 20).alias("archive_existing"),
    )
    names = versions(spark, folder).select("name", "version")
    return events.join(names, "version")


MOVES_SQL = f"""(SELECT v.name, v.version,
  CASE WHEN event_type IN ('purchase', 'click') THEN 'Production' WHEN event_type = 'signup' THEN 'Staging'
       WHEN event_type = 'error' THEN 'Archived' ELSE 'None' END AS to_stage,
  ts, event_id AS move_id, value < 20 AS archive_existing
  FROM events JOIN {VERSIONS_SQL} v ON v.version = event_id::VARCHAR)"""


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Event messages as JSON text: complete, without stage, of another kind, for another
    stage, or broken."""
    kind = F.col("event_type")
    parts = F.struct(
        F.when(kind == "click", "COMMENT_CREATED")
        .otherwise("MODEL_VERSION_TRANSITIONED_STAGE").alias("event"),
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model_name"),
        F.get_json_object("props", "$.k").alias("version"),
        F.when(kind == "purchase", "Production").when(kind == "signup", "Staging")
        .when(kind == "click", "Archived").alias("to_stage"),
    )
    body = F.when(kind == "error", F.concat(F.lit("{broken "), "props")).otherwise(F.to_json(parts))
    return load(spark, folder, "events").select("event_id", body.alias("message"))
