"""Registered queries that go through files, tables and streams."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireflow import contracts
from quireflow.functions import hashing, text, vectors
from quireflow.operators import classify, embed, prepare, score, sequences
from quireflow.plans import features as feature_queries
from quireflow.plans import sqltext as q
from quireflow.plans.tables import document_pages, load, messages, turn_pages
from quireflow.session import fresh_dir, stored
from quireflow.sources import csv_pages, feature_store, tables
from quireflow.streaming import pages as streams
from quireflow.streaming import transitions


def csv_roundtrip(spark, d):
    """All documents through multi-line CSV and back, compared by digest."""
    path = fresh_dir(spark, "csv")
    csv_pages.write_pages(document_pages(spark, d), path, header=False)
    back = csv_pages.read_pages(spark, path, contracts.PAGE)
    return back.select("dcn", "page", "label", hashing.text_key(F.col("text")).alias("digest"))


def sample_files(spark, d):
    """The first 50 rows of each input file. The input: one CSV file per 100 documents,
    each repeating its header once among the data."""
    source, out = fresh_dir(spark, "source"), fresh_dir(spark, "sample")
    docs = load(spark, d, "documents").select(
        F.col("text").alias("Request"), F.col("lang").alias("Label_In"),
        F.col("doc_id").cast("string").alias("ID"), F.lit("page").alias("Type"),
        "doc_id", F.floor(F.col("doc_id") / 100).alias("part"),
    )
    names = ["Request", "Label_In", "ID", "Type"]
    stray = docs.groupBy("part").agg(F.min("doc_id").alias("doc_id")).select(
        *[F.lit(n).alias(n) for n in names], "doc_id", "part"
    )
    (
        docs.unionByName(stray).repartition("part").sortWithinPartitions("part", "doc_id")
        .drop("doc_id").write.partitionBy("part")
        .options(header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(source)
    )
    sampled = csv_pages.sample_files(spark, [f"{source}/*/*.csv"], out, contracts.STREAMED_PAGE)
    part = F.regexp_extract("file", "part_([0-9]+)", 1).cast("bigint")
    return sampled.select(
        "ID", "Label_In", hashing.text_key(F.col("Request")).alias("digest"), part.alias("part"),
        F.approx_count_distinct("file").over(Window.partitionBy(part)).alias("folders"))


def _drop(spark, name, before):
    """Back to the database before; the scratch one goes."""
    spark.catalog.setCurrentDatabase(before)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def table_lifecycle(spark, d):
    """Database, managed table, appended and replaced external tables; their row counts."""
    name = f"quire_{uuid.uuid4().hex[:8]}"
    before = spark.catalog.currentDatabase()
    try:
        tables.use_database(spark, name, fresh_dir(spark, "db"))
        kept = tables.save_table(prepare.bronze(document_pages(spark, d)), f"{name}.bronze")
        cleaned = tables.save_table(prepare.silver(kept), f"{name}.silver")
        path = fresh_dir(spark, "predictions")
        scored = cleaned.select("dcn", "page", F.upper("label").alias("pred_label"))
        for version in (1, 2, 2):  # the last one is a retry, which must not double its rows
            tables.append_predictions(scored, f"{name}.predictions", path, "nightly", version)
        tables.replace_external(spark, f"{name}.replaced", path)
        counts = [
            tables.read_table(spark, f"{name}.{t}").agg(F.lit(t).alias("table"), F.count("*").alias("rows"))
            for t in ("bronze", "silver", "predictions", "replaced")
        ]
        return stored(reduce(DataFrame.unionByName, counts), "counts")
    finally:
        _drop(spark, name, before)


def feature_upsert(spark, d):
    """A keyed table of all turns, then a merge that replaces every answer and adds a copy
    of every question under a new key."""
    name = f"quire_{uuid.uuid4().hex[:8]}"
    tables_dir = fresh_dir(spark, "features")
    before = spark.catalog.currentDatabase()
    keys = ["dcn", "page"]
    turns = turn_pages(spark, d)
    try:
        tables.use_database(spark, name, tables_dir)
        first = turns.select(*keys, F.length("text").alias("chars"), F.lit("first").alias("origin"))
        feature_store.create_feature_table(first, f"{name}.turns", keys, buckets=8)
        changed = turns.where("label = 'assistant'").select(
            *keys, (-F.length("text")).alias("chars"), F.lit("merged").alias("origin")
        )
        added = turns.where("label = 'user'").select(
            F.concat(F.lit("copy-"), "dcn").alias("dcn"), "page",
            F.length("text").alias("chars"), F.lit("merged").alias("origin"),
        )
        return stored(feature_store.merge_features(changed.unionByName(added), f"{name}.turns"), "merged")
    finally:
        _drop(spark, name, before)


def feature_table_embeddings(spark, d):
    """Stacked chunk embeddings of all turns, stored under (dcn, page, segment)."""
    name = f"quire_{uuid.uuid4().hex[:8]}"
    before = spark.catalog.currentDatabase()
    chunks = prepare.gold(prepare.silver(turn_pages(spark, d), "all"), 40, 10, full_split=True, drop_empty=True)
    vecs = embed.hashed_embedding(chunks, text.words(F.col("text_chunk")), digits=1)
    stacked = sequences.stack(vecs, ["dcn", "page"], "index", "embedding")
    try:
        tables.use_database(spark, name, fresh_dir(spark, "embeddings"))
        kept = feature_store.create_feature_table(
            stacked, f"{name}.emb", ["dcn", "page", "segment"], buckets=8
        )
        cells = F.transform(F.flatten("emb"), lambda x: x.cast("double"))
        return stored(kept.select(
            "dcn", "page", "segment", F.size("emb").alias("chunks"),
            F.round(vectors.array_total(cells), 5).alias("total"),
        ), "totals")
    finally:
        _drop(spark, name, before)


def cached_embedding(spark, d):
    """Turns embedded through a table of known vectors: the questions first, then all turns, of
    which only those with new texts reach the model."""
    name = f"quire_{uuid.uuid4().hex[:8]}"
    before = spark.catalog.currentDatabase()

    def load_model():
        import numpy as np

        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts.reshape(-1)], dtype="float32")

    turns = turn_pages(spark, d)
    vector = embed.model_embedding(load_model, "text")
    try:
        tables.use_database(spark, name, fresh_dir(spark, "vectors"))
        embed.cached_embedding(turns.where("label = 'user'"), "text", vector, f"{name}.known", "lengths", buckets=8)
        made = embed.cached_embedding(turns, "text", vector, f"{name}.known", "lengths")
        return stored(made.select(
            "dcn", "page", F.get("embedding", F.lit(0)).cast("int").alias("chars"),
            F.get("embedding", F.lit(1)).cast("int").alias("blanks")), "embedded")
    finally:
        _drop(spark, name, before)


def _scored_stream(spark, d):
    source, sink, marks = (fresh_dir(spark, n) for n in ("pages", "scores", "marks"))
    turns = turn_pages(spark, d)
    model = classify.fit_text_model(turns, "text")
    streamed = turns.select(
        F.col("text").alias("Request"), F.col("label").alias("Label_In"),
        F.concat_ws("/", "dcn", F.col("page").cast("bigint")).alias("ID"), F.lit("turn").alias("Type"),
    )
    csv_pages.write_pages(streamed, source)
    # A multi-line file is one task: the work after it is spread over the cores.
    pages = streams.read_csv_stream(
        spark, f"{source}/*.csv", contracts.STREAMED_PAGE, partitions=spark.sparkContext.defaultParallelism)
    query = streams.score_stream(pages, lambda p: score.score_pages(p, model), sink, marks)
    streams.run_to_end(query)
    streams.stop_all(spark, [query])  # not the caller's own
    return spark.read.parquet(sink)


def stream_scoring(spark, d):
    """All turns streamed from CSV files, scored and appended to a Parquet sink."""
    return _scored_stream(spark, d).select(
        "ID", "Label_In", "pred_label", F.round("pred_score", 6).alias("pred_score")
    )


def stream_medallion(spark, d):
    """Documents streamed through Bronze, Silver and Gold; counts per label."""
    source, bronze, silver, gold = (fresh_dir(spark, n) for n in ("in", "bronze", "silver", "gold"))
    marks = fresh_dir(spark, "marks")
    document_pages(spark, d).repartition(4).write.parquet(source)
    pages = spark.readStream.schema(contracts.PAGE).option("maxFilesPerTrigger", 1).parquet(source)
    streams.run_to_end(streams.bronze_stream(pages, bronze, f"{marks}/b"))
    streams.run_to_end(streams.silver_stream(
        spark, bronze, contracts.PAGE, silver, f"{marks}/s", paragraphs="all"))
    cleaned = spark.read.parquet(silver)
    streams.run_to_end(streams.gold_stream(
        spark, silver, cleaned.schema, gold, f"{marks}/g", full_split=True, drop_empty=True))
    return prepare.chunk_stats(spark.read.parquet(gold), "label")


def stream_transitions(spark, d):
    """Event messages streamed in three runs of one checkpoint, each bringing a third of the
    events in no order of time: each version's stage, and its accepted events."""
    source, moves, routes, marks = (fresh_dir(spark, n) for n in ("events", "moves", "routes", "marks"))
    events = load(spark, d, "events").select("event_id", "ts", (F.col("value") < 20).alias("archive_existing"))
    arriving = messages(spark, d).join(events, "event_id")
    schema = arriving.schema
    for third in range(3):
        arriving.where(F.col("event_id") % 3 == third).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streams.run_to_end(transitions.transitions_stream(stream, moves, f"{marks}/moves"))
        streams.run_to_end(streams.append_stream(transitions.routed(stream), routes, f"{marks}/routes"))
    accepted = spark.read.parquet(routes).where("reason = 'accepted'").groupBy("model_name", "version").agg(
        F.count("*").alias("accepted"))
    return transitions.current_stages(spark.read.parquet(moves)).join(accepted, ["model_name", "version"], "full")


QUERIES = {
    f.__name__: f for f in (
        csv_roundtrip, sample_files, table_lifecycle, feature_upsert, feature_table_embeddings,
        cached_embedding, stream_scoring, stream_medallion, stream_transitions,
    )
}


def oracles() -> dict[str, str]:
    silver_all = f"(SELECT dcn, page, label, {q.clean_all('text')} AS text_processed FROM {q.BRONZE})"
    return {
        "csv_roundtrip": f"SELECT dcn, page, label, sha256(text) AS digest FROM {q.DOC_PAGES}",
        "sample_files": """SELECT doc_id::VARCHAR AS "ID", lang AS "Label_In", sha256(text) AS digest,
          doc_id // 100 AS part, 1::BIGINT AS folders FROM
          (SELECT *, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 50""",
        "table_lifecycle": f"""SELECT unnest(['bronze', 'silver', 'predictions', 'replaced']) AS "table",
          unnest([n, n, 2 * n, 2 * n])::BIGINT AS "rows" FROM (SELECT count(*) AS n FROM {q.BRONZE})""",
        "feature_upsert": """SELECT conv_id::VARCHAR AS dcn, turn::DOUBLE AS page,
            CASE WHEN role = 'assistant' THEN -length(text) ELSE length(text) END::INT AS chars,
            CASE WHEN role = 'assistant' THEN 'merged' ELSE 'first' END AS origin FROM conversations
          UNION ALL SELECT 'copy-' || conv_id, turn::DOUBLE, length(text)::INT, 'merged' FROM conversations
          WHERE role = 'user'""",
        "feature_table_embeddings": feature_queries.stacked_sql(),
        "cached_embedding": """SELECT conv_id::VARCHAR AS dcn, turn::DOUBLE AS page, length(text)::INT AS chars,
          (length(text) - length(replace(text, ' ', '')))::INT AS blanks FROM conversations""",
        "stream_scoring": f"""WITH {q.bayes(q.TURN_PAGES)} SELECT dcn || '/' || page::BIGINT AS "ID", label AS "Label_In",
          upper(predicted) AS pred_label, round(score, 6) AS pred_score FROM scored""",
        "stream_transitions": """WITH m AS (SELECT 'model_' || user_id AS model_name, json_extract_string(props, '$.k') AS version,
            CASE event_type WHEN 'purchase' THEN 'Production' ELSE 'Staging' END AS to_stage, row(ts, event_id) AS w, value < 20 AS clears
            FROM events WHERE event_type IN ('purchase', 'signup')),
          l AS (SELECT model_name, version, arg_max(to_stage, w) AS stage, max(w) AS w, count(*) AS accepted FROM m GROUP BY ALL),
          s AS (SELECT model_name, to_stage AS stage, max(w) AS swept FROM m WHERE clears GROUP BY ALL)
          SELECT model_name, version, CASE WHEN swept > w THEN 'Archived' ELSE stage END AS stage, accepted
          FROM l LEFT JOIN s USING (model_name, stage)""",
        "stream_medallion": f"""SELECT label, count(*) AS chunks, sum(("index" = 1)::INT)::BIGINT AS pages,
          sum(len({q.tokens('text_chunk', False)}))::BIGINT AS words
          FROM {q.chunk_rows(silver_all, 'text_processed', 200, 50, True, drop_empty=True)} GROUP BY label""",
    }
