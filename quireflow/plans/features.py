"""Registered queries: embeddings, sequences, padding, pooling, soft-max."""

from __future__ import annotations

from pyspark.sql import functions as F

from quireflow.functions import text, vectors
from quireflow.operators import embed, prepare, sequences
from quireflow.plans import sqltext as q
from quireflow.plans.tables import document_pages, load, turn_pages
from quireflow.session import stored


def hashed_embeddings(spark, d):
    """The non-zero entries of every turn's embedding."""
    tokens = text.serving_words(F.col("text"))
    cells = embed.hashed_embedding(turn_pages(spark, d), tokens).select(
        "dcn", "page", F.posexplode("embedding").alias("dim", "v")
    )
    return cells.where("v <> 0").select(
        "dcn", "page", "dim", F.round(F.col("v").cast("double"), 6).alias("value")
    )


def _turn_chunks(spark, d):
    return prepare.gold(prepare.silver(turn_pages(spark, d), "all"), 40, 10, full_split=True, drop_empty=True)


def stack_chunks(spark, d):
    stacked = sequences.stack(_turn_chunks(spark, d), ["dcn", "page", "label"], "index", "text_chunk", "chunks")
    return stacked.select("dcn", "page", "label", "segment", F.array_join("chunks", " | ").alias("chunks"))


def stack_segments(spark, d):
    """Long pages come out in several ordered pieces."""
    chunks = prepare.gold(prepare.silver(document_pages(spark, d), "all"), 40, 10, full_split=True, drop_empty=True)
    stacked = sequences.stack(chunks, ["dcn", "page"], "index", "index", "parts", segment=8)
    return stacked.select(
        "dcn", "page", "segment", F.array_join(F.col("parts").cast("array<string>"), " ").alias("parts")
    )


def batch_pad(spark, d):
    chunks = _turn_chunks(spark, d)
    vecs = embed.hashed_embedding(chunks, text.words(F.col("text_chunk")), digits=1)
    seqs = stored(sequences.stack(vecs, ["dcn", "page"], "index", "embedding"), "sequences")
    padded = sequences.pad_batches(seqs, ["dcn", "page", "segment"], "emb", dim=16, batch_size=16)
    flat = F.flatten("padded")
    return padded.select(
        "dcn", "page", "segment", "batch_id", "timesteps", "steps", F.size(flat).alias("cells"),
        F.size(F.filter(flat, lambda x: x == -99)).alias("fill_cells"),
    )


def pooled_embeddings(spark, d):
    pooled = sequences.pool(load(spark, d, "embeddings"), ["label"], "embedding")
    return pooled.select(
        "label", "vectors", F.posexplode(F.arrays_zip("mean", "max")).alias("dim", "v")
    ).select(
        "label", "vectors", "dim", F.round("v.mean", 6).alias("mean"), F.round("v.max", 6).alias("max")
    )


def pooled_pages(spark, d):
    """Pages pooled from their chunk vectors, with the first chunk's vector beside."""
    vecs = embed.hashed_embedding(
        _turn_chunks(spark, d), text.words(F.col("text_chunk")), digits=1
    )
    pooled = sequences.pool(vecs, ["dcn", "page"], "embedding", order="index")
    return pooled.select(
        "dcn", "page", F.col("vectors").alias("chunks"),
        F.round(vectors.array_total(F.col("mean")), 5).alias("mean_total"),
        F.round(vectors.array_total(F.col("max")), 5).alias("max_total"),
        F.round(vectors.array_total(F.col("first").cast("array<double>")), 5).alias("first_total"),
    )


def softmax_argmax(spark, d):
    scores = load(spark, d, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("scores")
    )
    return vectors.with_softmax(scores, "scores", "p").select(
        "vec_id", vectors.argmax(F.col("p")).alias("best"),
        F.round(F.array_max("p"), 6).alias("best_p"),
        F.round(vectors.array_total(F.col("p")), 6).alias("total_p"),
    )


QUERIES = {
    "hashed_embeddings": hashed_embeddings,
    "stack_chunks": stack_chunks,
    "stack_segments": stack_segments,
    "batch_pad": batch_pad,
    "pooled_embeddings": pooled_embeddings,
    "pooled_pages": pooled_pages,
    "softmax_argmax": softmax_argmax,
}


def embedding_sql(source: str, keys: str, tokens: str, digits: int) -> str:
    """Rows ``keys, dim, v`` for the non-zero entries."""
    return f"""(SELECT {keys}, dim, (c / sqrt(sum(c * c) OVER (PARTITION BY {keys}))::DOUBLE)::FLOAT AS v
      FROM (SELECT {keys}, ('0x' || substr(md5(tk), 1, {digits}))::INT AS dim, count(*)::DOUBLE AS c
        FROM (SELECT {keys}, unnest({tokens}) AS tk FROM {source}) GROUP BY ALL))"""


def _turn_chunks_sql() -> str:
    silver = f"(SELECT dcn, page, label, {q.clean_all('text')} AS text_processed FROM {q.TURN_PAGES})"
    return q.chunk_rows(silver, "text_processed", 40, 10, True, drop_empty=True)


def _turn_vectors_sql() -> str:
    return embedding_sql(_turn_chunks_sql(), 'dcn, page, "index"', q.tokens("text_chunk", False), 1)


SEGMENT_SQL = f'((("index" - 1) // {sequences.SEGMENT})::INT)'


def stacked_sql() -> str:
    """Chunk counts and cell totals of the stacked turn embeddings."""
    return f"""SELECT dcn, page, segment, chunks, round(coalesce(total, 0), 5) AS total
      FROM (SELECT dcn, page, {SEGMENT_SQL} AS segment, count(*)::INT AS chunks FROM {_turn_chunks_sql()} GROUP BY ALL)
      LEFT JOIN (SELECT dcn, page, {SEGMENT_SQL} AS segment, sum(v::DOUBLE) AS total FROM {_turn_vectors_sql()} GROUP BY ALL)
      USING (dcn, page, segment)"""


def oracles() -> dict[str, str]:
    silver = "(SELECT dcn, page, label, {} AS text_processed FROM {})"
    turn_chunks = _turn_chunks_sql()
    doc_chunks = q.chunk_rows(silver.format(q.clean_all("text"), q.DOC_PAGES), "text_processed", 40, 10, True, drop_empty=True)
    vecs = _turn_vectors_sql()
    sizes = f"(SELECT dcn, page, count(*)::INT AS steps FROM {turn_chunks} GROUP BY ALL)"
    pieces = f"(SELECT dcn, page, {SEGMENT_SQL} AS segment, count(*)::INT AS steps FROM {turn_chunks} GROUP BY ALL)"
    return {
        "hashed_embeddings": f"""SELECT dcn, page, dim, round(v::DOUBLE, 6) AS value FROM
          {embedding_sql(q.TURN_PAGES, 'dcn, page', q.tokens(q.clean_serving('text'), False), 2)}""",
        "stack_chunks": f"""SELECT dcn, page, label, {SEGMENT_SQL} AS segment, string_agg(text_chunk, ' | ' ORDER BY "index") AS chunks
          FROM {turn_chunks} GROUP BY ALL""",
        "stack_segments": f"""SELECT dcn, page, ((("index" - 1) // 8)::INT) AS segment,
          string_agg("index"::VARCHAR, ' ' ORDER BY "index") AS parts FROM {doc_chunks} GROUP BY ALL""",
        # Pages without tokens have all-zero vectors, which are not filling.
        "batch_pad": f"""SELECT dcn, page, segment, batch_id, timesteps, steps, (timesteps * 16)::INT AS cells,
          ((timesteps - steps) * 16)::INT AS fill_cells FROM (SELECT *, max(steps) OVER (PARTITION BY batch_id) AS timesteps
          FROM (SELECT *, (row_number() OVER (ORDER BY dcn, page, segment) - 1) // 16 AS batch_id FROM {pieces}))""",
        "pooled_embeddings": """SELECT label, count(*) AS vectors, dim, round(avg(v), 6) AS mean, round(max(v), 6) AS max
          FROM (SELECT label, unnest(range(64))::INT AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings)
          GROUP BY label, dim""",
        "pooled_pages": f"""SELECT s.dcn, s.page, s.steps::BIGINT AS chunks,
            round(coalesce(sum(total), 0) / any_value(s.steps), 5) AS mean_total,
            round(coalesce(sum(peak), 0), 5) AS max_total, round(coalesce(sum(first), 0), 5) AS first_total
          FROM {sizes} s LEFT JOIN (SELECT dcn, page, dim, sum(v::DOUBLE) AS total, max(v::DOUBLE) AS peak,
            sum(CASE WHEN "index" = 1 THEN v::DOUBLE END) AS first FROM {vecs} GROUP BY ALL) USING (dcn, page)
          GROUP BY s.dcn, s.page, s.steps""",
        "softmax_argmax": """SELECT vec_id, (list_position(s, list_max(s)) - 1)::INT AS best,
            round(list_max(p), 6) AS best_p, round(list_sum(p), 6) AS total_p
          FROM (SELECT vec_id, s, list_transform(e, lambda x: x / list_sum(e)) AS p
            FROM (SELECT vec_id, s, list_transform(s, lambda x: exp(x - list_max(s))) AS e
              FROM (SELECT vec_id, embedding::DOUBLE[] AS s FROM embeddings)))""",
    }
