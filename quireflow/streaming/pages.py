"""Pages as streams: scoring and the Bronze, Silver, Gold tables step by step.

The transforms are the batch ones. Silver, Gold and scoring are stateless and use the
exactly-once file sink; Bronze keeps its keys in the stream's state.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quireflow.functions import hashing
from quireflow.operators import prepare
from quireflow.session import stored
from quireflow.sources import files
from quireflow.sources.csv_pages import read_options


def read_csv_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """File source for multi-line CSV with header. ``partitions`` spreads each batch when
    the work per row outweighs the exchange; a multi-line file is one task otherwise."""
    limit = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    pages = spark.readStream.schema(schema).options(**read_options(header=True), **limit).csv(path)
    return pages.repartition(partitions) if partitions else pages


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start the append sink over everything that is there now."""
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def run_to_end(query: StreamingQuery, timeout: int = 3600) -> None:
    """Wait for a bounded stream; stop it and fail if it takes longer."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.id} still ran after {timeout} s")


def stop_all(spark: SparkSession, queries: Iterable[StreamingQuery] | None = None) -> int:
    """Stop the streams given, or every active stream of the session; how many were active."""
    chosen = None if queries is None else {q.id for q in queries}
    active = [q for q in spark.streams.active if chosen is None or q.id in chosen]
    for query in active:
        query.stop()
    return len(active)


def score_stream(
    pages: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Score a stream with the batch scoring function and append the result."""
    return append_stream(score(pages), path, checkpoint)


# ---- incremental Bronze, Silver, Gold -------------------------------------------------

def _without_known(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """``fresh`` pages whose ``(digest, label)`` is not among the ``known`` ones. No hint: the
    measured sizes decide how they are joined."""
    same = (F.col("digest") == F.col("_d")) & F.col("label").eqNullSafe(F.col("_l"))
    keys = known.select(F.col("digest").alias("_d"), F.col("label").alias("_l"))
    return fresh.join(keys, same, "left_anti")


def bronze_stream(pages: DataFrame, path: str, checkpoint: str, forget_after: str | None = None) -> StreamingQuery:
    """Append only pages whose ``(text, label)`` Bronze does not hold yet.

    The stream's keyed state drops what this query has seen, so a batch costs what it holds
    and never scans the query's own output. What remains is compared with the pages of other
    queries (an earlier checkpoint, a second source); only their digests are read. Each batch
    is appended to a folder ``query=…/batch=…`` of its own, so stages behind see a page once.

    Any number of queries may write one Bronze table at the same time, see ``land``.

    The state has an entry for every page seen. With ``forget_after`` ("7 days") entries older
    than that go, and batches are compared with the query's own pages, too.
    """
    digests = pages.where(F.col("text").isNotNull()).withColumn("digest", hashing.text_key(F.col("text")))
    key = ["digest", "label"]
    if forget_after is None:
        unseen = digests.dropDuplicates(key)
    else:
        unseen = digests.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", forget_after)
        unseen = unseen.dropDuplicatesWithinWatermark(key).drop("_seen")
    # A checkpoint is what makes two runs the same query.
    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    schema = bronze_schema(pages.schema)

    def run(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id, query, path, schema, own=forget_after is not None)

    return (
        unseen.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def land(batch: DataFrame, batch_id: int, query: str, path: str, schema: T.StructType, own: bool = False) -> None:
    """Bring the new pages of a batch into Bronze, exactly once.

    The folder ``_log`` has a file for each batch landed, numbered without gaps. A batch is
    compared with what the log holds, written to a draft that readers skip, and landed by
    publishing the next number. If another writer has taken that number, its pages may be the
    same ones, and the batch is compared again; so two writers never both land a page.

    A writer that dies after publishing leaves its draft to be moved by the next one, before
    that one publishes: only the newest entry can be unfinished. A batch that has landed, in a
    try that died later, is left alone.
    """
    spark = batch.sparkSession
    fresh = None
    while True:
        numbers, newest = _log(spark, path)
        if newest:
            _finish(spark, path, newest)
        if files.exists(spark, f"{path}/query={query}/batch={batch_id}"):
            if fresh is None:  # the stream's state wants every batch computed, also this one
                batch.write.format("noop").mode("overwrite").save()
            files.remove(spark, f"{path}/_drafts/{query}-{batch_id}")
            return
        if fresh is None:
            fresh = stored(batch, "batch")
        known = spark.read.schema(schema).option("basePath", path).parquet(path) if newest else None
        if known is not None and not own:
            known = known.where(F.col("query") != query)
        rows = fresh if known is None else _without_known(fresh, known.select("digest", "label"))
        entry = {"query": query, "batch": batch_id, "draft": uuid.uuid4().hex[:12]}
        _draft(rows, f"{path}/_drafts/{query}-{batch_id}/{entry['draft']}")
        if files.publish(spark, f"{path}/_log/{numbers + 1:08d}.json", json.dumps(entry)):
            _finish(spark, path, entry)
            files.remove(spark, f"{path}/_drafts/{query}-{batch_id}")
            return


def _draft(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def _log(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number of the last batch landed, and its entry."""
    found = [f for f in files.names(spark, f"{path}/_log") if not f.startswith(".")]
    return len(found), json.loads(files.read(spark, f"{path}/_log/{found[-1]}")) if found else None


def _finish(spark: SparkSession, path: str, entry: dict) -> None:
    """Let readers see a batch whose landing is published; any writer may do it."""
    target = f"{path}/query={entry['query']}/batch={entry['batch']}"
    draft = f"{path}/_drafts/{entry['query']}-{entry['batch']}/{entry['draft']}"
    if not files.exists(spark, target):
        try:
            files.move(spark, draft, target)
        except Py4JJavaError:
            if not files.exists(spark, target):  # another writer may have finished it meanwhile
                raise


def bronze_schema(pages: T.StructType) -> T.StructType:
    return T.StructType(
        [f for f in pages.fields]
        + [T.StructField("digest", T.StringType()), T.StructField("query", T.StringType()),
           T.StructField("batch", T.LongType())]
    )


def silver_stream(spark: SparkSession, bronze_path: str, schema: T.StructType, path: str,
                  checkpoint: str, **cleaning) -> StreamingQuery:
    pages = spark.readStream.schema(bronze_schema(schema)).parquet(bronze_path)
    return append_stream(prepare.silver(pages, **cleaning), path, checkpoint)


def gold_stream(spark: SparkSession, silver_path: str, schema: T.StructType, path: str,
                checkpoint: str, **chunking) -> StreamingQuery:
    """Chunk positions come from the array, as windows are not available on streams."""
    pages = spark.readStream.schema(schema).parquet(silver_path)
    return append_stream(prepare.gold(pages, **chunking), path, checkpoint)
