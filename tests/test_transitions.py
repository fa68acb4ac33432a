"""Registry events as a stream, against the batch replay of the same moves."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quireflow.operators import registry
from quireflow.session import fresh_dir
from quireflow.streaming import pages as streams
from quireflow.streaming import transitions

SCHEMA = "event_id long, ts timestamp_ntz, message string, archive_existing boolean"


def _events(seed, n):
    """Most events are about one model; some are broken, incomplete or sent twice."""
    rnd, rows = random.Random(seed), []
    from datetime import datetime, timedelta
    for i in range(n):
        body = {"event": "MODEL_VERSION_TRANSITIONED_STAGE", "model_name": "hot" if i % 3 else f"m{i % 5}",
                "version": str(rnd.randint(1, 9)), "to_stage": rnd.choice(["Staging", "Production", "Archived", "None"])}
        kind = rnd.random()
        if kind < 0.1:
            body["event"] = "COMMENT_CREATED"
        elif kind < 0.2:
            body[rnd.choice(["model_name", "version", "to_stage"])] = None
        text = json.dumps(body) if rnd.random() > 0.05 else "{broken"
        ts = datetime(2024, 1, 1) + timedelta(seconds=rnd.randint(0, n // 3))  # several events share a second
        rows.append((i, ts, text, rnd.choice([True, False, None])))
    rows += rnd.sample(rows, n // 10)
    rnd.shuffle(rows)  # late ones everywhere
    return rows


@pytest.mark.parametrize("parts", [1, 3])
def test_stages_over_restarts(spark, parts):
    rows = _events(parts, 240)
    source, moves, marks = (fresh_dir(spark, n) for n in ("e", "m", "c"))
    for third in range(3):  # each run ends; the next one starts from the checkpoint
        spark.createDataFrame(rows[third::3], SCHEMA).coalesce(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        streams.run_to_end(transitions.transitions_stream(stream, moves, marks, parts), 300)
    changes = spark.read.parquet(moves)
    got = {(r.model_name, r.version): r.stage for r in transitions.current_stages(changes).collect()}

    told = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["event_id"]).withColumn(
        "m", F.from_json("message", "event string, model_name string, version string, to_stage string")
    ).where("m.event = 'MODEL_VERSION_TRANSITIONED_STAGE'")
    batch = told.select(
        F.col("m.model_name").alias("name"), "m.version", "m.to_stage", "ts", F.col("event_id").alias("move_id"),
        F.coalesce("archive_existing", F.lit(False)).alias("archive_existing")).dropna()
    known = batch.select("name", "version").distinct().withColumn("stage", F.lit("None"))
    want = {(r["name"], r.version): r.stage for r in registry.apply_transitions(known, batch).collect()}
    assert got == want and len(want) > 20 and "Archived" in want.values()
    # Changes of a version follow each other: every one starts where the one before ended.
    by_version = {}
    for r in sorted(changes.collect(), key=lambda r: r.change):
        assert by_version.get((r.model_name, r.version), (None, 0)) == (r.from_stage, r.change - 1)
        by_version[r.model_name, r.version] = (r.to_stage, r.change)


def test_state_rows_do_not_grow_with_models(spark):
    """Versions of many models share the rows of the state: few reads and writes for a batch."""
    rows, slots, page = [], 8, 16
    for i, ts, text, archives in _events(5, 400):
        spread = text.replace('"hot"', f'"h{i % 61}"') if text.startswith('{"event"') else text
        rows.append((i, ts, spread, archives))
    source, moves, marks = (fresh_dir(spark, n) for n in ("e", "m", "c"))
    for half in range(2):
        spark.createDataFrame(rows[half::2], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        changes = transitions.stage_moves(stream, 2, slots, 4, page)
        query = streams.append_stream(changes, moves, marks)
        streams.run_to_end(query, 300)
    state = query.lastProgress["stateOperators"][0]
    got = {(r.model_name, r.version): r.stage for r in transitions.current_stages(spark.read.parquet(moves)).collect()}
    assert len(got) > 150 and slots < state["numRowsTotal"] < len(got) // 4

    last, swept = {}, {}
    for i, ts, text, archives in rows:
        body = json.loads(text) if text.startswith('{"event"') else {}
        model, version, stage = (body.get(k) for k in ("model_name", "version", "to_stage"))
        if body.get("event") != "MODEL_VERSION_TRANSITIONED_STAGE" or None in (model, version, stage):
            continue
        last[model, version] = max(last.get((model, version), ((ts, -1), "")), ((ts, i), stage))
        if archives and stage in registry.ACTIVE_STAGES:
            swept[model, stage] = max(swept.get((model, stage), (ts, -1)), (ts, i))
    want = {by: "Archived" if swept.get((by[0], stage), at) > at else stage for by, (at, stage) in last.items()}
    assert got == want and "Archived" in want.values()


def test_routing_keeps_every_event(spark):
    rows = _events(9, 60)
    got = transitions.routed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.event_id for r in got) == sorted(r[0] for r in rows)
    assert all((r.target is not None) == (r.reason == "accepted") for r in got)


def test_stop_only_the_streams_given(spark):
    source = fresh_dir(spark, "e")
    spark.createDataFrame(_events(2, 10), SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    mine, other = (stream.writeStream.format("noop").option("checkpointLocation", fresh_dir(spark, "c")).start() for _ in range(2))
    try:
        assert streams.stop_all(spark, [mine]) == 1 and other.isActive and not mine.isActive
        assert streams.stop_all(spark, [mine]) == 0
    finally:
        assert streams.stop_all(spark) == 1
