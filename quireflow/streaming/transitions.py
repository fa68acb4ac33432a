"""Registry events as they arrive: routing, and the stage of every model version.

``stage_moves`` keeps, per model, each version's last move and the last move into each active
stage that archives what stood there. Events count by their time and id, not by the order in
which they arrive, so late ones change what they would have changed. A batch puts out one row
for each version whose stage is another than before it.

A model's versions are spread over ``PARTS`` slots, and only moves that archive go to all of
them, so a model with most of the events is the work of several tasks. ``SLOTS`` slots, each for
parts of many models, lie in ``GROUPS`` keys: every key costs an Arrow batch of its own, every
read or write of the state a message to Spark, and every column of a row a call. So a move
goes as one JSON text, and a slot's versions stand in pages of ``PAGE``; a batch reads each slot it has
moves for once and writes the pages that change. A task holds one slot at a time and, of what a
batch tells one key, the last moves. ``PARTS``, ``SLOTS``, ``GROUPS`` and ``PAGE`` belong to a
checkpoint and must not change under it.

An event whose text does not parse, or which names no model, version or stage, is routed with
its reason and moves nothing. An event that arrives twice changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quireflow.functions import events as event_functions
from quireflow.operators.registry import ACTIVE_STAGES
from quireflow.streaming.pages import append_stream

PARTS = 4
SLOTS = 1 << 16
GROUPS = 1 << 12
PAGE = 1024
CHANGE = "model_name string, version string, from_stage string, to_stage string, at_micros long, event_id long, change int"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def routed(events: DataFrame) -> DataFrame:
    """``event_id, model_name, version, to_stage, target, reason`` of every event; ``events``
    has ``event_id``, ``ts``, ``message`` and ``archive_existing``."""
    parsed = events.withColumn("_p", event_functions.parse_message(F.col("message")))
    return parsed.withColumn("_r", event_functions.route(F.col("_p"))).select(
        "event_id", "_p.model_name", "_p.version", "_p.to_stage", "_r.target", "_r.reason")


class StageKeeper(StatefulProcessor):
    """Stages of the versions in some slots.

    Under ``(slot, page)`` stands JSON text: the page's versions in the order in which they came,
    and on page 0 also the number of pages and the last sweeps by model and stage."""

    def __init__(self, page_size: int = PAGE) -> None:
        self.page_size = page_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("pages", "slot int, page int", "content string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        slots = {}
        for row in rows:
            said = json.loads(row.said)
            model, stage, at = said["model_name"], said["to_stage"], (said["at_micros"], said["event_id"])
            moves, sweeps = slots.setdefault(said["slot"], ({}, {}))
            if said["mine"]:
                had = moves.get((model, said["version"]))
                if had is None or at > had[1:]:
                    moves[model, said["version"]] = (stage, *at)
            if said["sweeps"]:
                had = sweeps.get((model, stage))
                if had is None or at > had:
                    sweeps[model, stage] = at
        for slot, (moves, sweeps) in slots.items():
            yield from self._apply(slot, moves, sweeps)

    def _read(self, slot: int, page: int) -> tuple[list, int, list]:
        found = self.pages.getValue((slot, page))
        return json.loads(found[0]) if found else ([], 0, [])

    def _apply(self, slot: int, moves: dict, newer: dict) -> Iterator[Row]:
        entries, pages, head = self._read(slot, 0)
        for page in range(1, pages):
            entries += self._read(slot, page)[0]
        sweeps = {(model, stage): tuple(at) for model, stage, *at in head}
        swept = {by for by, at in newer.items() if by not in sweeps or at > sweeps[by]}
        sweeps |= {by: newer[by] for by in swept}
        place = {(entry[0], entry[1]): i for i, entry in enumerate(entries)}
        changed = set()
        for (model, version), move in moves.items():
            i = place.get((model, version))
            if i is None:
                changed.add(len(entries))
                entries.append([model, version, *move, None, 0])
            elif move[1:] > (entries[i][3], entries[i][4]):
                changed.add(i)
                entries[i][2:5] = move
        for i, entry in enumerate(entries):
            model, version, stage, *at, shown, change = entry
            if i not in changed and (model, stage) not in swept:
                continue
            now, cause = stage, tuple(at)
            if (model, stage) in sweeps and sweeps[model, stage] > cause:
                now, cause = "Archived", sweeps[model, stage]
            if now != shown:
                changed.add(i)
                entry[5:] = now, change + 1
                yield Row(model_name=model, version=version, from_stage=shown, to_stage=now,
                          at_micros=cause[0], event_id=cause[1], change=change + 1)
        count = -(-len(entries) // self.page_size)
        dirty = {i // self.page_size for i in changed} | ({0} if swept or count > pages else set())
        for page in dirty:
            told = [count, [[*by, *at] for by, at in sweeps.items()]] if page == 0 else [0, []]
            part = entries[page * self.page_size:(page + 1) * self.page_size]
            self.pages.updateValue((slot, page), (json.dumps([part, *told]),))


def stage_moves(events: DataFrame, parts: int = PARTS, slots: int = SLOTS,
                groups: int = GROUPS, page_size: int = PAGE) -> DataFrame:
    """Changes of stage, ``CHANGE``; ``change`` counts those of a version from 1."""
    parsed = events.withColumn("_p", event_functions.parse_message(F.col("message"))).where(
        F.col("_p.event") == event_functions.TRANSITION_EVENT)
    moves = parsed.select(
        "_p.model_name", "_p.version", "_p.to_stage", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_micros"),
        F.col("event_id").cast("long").alias("event_id"),
        (F.coalesce("archive_existing", F.lit(False)) & F.col("_p.to_stage").isin(ACTIVE_STAGES)).alias("sweeps"),
    ).dropna()
    own = F.pmod(F.xxhash64("version"), F.lit(parts)).cast("int")
    everywhere = F.sequence(F.lit(0), F.lit(parts - 1))
    sent = moves.withColumn("part", F.explode(F.when(F.col("sweeps"), everywhere).otherwise(F.array(own)))).withColumn(
        "mine", F.col("part") == own)
    # Parts of a model that follow each other lie in different groups.
    slot = F.pmod(F.pmod(F.xxhash64("model_name"), F.lit(slots)) + F.col("part"), F.lit(slots)).cast("int")
    said = F.to_json(F.struct("slot", "model_name", "version", "to_stage", "at_micros", "event_id", "sweeps", "mine"))
    placed = sent.withColumn("slot", slot).select(F.pmod("slot", F.lit(groups)).alias("group"), said.alias("said"))
    return placed.groupBy("group").transformWithState(StageKeeper(page_size), CHANGE, "Append", "None")


def transitions_stream(events: DataFrame, path: str, checkpoint: str, parts: int = PARTS) -> StreamingQuery:
    """Append changes of stage to ``path``. This kind of state needs the RocksDB store, whatever
    store the session uses for its other streams."""
    conf = events.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, _ROCKS)
    try:
        return append_stream(stage_moves(events, parts), path, checkpoint)
    finally:
        conf.set(_PROVIDER, before)


def current_stages(changes: DataFrame) -> DataFrame:
    """``model_name, version, stage`` from all changes so far."""
    return changes.groupBy("model_name", "version").agg(F.max_by("to_stage", "change").alias("stage"))
