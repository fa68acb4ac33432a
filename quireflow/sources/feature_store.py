"""Feature tables with a primary key and merge writes, on plain Parquet tables.

The rows of a feature table lie in ``<name>__files``, a table partitioned by the write that made
them (``feature_state``) and by the bucket of their key, and bucketed by the key. A version of
the table is a manifest: a small file that names, for every bucket, the write that holds its
rows. A merge writes new file sets for the buckets its updates fall into, and a manifest that
takes all others over from the version before.

Publishing a version is one rename of its manifest, which fails if there is a version of that
number: a reader sees the old version or the new one, a killed merge leaves the old one as it
was, and of two merges that started from one version the later starts again from the new one.
The view under the public name follows the newest manifest.

As all file sets share the bucketing, a merge moves only the update rows across the network.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.session import stored
from quireflow.sources import files

KEY, STATE, BUCKET = "_key", "feature_state", "feature_bucket"
ATTEMPTS = 5


class KeyViolation(ValueError):
    """A primary key is null or occurs twice."""


class VersionConflict(RuntimeError):
    """Other writers kept publishing versions first."""


@dataclass(frozen=True)
class Version:
    """One version of a feature table."""

    number: int
    keys: list[str]
    buckets: int
    holders: dict[int, str] = field(default_factory=dict)  # which write holds a bucket's rows

    def where(self, buckets: Iterable[int] | None = None) -> str:
        """Condition on ``<name>__files`` for this version's rows, optionally of some buckets."""
        chosen = set(self.holders if buckets is None else buckets)
        by_state: dict[str, list[int]] = {}
        for bucket, state in sorted(self.holders.items()):
            if bucket in chosen:
                by_state.setdefault(state, []).append(bucket)
        return " OR ".join(f"({STATE} = '{s}' AND {BUCKET} IN ({', '.join(map(str, b))}))"
                           for s, b in by_state.items()) or "false"


# Versions

def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}__files").where("col_name = 'Location'").first()["data_type"]


def versions(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the versions that can be read, the oldest first."""
    found = files.names(spark, f"{_location(spark, name)}/_manifests")
    return [int(f.removesuffix(".json")) for f in found if f.endswith(".json") and not f.startswith(".")]


def version(spark: SparkSession, name: str, number: int | None = None) -> Version:
    """A version by number, or the newest."""
    at = f"{_location(spark, name)}/_manifests"
    number = versions(spark, name)[-1] if number is None else number
    told = json.loads(files.read(spark, f"{at}/{number:08d}.json"))
    return Version(number, told["keys"], told["buckets"], {b: s for s, bs in told["states"].items() for b in bs})


def _publish(spark: SparkSession, name: str, new: Version) -> bool:
    states: dict[str, list[int]] = {}
    for bucket, state in sorted(new.holders.items()):
        states.setdefault(state, []).append(bucket)
    told = json.dumps({"keys": new.keys, "buckets": new.buckets, "states": states})
    if not files.publish(spark, f"{_location(spark, name)}/_manifests/{new.number:08d}.json", told):
        return False
    show(spark, name)
    return True


def show(spark: SparkSession, name: str) -> None:
    """Let the view under the public name show the newest version. Publishing does it; a
    writer killed between the two steps leaves it to the next."""
    columns = ", ".join(f"`{c}`" for c in _public(spark.table(f"{name}__files")))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {name}__files "
              f"WHERE {version(spark, name).where()}")


def _public(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (KEY, STATE, BUCKET)]


def read_version(spark: SparkSession, name: str, number: int | None = None) -> DataFrame:
    """The rows of a version, whatever has been published since."""
    rows = spark.table(f"{name}__files")
    return rows.where(version(spark, name, number).where()).select(*_public(rows))


# Rows

def with_key(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the key as one text, and its bucket. Spark normalises floating-point join keys, which
    hides the bucketing of such a column; a text key keeps merges in place for any key type."""
    return df.withColumn(KEY, F.to_json(F.struct(*keys))).withColumn(
        BUCKET, F.pmod(F.hash(KEY), F.lit(buckets)))


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail on null or repeated keys. The driver sees one row at most."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = (
        df.groupBy(KEY).agg(F.count("*").alias("_rows"), F.bool_or(missing).alias("_missing"))
        .where("_rows > 1 OR _missing").first()
    )
    if bad is not None:
        raise KeyViolation(f"key {bad[KEY]} is null or repeated")


def _write(df: DataFrame, name: str, number: int, buckets: int, mode: str) -> tuple[str, list[int]]:
    """Write rows as a state of their own that no version names yet: its name, its buckets."""
    spark, state = df.sparkSession, f"{number:08d}-{uuid.uuid4().hex[:8]}"
    (
        df.withColumn(STATE, F.lit(state)).write.mode(mode).format("parquet").partitionBy(STATE, BUCKET)
        .bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(f"{name}__files")
    )
    return state, [b for s, b in _file_sets(spark, name) if s == state]


def _file_sets(spark: SparkSession, name: str) -> list[tuple[str, int]]:
    """``(state, bucket)`` of all that is written, published or not."""
    listed = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {name}__files").collect()]
    return [(s.split("=")[1], int(b.split("=")[1])) for s, b in listed]


def create_feature_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int = 16) -> DataFrame:
    """First load. ``buckets`` is for good: choose it so that a bucket stays well below a
    task's memory (about 200 MB per bucket). The features are computed once; the check reads
    only the stored keys, and their bucketing spares it the exchange."""
    spark = df.sparkSession
    rows = with_key(df, keys, buckets).repartition(buckets, KEY)
    state, filled = _write(rows, name, 1, buckets, "errorifexists")
    try:
        check_keys(spark.table(f"{name}__files"), keys)
    except KeyViolation:
        spark.sql(f"DROP TABLE {name}__files")
        raise
    _publish(spark, name, Version(1, list(keys), buckets, dict.fromkeys(filled, state)))
    return spark.table(name)


def merge(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows of ``existing`` whose key is not updated, and all of ``updates``; both carry
    the text key."""
    kept = existing.join(updates.select(KEY), KEY, "left_anti")
    return kept.unionByName(updates)


def _ready(df: DataFrame, name: str, now: Version) -> DataFrame:
    """Rows to be written, computed and checked once, in the types of the table: equal keys
    of other types could read differently as text."""
    types = {f.name: f.dataType for f in df.sparkSession.table(f"{name}__files").schema.fields}
    rows = df.select([F.col(c).cast(t).alias(c) for c, t in types.items() if c not in (KEY, STATE, BUCKET)])
    rows = stored(with_key(rows, now.keys, now.buckets), "updates")
    check_keys(rows, now.keys)
    return rows


def merge_features(df: DataFrame, name: str) -> DataFrame:
    """Upsert: known keys are replaced, new ones added. Only buckets with updates are written."""
    spark = df.sparkSession
    updates = _ready(df, name, version(spark, name))
    touched = [r[0] for r in updates.select(BUCKET).distinct().collect()]  # at most the buckets
    for _ in range(ATTEMPTS if touched else 0):
        now = version(spark, name)
        existing = spark.table(f"{name}__files").where(now.where(touched)).drop(STATE)
        merged = merge(existing, updates.repartition(now.buckets, KEY))
        state, filled = _write(merged, name, now.number + 1, now.buckets, "append")
        new = replace(now, number=now.number + 1, holders=now.holders | dict.fromkeys(filled, state))
        if _publish(spark, name, new):
            break
    else:
        if touched:
            raise VersionConflict(f"{name}: another writer was first {ATTEMPTS} times")
    return spark.table(name)


def overwrite_features(df: DataFrame, name: str) -> DataFrame:
    """Replace all rows."""
    spark = df.sparkSession
    now = version(spark, name)
    rows = _ready(df, name, now).repartition(now.buckets, KEY)
    state, filled = _write(rows, name, now.number + 1, now.buckets, "append")
    if not _publish(spark, name, Version(now.number + 1, now.keys, now.buckets, dict.fromkeys(filled, state))):
        raise VersionConflict(f"{name}: version {now.number + 1} was published by another writer")
    return spark.table(name)


def expire_versions(spark: SparkSession, name: str, keep: int = 2) -> None:
    """Remove all but the newest versions, and the file sets that only they name, also those
    of writes that were never published. Keep at least one spare: running readers may still
    hold the version the view pointed at before the last merge."""
    numbers = versions(spark, name)
    kept = [version(spark, name, n) for n in numbers[-max(keep, 1):]]
    named = {(s, b) for v in kept for b, s in v.holders.items()}
    for number in numbers[: -max(keep, 1)]:
        files.remove(spark, f"{_location(spark, name)}/_manifests/{number:08d}.json")
    # A write for a number above the newest may still be under way.
    dead = [(s, b) for s, b in _file_sets(spark, name) if (s, b) not in named and int(s.split("-")[0]) <= numbers[-1]]
    for at in range(0, len(dead), 500):
        parts = ", ".join(f"PARTITION ({STATE} = '{s}', {BUCKET} = {b})" for s, b in dead[at:at + 500])
        spark.sql(f"ALTER TABLE {name}__files DROP {parts}")
