"""Files, tables, the feature store and streams."""

import pathlib
import uuid

import pytest
from pyspark.sql import functions as F

from quireflow import contracts
from quireflow.operators import embed, prepare
from quireflow.session import fresh_dir
from quireflow.sources import csv_pages, feature_store, files, tables
from quireflow.streaming import pages as streams

TEXTS = ["plain", 'with "quotes" inside', "two\nlines", "comma, here", "  outer blanks  ", "back\\slash",
         "carriage\r\nreturn", '"', "", "é ü"]


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    before = spark.catalog.currentDatabase()
    tables.use_database(spark, name, fresh_dir(spark, "db"))
    yield name
    spark.catalog.setCurrentDatabase(before)


@pytest.mark.parametrize("header", [True, False])
def test_csv_keeps_every_character(spark, header):
    rows = [(t, "l", "d", float(i)) for i, t in enumerate(TEXTS)] + [(None, None, "d", 99.0)]
    path = fresh_dir(spark, "csv")
    csv_pages.write_pages(spark.createDataFrame(rows, contracts.PAGE), path, header=header)
    back = csv_pages.read_pages(spark, path, contracts.PAGE, header=header).orderBy("page").collect()
    # An empty text cannot be told from a missing one in CSV and reads as null.
    assert [tuple(r) for r in back] == [(t or None, *rest) for t, *rest in rows]


def test_stray_headers_and_nulls_drop_out(spark):
    df = spark.createDataFrame([("Request",), ("request",), (None,), ("x",)], "Request string")
    assert [r.Request for r in prepare.drop_stray_headers(df).collect()] == ["request", "x"]


def test_save_table_modes(spark, database):
    df = spark.range(10)
    assert tables.save_table(df, f"{database}.t").count() == 10
    with pytest.raises(Exception, match="already exists"):
        tables.save_table(df, f"{database}.t")
    assert tables.save_table(df, f"{database}.t", mode="append").count() == 20
    assert tables.row_count(spark, f"{database}.t") == 20


def test_reset_is_explicit(spark, database):
    tables.save_table(spark.range(1), f"{database}.t")
    tables.use_database(spark, database)
    assert spark.catalog.tableExists(f"{database}.t")
    tables.use_database(spark, database, reset=True)
    assert not spark.catalog.tableExists(f"{database}.t")


def features(spark, rows):
    return spark.createDataFrame(rows, "dcn string, page double, v int")


def test_upsert(spark, database):
    name = f"{database}.f"
    feature_store.create_feature_table(features(spark, [("a", 1.0, 1), ("a", 2.0, 2)]), name, ["dcn", "page"], 4)
    change = features(spark, [("a", 2.0, 20), ("b", 1.0, 30)])
    want = {("a", 1.0, 1), ("a", 2.0, 20), ("b", 1.0, 30)}
    for _ in range(2):  # merging the same rows again changes nothing
        assert {tuple(r) for r in feature_store.merge_features(change, name).collect()} == want
    assert feature_store.overwrite_features(change, name).count() == 2
    assert feature_store.merge_features(change.limit(0), name).count() == 2  # nothing to write, no version
    assert feature_store.versions(spark, name) == [1, 2, 3, 4]
    assert feature_store.read_version(spark, name, 1).count() == 2
    assert {tuple(r) for r in feature_store.read_version(spark, name, 3).collect()} == want


def _paths(df):
    return {f.split("__files/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}


def test_merge_writes_only_the_buckets_it_touches(spark, database):
    name = f"{database}.f"
    rows = [(f"d{i}", float(i), i) for i in range(400)]
    feature_store.create_feature_table(features(spark, rows), name, ["dcn", "page"], 16)
    before = _paths(spark.table(name))
    assert len(before) == 16
    got = feature_store.merge_features(features(spark, [("d7", 7.0, -7)]), name)
    after = _paths(got)
    assert len(after) == 16 and len(after - before) == 1 and len(after & before) == 15
    assert sorted(got.collect(), key=lambda r: r.page) == [(d, p, -v if v == 7 else v) for d, p, v in rows]
    # Expiring drops the one file set that nothing names any more, and no other.
    feature_store.merge_features(features(spark, [("d7", 7.0, 7000)]), name)
    feature_store.expire_versions(spark, name, keep=2)
    assert feature_store.versions(spark, name) == [2, 3] and len(feature_store._file_sets(spark, name)) == 17
    assert feature_store.read_version(spark, name, 2).where("v < 0").count() == 1
    feature_store.expire_versions(spark, name, keep=1)
    assert len(feature_store._file_sets(spark, name)) == 16 and spark.table(name).where("v = 7000").count() == 1


@pytest.mark.parametrize("rows", [[("a", 1.0, 1), ("a", 1.0, 2)], [(None, 1.0, 1)]])
def test_key_violations_leave_the_table_alone(spark, database, rows):
    name = f"{database}.f"
    feature_store.create_feature_table(features(spark, [("z", 1.0, 1)]), name, ["dcn", "page"], 4)
    with pytest.raises(feature_store.KeyViolation):
        feature_store.merge_features(features(spark, rows), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("z", 1.0, 1)]
    # and the next merge works
    assert feature_store.merge_features(features(spark, [("y", 1.0, 1)]), name).count() == 2
    with pytest.raises(feature_store.KeyViolation):
        feature_store.create_feature_table(features(spark, rows), f"{database}.g", ["dcn", "page"], 4)
    assert not spark.catalog.tableExists(f"{database}.g__files")


def test_a_killed_merge_leaves_the_old_version(spark, database, monkeypatch):
    """Killed while rows are written, and after that but before the manifest is there."""
    name = f"{database}.f"
    feature_store.create_feature_table(features(spark, [("a", 1.0, 1), ("b", 1.0, 2)]), name, ["dcn", "page"], 4)
    old = [("a", 1.0, 1), ("b", 1.0, 2)]
    fails = F.udf(lambda v: 1 // 0, "int")
    with pytest.raises(Exception, match="ZeroDivision|division"):
        feature_store.merge_features(features(spark, [("a", 1.0, 5)]).withColumn("v", fails("v")), name)
    with monkeypatch.context() as m, pytest.raises(InterruptedError):
        m.setattr(feature_store.files, "publish", lambda *a: (_ for _ in ()).throw(InterruptedError()))
        feature_store.merge_features(features(spark, [("a", 1.0, 5)]), name)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == old
    assert sorted(tuple(r) for r in feature_store.read_version(spark, name).collect()) == old
    leftover = len(feature_store._file_sets(spark, name))
    got = feature_store.merge_features(features(spark, [("a", 1.0, 6)]), name)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1.0, 6), ("b", 1.0, 2)]
    feature_store.expire_versions(spark, name, keep=1)
    assert leftover == 3 and len(feature_store._file_sets(spark, name)) == 2


def test_the_slower_of_two_merges_starts_again(spark, database, monkeypatch):
    """Another writer publishes while a merge is at work: neither update is lost."""
    name = f"{database}.f"
    feature_store.create_feature_table(features(spark, [("a", 1.0, 1)]), name, ["dcn", "page"], 1)
    write, raced = feature_store._write, []

    def slow(*args):
        done = write(*args)
        if not raced:
            raced.append(True)
            feature_store.merge_features(features(spark, [("b", 1.0, 2)]), name)
        return done

    monkeypatch.setattr(feature_store, "_write", slow)
    got = feature_store.merge_features(features(spark, [("c", 1.0, 3)]), name)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1.0, 1), ("b", 1.0, 2), ("c", 1.0, 3)]
    assert feature_store.versions(spark, name) == [1, 2, 3]


def test_merge_moves_only_the_updates(spark, database):
    keys, name = ["dcn", "page"], f"{database}.f"
    feature_store.create_feature_table(features(spark, [("a", 1.0, 1)]), name, keys, 4)
    existing = spark.table(f"{name}__files").where(feature_store.version(spark, name).where()).drop("feature_state")
    updates = feature_store.with_key(features(spark, [("a", 1.0, 2)]), keys, 4).repartition(4, "_key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feature_store.merge(existing, updates)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan[plan.index("== Physical"):]
    # Two exchanges, both of the updates: once as join side (keys only), once as new rows.
    assert physical.count("Exchange") == physical.count("REPARTITION_BY_NUM") == 2


def test_a_repeated_append_changes_nothing(spark, database, monkeypatch):
    name, path = f"{database}.p", fresh_dir(spark, "p")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "pred_label string, version int")
    for version, count in ((1, 2), (1, 2), (2, 4), (1, 4)):
        assert tables.append_predictions(rows, name, path, "nightly", version).count() == count
    assert tables.append_predictions(rows, name, path, "other", 1).count() == 6
    fails = F.udf(lambda v: 1 // 0, "int")
    with pytest.raises(Exception, match="ZeroDivision|division"):  # killed while rows are written
        tables.append_predictions(rows.withColumn("version", fails("version")), name, path, "nightly", 3)
    with monkeypatch.context() as m, pytest.raises(InterruptedError):  # and just before they are published
        m.setattr(tables.files, "move", lambda *a: (_ for _ in ()).throw(InterruptedError()))
        tables.append_predictions(rows, name, path, "nightly", 3)
    assert spark.table(name).count() == spark.read.parquet(path).count() == 6
    assert tables.append_predictions(rows, name, path, "nightly", 3).count() == 8
    assert tables.append_predictions(rows, name, path).count() == 10  # no version: an append of its own
    assert tables.append_predictions(rows, name, path).count() == 12
    assert tables.replace_external(spark, f"{database}.q", path).count() == 12
    with pytest.raises(ValueError):
        tables.append_predictions(rows, name, path, "a/b", 1)


def test_small_files_are_published_once(spark):
    folder = fresh_dir(spark, "files")
    assert files.names(spark, folder) == []
    assert files.publish(spark, f"{folder}/a", "first é") and not files.publish(spark, f"{folder}/a", "second")
    assert files.names(spark, folder) == ["a"] and files.read(spark, f"{folder}/a") == "first é"
    with pytest.raises(Exception, match="FileNotFound|does not exist"):
        files.move(spark, f"{folder}/none", f"{folder}/b")
    files.remove(spark, f"{folder}/a")
    assert not files.exists(spark, f"{folder}/a")


def test_stream_reads_one_file_at_a_time(spark):
    source, sink, marks = (fresh_dir(spark, n) for n in ("s", "o", "m"))
    rows = [(t, "l", str(i), "k") for i, t in enumerate(TEXTS) if t]
    df = spark.createDataFrame(rows, contracts.STREAMED_PAGE).repartition(3)
    csv_pages.write_pages(df, source)
    stream = streams.read_csv_stream(spark, f"{source}/*.csv", contracts.STREAMED_PAGE, files_per_trigger=1)
    query = streams.append_stream(stream, sink, marks)
    streams.run_to_end(query, 120)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert {tuple(r) for r in spark.read.parquet(sink).collect()} == set(rows)
    # Started again on the same checkpoint, nothing is read twice.
    streams.run_to_end(streams.append_stream(stream, sink, marks), 120)
    assert spark.read.parquet(sink).count() == len(rows)
    assert streams.stop_all(spark) == 0


def test_bronze_stream_dedups_across_batches(spark):
    source, bronze, marks = (fresh_dir(spark, n) for n in ("s", "b", "m"))
    for i, rows in enumerate([
        [("t", "a", "d", 1.0), ("t", "a", "d", 2.0), ("u", None, "d", 3.0)],
        [("t", "a", "d", 4.0), ("u", None, "d", 5.0), ("t", "b", "d", 6.0), (None, "a", "d", 7.0)],
    ]):
        spark.createDataFrame(rows, contracts.PAGE).coalesce(1).write.mode("append").parquet(source)
        pages = spark.readStream.schema(contracts.PAGE).parquet(source)
        streams.run_to_end(streams.bronze_stream(pages, bronze, marks), 120)
        rows = spark.read.parquet(bronze).select("text", "label").collect()
        assert sorted(rows, key=str) == sorted([("t", "a"), ("u", None), ("t", "b")][:2 + i], key=str)


def test_bronze_loses_and_repeats_nothing(spark):
    """A new checkpoint over an existing Bronze, as after a lost one, and a second source."""
    source, other, bronze, marks = (fresh_dir(spark, n) for n in ("s", "s2", "b", "m"))
    spark.createDataFrame([("t", "a", "d", 1.0)], contracts.PAGE).write.parquet(source)
    spark.createDataFrame([("t", "a", "e", 1.0), ("new", "a", "e", 2.0)], contracts.PAGE).write.parquet(other)
    for where, checkpoint in ((source, marks), (source, marks + "-lost"), (other, marks + "-other"), (other, marks + "-other")):
        stream = spark.readStream.schema(contracts.PAGE).parquet(where)
        streams.run_to_end(streams.bronze_stream(stream, bronze, checkpoint), 120)
    assert sorted(r.text for r in spark.read.parquet(bronze).select("text").collect()) == ["new", "t"]


def test_a_batch_that_runs_again_appends_nothing(spark, tmp_path):
    """The write of a batch survived, its commit did not: the stream runs it again."""
    source, bronze, marks = (fresh_dir(spark, n) for n in ("s", "b", "m"))
    spark.createDataFrame([("t", "a", "d", 1.0)], contracts.PAGE).write.parquet(source)
    stream = spark.readStream.schema(contracts.PAGE).parquet(source)
    streams.run_to_end(streams.bronze_stream(stream, bronze, marks), 120)
    commit = pathlib.Path(marks, "commits", "0")
    commit.rename(tmp_path / "commit")
    pathlib.Path(marks, "commits", ".0.crc").rename(tmp_path / "crc")
    streams.run_to_end(streams.bronze_stream(stream, bronze, marks), 120)
    assert commit.exists() and spark.read.parquet(bronze).count() == 1


def _fresh(spark, texts):
    rows = spark.createDataFrame([(t, "a", "d", 1.0) for t in texts], contracts.PAGE)
    return rows.withColumn("digest", F.sha2("text", 256))


def _landed(spark, path):
    return sorted(r.text for r in spark.read.parquet(path).select("text").collect())


def test_two_writers_never_land_one_page_twice(spark, monkeypatch):
    """Another writer lands the same pages after a batch was compared with Bronze."""
    path, schema = fresh_dir(spark, "b"), streams.bronze_schema(contracts.PAGE)
    draft, raced = streams._draft, []

    def slow(rows, where):
        draft(rows, where)
        if not raced:
            raced.append(True)
            streams.land(_fresh(spark, ["x", "y"]), 0, "other", path, schema)

    monkeypatch.setattr(streams, "_draft", slow)
    streams.land(_fresh(spark, ["y", "z"]), 0, "mine", path, schema)
    assert raced and _landed(spark, path) == ["x", "y", "z"]
    streams.land(_fresh(spark, ["y", "z"]), 0, "mine", path, schema)  # the same batch again
    assert _landed(spark, path) == ["x", "y", "z"]
    assert not [n for n in files.names(spark, f"{path}/_drafts")]


def test_two_queries_started_together(spark):
    sources, bronze = [fresh_dir(spark, n) for n in ("s1", "s2")], fresh_dir(spark, "b")
    for k, source in enumerate(sources):
        for part in range(3):
            rows = [(f"t{(i * 7 + k) % 40}", "a", "d", float(i)) for i in range(part * 20, part * 20 + 20)]
            spark.createDataFrame(rows, contracts.PAGE).coalesce(1).write.mode("append").parquet(source)
    started = [streams.bronze_stream(
        spark.readStream.schema(contracts.PAGE).option("maxFilesPerTrigger", 1).parquet(s), bronze, fresh_dir(spark, "m"))
        for s in sources]
    for query in started:
        streams.run_to_end(query, 300)
    assert _landed(spark, bronze) == sorted({f"t{(i * 7 + k) % 40}" for k in range(2) for i in range(60)})


def test_a_batch_published_but_not_finished(spark, monkeypatch):
    path, schema = fresh_dir(spark, "b"), streams.bronze_schema(contracts.PAGE)
    with monkeypatch.context() as m, pytest.raises(InterruptedError):  # killed right after publishing
        m.setattr(streams, "_finish", lambda *a: (_ for _ in ()).throw(InterruptedError()))
        streams.land(_fresh(spark, ["x"]), 0, "mine", path, schema)
    assert files.names(spark, path) == ["_drafts", "_log"]
    streams.land(_fresh(spark, ["x", "y"]), 0, "other", path, schema)  # the next writer finishes it
    assert _landed(spark, path) == ["x", "y"]
    streams.land(_fresh(spark, ["x"]), 0, "mine", path, schema)
    assert _landed(spark, path) == ["x", "y"]


def test_state_that_forgets(spark):
    source, bronze, marks = (fresh_dir(spark, n) for n in ("s", "b", "m"))
    for texts in (["t", "u"], ["t", "v", "v"]):
        spark.createDataFrame([(t, "a", "d", 1.0) for t in texts], contracts.PAGE).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(contracts.PAGE).parquet(source)
        streams.run_to_end(streams.bronze_stream(stream, bronze, marks, forget_after="1 seconds"), 200)
    assert _landed(spark, bronze) == ["t", "u", "v"]


def test_known_texts_reach_no_model(spark, database):
    """Calls are counted by an accumulator in the model."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def model(text):
        calls.add(1)
        return [float(len(text))]

    def run(texts, name="m"):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        before = calls.value
        made = embed.cached_embedding(df, "text", model("text"), f"{database}.known", name, buckets=4)
        got = {r.i: r.embedding for r in made.collect()}
        assert made.columns == ["i", "text", "embedding"]
        assert got == {i: None if t is None else [float(len(t))] for i, t in enumerate(texts)}
        return calls.value - before

    assert run(["a", "bb", "a", None, "a"]) == 2
    assert run(["bb", "a", None]) == 0
    assert run(["bb", "ccc", "ccc", ""]) == 2
    assert run(["a", "ccc"], "another model") == 2
    assert run(["a", "bb", "ccc", ""]) == 0
    assert run([]) == 0
