"""Provisioning, streaming runs, restarts, failures, hooks."""

import dataclasses
import datetime as dt
import pathlib
import re
import time
import zipfile

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from rillstone.context import Hooks, IngestContext, config_root, find_hooks, load_context
from rillstone.functions import names
from rillstone.functions.schemas import IncompatibleSchema
from rillstone.plans import merge, tables
from rillstone.plans.ingest import run_ingest, run_jobs, run_topics
from rillstone.sources import documents
from rillstone.sources.records import RECORD_SCHEMA
from rillstone.streaming import drain as draining
from rillstone.streaming.stages import formatted_rows, landing_rows, start_landing

START = dt.datetime(2024, 1, 1)
SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("n", T.StringType())]
)


def context(
    spark, folder, schema=SCHEMA, target=None, topic="demo.Events", registry=None, **options
):
    home = f"{folder}/conf/src/{topic}"
    has_target = target is not None
    documents.write_json(
        spark, f"{home}/config.json", {"primary_keys": "id", "has_target_schema": has_target}
    )
    documents.write_json(spark, f"{home}/schema.json", schema.jsonValue())
    if has_target:
        documents.write_json(spark, f"{home}/target_schema.json", target.jsonValue())
    job = {"env": "dev", "source": "src", "topic_name": topic, "kafka_topic_name": topic}
    job |= options.pop("job", {})
    generic = {
        "s3_config_bucket": "b",
        "s3_config_prefix": f"{folder}/conf",
        "formatted_checkpoint_prefix": f"{folder}/cp",
        "formatted_table_prefix": f"{folder}/tables",
        "formatted_table_catalog": "demo",
        "query_poll_timeout_seconds": 120,
    }
    options = {
        "register_tables": False,
        "publish_share": 0.0,
        "record_path": f"{folder}/records/{topic}",
        **options,
    }
    cluster = {"resource_name_prefix": "pre", "sasl_plain_password": "hunter2"}
    return load_context(spark, job, generic, cluster, registry, **options)


def send(ctx, *messages, at=0, offset=0):
    """One record file holding the messages."""
    rows = [
        (
            None,
            None if message is None else bytearray(message.encode()),
            "t",
            0,
            offset + n,
            START + dt.timedelta(seconds=at + n),
            0,
        )
        for n, message in enumerate(messages)
    ]
    frame = ctx.spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1)
    frame.write.mode("append").parquet(ctx.record_path)


def message(number, name="x"):
    return f'{{"id":{number},"n":"{name}"}}'


# -------------------------------------------------------------------- context


def test_names_and_places(spark, tmp_path):
    ctx = context(spark, tmp_path)
    assert ctx.resource_name == "pre_demo_events"
    assert ctx.table_name == "demo.pre_demo_events"
    assert ctx.raw_table_name == "demo.pre_demo_events_src"
    assert ctx.table_path == f"{tmp_path}/tables/pre_demo_events"
    assert ctx.raw_path == f"{tmp_path}/tables/pre_demo_events_src"
    assert ctx.checkpoint("landing") == f"{tmp_path}/cp/src/demo.Events/landing"
    assert ctx.saved_schema_path == f"{tmp_path}/cp/src/demo.Events.target_schema.json"
    assert "hunter2" not in repr(ctx)


def test_config_root():
    assert config_root({"s3_config_prefix": "/conf/", "s3_config_bucket": "b"}) == "/conf"
    assert config_root({"s3_config_prefix": "a/conf", "s3_config_bucket": "b"}) == "s3a://b/a/conf"
    assert config_root({"s3_config_prefix": "hdfs://n/conf"}) == "hdfs://n/conf"


def test_context_from_document_paths(spark, tmp_path):
    ctx = context(spark, tmp_path)
    documents.write_json(spark, f"{tmp_path}/generic.json", dict(ctx.generic))
    documents.write_json(spark, f"{tmp_path}/cluster.json", dict(ctx.cluster))
    again = load_context(
        spark, ctx.job, f"{tmp_path}/generic.json", f"{tmp_path}/cluster.json"
    )
    assert (again.table_path, again.source_schema) == (ctx.table_path, ctx.source_schema)


def test_target_schema_is_really_the_target(spark, tmp_path):
    target = T.StructType([SCHEMA["id"]])
    ctx = context(spark, tmp_path, target=target)
    assert (ctx.source_schema, ctx.target_schema) == (SCHEMA, target)


def test_hook_registry():
    hooks = Hooks(write=lambda ctx, batch, batch_id: None)
    registry = {("src", "demo_events"): hooks}
    assert find_hooks(registry, {"source": "src", "topic_name": "Demo.Events"}) is hooks
    assert find_hooks(registry, {"source": "other", "topic_name": "Demo.Events"}) == Hooks()


# --------------------------------------------------------------- provisioning


def with_schema(spark, folder, *fields):
    return context(spark, folder, schema=T.StructType([*SCHEMA.fields, *fields]))


EXTRA = T.StructField("z", T.DateType())


def test_provision_creates_then_leaves_alone(spark, tmp_path):
    ctx = context(spark, tmp_path)
    assert not tables.table_exists(ctx)
    assert tables.provision(ctx).action == "created"
    assert tables.table_exists(ctx)
    assert tables.provision(ctx) == ("unchanged", [])
    assert tables.read_formatted(ctx).count() == 0
    assert tables.read_formatted(ctx).columns == [
        "id", "n", "timestamp", "current", "record_partition", "record_offset",
    ]
    assert tables.read_latest(ctx).count() == 0


def test_provision_evolves(spark, tmp_path):
    tables.provision(context(spark, tmp_path))
    ctx = with_schema(spark, tmp_path, EXTRA)
    action, changes = tables.provision(ctx)
    assert (action, [(c.path, c.kind) for c in changes]) == ("evolved", [("z", "added")])
    assert tables.provision(ctx).action == "unchanged"


def test_provision_without_saved_schema_counts_as_changed(spark, tmp_path):
    ctx = context(spark, tmp_path)
    documents.make_directory(spark, ctx.table_path)
    assert tables.provision(ctx).action == "evolved"
    assert tables.read_saved_schema(ctx) == SCHEMA


def test_provision_raises_on_a_damaged_saved_schema(spark, tmp_path):
    ctx = context(spark, tmp_path)
    tables.provision(ctx)
    with open(ctx.saved_schema_path, "w") as out:
        out.write("{")
    (tmp_path / "cp" / "src" / ".demo.Events.target_schema.json.crc").write_bytes(b"")
    with pytest.raises(Exception):
        tables.provision(ctx)


def test_provision_refuses_type_changes(spark, tmp_path):
    tables.provision(context(spark, tmp_path))
    other = T.StructType([SCHEMA["id"], T.StructField("n", T.IntegerType())])
    with pytest.raises(IncompatibleSchema):
        tables.provision(context(spark, tmp_path, schema=other))
    assert tables.read_saved_schema(context(spark, tmp_path)) == SCHEMA


def test_dropped_column_may_not_return_with_another_type(spark, tmp_path):
    tables.provision(with_schema(spark, tmp_path, EXTRA))
    tables.provision(context(spark, tmp_path))
    assert "z" in tables.read_formatted(context(spark, tmp_path)).columns
    with pytest.raises(IncompatibleSchema):
        tables.provision(with_schema(spark, tmp_path, T.StructField("z", T.LongType())))


def test_registered_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS demo LOCATION '{tmp_path}/db'")
    ctx = context(spark, tmp_path, register_tables=True)
    send(ctx, message(1), message(2), "oops")
    run_ingest(ctx)
    assert spark.table("demo.pre_demo_events").count() == 2
    by_outcome = spark.table("demo.pre_demo_events_src").groupBy("outcome").count()
    assert dict(map(tuple, by_outcome.collect())) == {"accepted": 2, "malformed": 1}

    wider = T.StructType([*SCHEMA.fields, EXTRA])
    ctx = context(spark, tmp_path, schema=wider, register_tables=True)
    send(ctx, '{"id":3,"z":"2024-01-02"}')
    run_ingest(ctx)
    table = spark.table("demo.pre_demo_events")
    assert sorted(r.id for r in table.where("z IS NULL").collect()) == [1, 2]
    assert table.where("z IS NOT NULL").first().id == 3
    newest = spark.table("demo.pre_demo_events_latest")
    expected = [(1, "Y", True), (2, "Y", True), (3, "Y", False)]
    assert sorted((r.id, r.current, r.z is None) for r in newest.collect()) == expected

    # Rows that do not make a new snapshot worth it are in the view all the same.
    ctx = context(spark, tmp_path, schema=wider, register_tables=True, publish_share=100.0)
    send(ctx, '{"id":1,"z":"2024-01-02"}', offset=50, at=500)
    number = tables.open_run(ctx)
    run_ingest(ctx)
    assert tables.open_run(ctx) == number
    newest = spark.table("demo.pre_demo_events_latest")
    expected[0] = (1, "Y", False)
    assert sorted((r.id, r.current, r.z is None) for r in newest.collect()) == expected
    assert sorted(map(str, newest.select("id", "z").collect())) == sorted(
        map(str, tables.read_latest(ctx).select("id", "z").collect())
    )

    # A field added inside a column, and a name that needs quoting.
    for fields, sent in (
        ("b: int", '{"id":4,"a":{"b":1},"odd.name":1}'),
        ("b: int, c: int", '{"id":5,"a":{"b":1,"c":2}}'),
    ):
        nested = T.StructType.fromDDL(f"a struct<{fields}>, `odd.name` int")
        schema = T.StructType([*wider.fields, *nested.fields])
        ctx = context(spark, tmp_path, schema=schema, register_tables=True)
        send(ctx, sent)
        run_ingest(ctx)
    for name in ("demo.pre_demo_events", "demo.pre_demo_events_latest"):
        found = {r.id: r.a and r.a.c for r in spark.table(name).collect()}
        assert found == {1: None, 2: None, 3: None, 4: None, 5: 2}
    assert spark.table("demo.pre_demo_events").count() == 6


def test_catalog_entries_are_restored(spark, tmp_path):
    """A catalog that forgot the tables, as a new local session does, learns them anew."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS demo LOCATION '{tmp_path}/db'")
    ctx = context(spark, tmp_path, topic="forgotten", register_tables=True)
    send(ctx, message(1))
    run_ingest(ctx)
    for name in (ctx.table_name, ctx.raw_table_name, ctx.snapshot_table_name(0)):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP VIEW {ctx.latest_table_name}")
    send(ctx, message(2), offset=5)
    run_ingest(ctx)
    for name in (ctx.table_name, ctx.raw_table_name, ctx.latest_table_name):
        assert spark.table(name).count() == 2


def test_a_foreign_table_is_left_alone(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS demo LOCATION '{tmp_path}/db'")
    ctx = context(spark, tmp_path, topic="taken", register_tables=True)
    spark.range(3).write.saveAsTable(ctx.table_name)
    with pytest.raises(ValueError, match="not a table of this library"):
        tables.provision(ctx)
    assert spark.table(ctx.table_name).count() == 3


# -------------------------------------------------------------------- streams


def ids(frame):
    return sorted(row.id for row in frame.collect())


def test_drain_restart_and_late_rows(spark, tmp_path):
    ctx = context(spark, tmp_path, job={"max_files_per_trigger": 1})
    for number in range(4):
        send(ctx, message(number, "first"), offset=number, at=100)
    run = run_ingest(ctx)
    report = run.progress().groupBy("query").agg(F.count("*"), F.sum("input_rows")).collect()
    assert ("pre_demo_events.landing", 4, 4) in [tuple(row) for row in report]
    assert ids(tables.read_formatted(ctx)) == [0, 1, 2, 3]

    again = run_ingest(ctx)
    assert again.progress().count() == 0
    assert ids(tables.read_formatted(ctx)) == [0, 1, 2, 3]

    send(ctx, message(1, "older"), offset=9, at=0)
    send(ctx, message(2, "newer"), offset=10, at=200)
    run_ingest(ctx)
    newest = {row.id: row.n for row in tables.read_latest(ctx).collect()}
    assert newest == {0: "first", 1: "first", 2: "newer", 3: "first"}
    versions = tables.read_history(ctx).where("id = 1").orderBy("timestamp").collect()
    assert [(v.n, v.current, v.valid_to) for v in versions] == [
        ("older", "N", START + dt.timedelta(seconds=100)),
        ("first", "Y", None),
    ]


def test_snapshot_of_latest_rows(spark, tmp_path, monkeypatch):
    """Each run merges its rows into the previous snapshot; a run that dies before
    publishing stays open, and its rows are seen all the same."""
    ctx = context(spark, tmp_path)

    def newest():
        return {row.id: (row.n, row.current) for row in tables.read_latest(ctx).collect()}

    send(ctx, message(1, "a"), message(2, "b"), at=10)
    run_ingest(ctx)
    assert (newest(), tables.open_run(ctx)) == ({1: ("a", "Y"), 2: ("b", "Y")}, 1)

    run_ingest(ctx)
    assert tables.open_run(ctx) == 1

    send(ctx, message(1, "late"), message(3, "c"), at=0, offset=5)
    with monkeypatch.context() as broken:
        broken.setattr("rillstone.plans.ingest.publish_latest", lambda ctx: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_ingest(ctx)
    expected = {1: ("a", "Y"), 2: ("b", "Y"), 3: ("c", "Y")}
    assert (newest(), tables.open_run(ctx)) == (expected, 1)

    for number in (2, 3, 4):
        send(ctx, message(2, f"b{number}"), at=100 * number, offset=10 * number)
        run_ingest(ctx)
        expected[2] = (f"b{number}", "Y")
        assert (newest(), tables.open_run(ctx)) == (expected, number)
    published = documents.read_json(spark, ctx.published_path)
    named = {(slot, run) for held in (published["latest"], published["before"]["latest"]) for slot, run in held.items()}
    folders = (tmp_path / "tables" / "pre_demo_events_snapshot").glob("run=*/__slot=*")
    kept = {(p.name.removeprefix("__slot="), int(p.parent.name.removeprefix("run="))) for p in folders}
    assert kept == named and max(run for _, run in kept) == 3
    everything = tables.latest(
        tables.read_formatted(ctx), ["id"], ["timestamp", "record_partition", "record_offset"]
    )
    assert {r.id: (r.n, "Y") for r in everything.collect()} == expected


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    runs=st.lists(
        st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5)), min_size=1, max_size=6),
        min_size=1,
        max_size=3,
    ),
    share=st.sampled_from([0.0, 0.5, 100.0]),
)
def test_versions_do_not_depend_on_runs(spark, tmp_path_factory, runs, share):
    """Any split into runs, any order of time: latest rows and history are the same."""
    ctx = context(spark, tmp_path_factory.mktemp("runs"), publish_share=share)
    sent = []
    for rows in runs:
        for key, seconds in rows:
            send(ctx, message(key, len(sent)), at=seconds, offset=len(sent))
            sent.append((key, seconds, len(sent)))
        run_ingest(ctx)
    expected = set()
    for key in {row[0] for row in sent}:
        ordered = sorted(row for row in sent if row[0] == key)
        for row, after in zip(ordered, [*ordered[1:], None]):
            until = after and START + dt.timedelta(seconds=after[1])
            expected.add((key, str(row[2]), until, "N" if after else "Y"))
    found = tables.read_history(ctx).select("id", "n", "valid_to", "current").collect()
    assert {tuple(row) for row in found} == expected and len(found) == len(sent)
    newest = tables.read_latest(ctx).select("id", "n").collect()
    assert {tuple(row) for row in newest} == {row[:2] for row in expected if row[3] == "Y"}


def test_snapshot_waits_for_its_share_of_new_rows(spark, tmp_path):
    ctx = context(spark, tmp_path, publish_share=100.0)
    for number in range(4):
        send(ctx, message(number % 2, f"n{number}"), offset=number, at=10 * number)
        run_ingest(ctx)
        assert tables.open_run(ctx) == 1
    newest = {row.id: row.n for row in tables.read_latest(ctx).collect()}
    assert newest == {0: "n2", 1: "n3"}
    run_ingest(dataclasses.replace(ctx, publish_share=0.1))
    assert tables.open_run(ctx) == 2
    assert {row.id: row.n for row in tables.read_latest(ctx).collect()} == newest


def test_snapshots_can_be_switched_off(spark, tmp_path):
    ctx = context(spark, tmp_path, publish_share=None)
    for number in range(3):
        send(ctx, message(number % 2, f"n{number}"), offset=number, at=10 * number)
        run_ingest(ctx)
    assert tables.open_run(ctx) == 0
    assert {row.id: row.n for row in tables.read_latest(ctx).collect()} == {0: "n2", 1: "n1"}


def test_snapshot_by_other_keys_is_not_reused(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1, "a"), message(1, "b"))
    run_ingest(ctx)
    assert tables.read_latest(ctx).count() == 1
    documents.write_json(
        spark, f"{tmp_path}/conf/src/demo.Events/config.json", {"primary_keys": "id,n"}
    )
    finer = load_context(
        spark, ctx.job, ctx.generic, ctx.cluster, record_path=ctx.record_path, register_tables=False
    )
    assert tables.read_latest(finer).count() == 2
    send(finer, message(1, "c"), offset=5)
    run_ingest(finer)
    assert sorted(r.n for r in tables.read_latest(finer).collect()) == ["a", "b", "c"]
    assert tables.open_run(finer) == 2


def test_snapshot_follows_an_added_column(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1))
    run_ingest(ctx)
    ctx = with_schema(spark, tmp_path, EXTRA)
    send(ctx, '{"id":2,"z":"2024-01-02"}', offset=5)
    run_ingest(ctx)
    found = tables.read_latest(ctx).select("id", "n", "z").orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, "x", None), (2, None, dt.date(2024, 1, 2))]


def test_runs_without_records(spark, tmp_path):
    """An empty topic, then rejects only, then a message."""
    ctx = context(spark, tmp_path)
    documents.make_directory(spark, ctx.record_path)
    run_ingest(ctx)
    send(ctx, "oops")
    run_ingest(ctx)
    assert tables.read_rejects(ctx).count() == 1
    for read in (tables.read_formatted, tables.read_latest, tables.read_history, tables.read_raw):
        assert read(ctx).count() == 0
    send(ctx, message(1), offset=5)
    run_ingest(ctx)
    for read in (tables.read_formatted, tables.read_latest, tables.read_history, tables.read_raw):
        assert read(ctx).count() == 1


def test_a_backlog_is_formatted_in_pieces(spark, tmp_path):
    ctx = context(spark, tmp_path, job={"max_files_per_trigger": 1}, formatting_batch_bytes=1)
    for number in range(3):
        send(ctx, message(number), offset=number)
    run = run_ingest(ctx)
    pieces = run.progress().where(F.col("query").endswith(".formatting"))
    assert [row.input_rows for row in pieces.collect()] == [1, 1, 1]
    assert ids(tables.read_latest(ctx)) == [0, 1, 2]


def test_stream_equals_batch(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1), "oops", None, "{}", message(2, "ä\\n"))
    run_ingest(ctx)
    batch = landing_rows(ctx, spark.read.parquet(ctx.record_path))
    streamed = tables.read_archive(ctx)
    assert sorted(map(str, batch.collect())) == sorted(map(str, streamed.collect()))
    shaped = formatted_rows(ctx, batch).select("id", "n", "timestamp")
    stored = tables.read_formatted(ctx).select("id", "n", "timestamp")
    assert sorted(map(str, shaped.collect())) == sorted(map(str, stored.collect()))
    reasons = sorted(row.reason for row in tables.read_rejects(ctx).collect())
    assert reasons == ["malformed", "missing_required", "null_value"]
    assert tables.read_raw(ctx).columns == ["timestamp", "id", "value_raw"]


def test_poison_without_dead_letters_fails_and_changes_nothing(spark, tmp_path):
    ctx = context(spark, tmp_path, dead_letters=False)
    send(ctx, message(1))
    run_ingest(ctx)
    send(ctx, '{"id":"zz"}')
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run_ingest(ctx)
        assert ids(tables.read_formatted(ctx)) == [1]


def test_poison_with_dead_letters_is_one_reject(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1), '{"id":"zz"}')
    run_ingest(ctx)
    assert ids(tables.read_formatted(ctx)) == [1]
    assert [row.value_raw for row in tables.read_rejects(ctx).collect()] == ['{"id":"zz"}']


def test_a_run_that_dies_while_formatting_is_made_up_for(spark, tmp_path):
    """Landed rows wait; the next run formats them, each once."""

    def broken(ctx, rows):
        n = F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("value.n"))
        return rows.select("timestamp", "id", n.alias("n"), *names.POSITION)

    ctx = context(spark, tmp_path)
    send(ctx, message(0))
    run_ingest(ctx)
    send(ctx, message(1), message(2), offset=5)
    with pytest.raises(StreamingQueryException):
        run_ingest(dataclasses.replace(ctx, hooks=Hooks(transform=broken)))
    assert ids(tables.read_raw(ctx)) == ["0", "1", "2"]
    assert ids(tables.read_formatted(ctx)) == ids(tables.read_latest(ctx)) == [0]
    send(ctx, message(3), offset=9)
    run_ingest(ctx)
    assert ids(tables.read_formatted(ctx)) == ids(tables.read_latest(ctx)) == [0, 1, 2, 3]


def test_one_failing_topic_does_not_stop_the_others(spark, tmp_path):
    bad = context(spark, tmp_path, topic="bad", dead_letters=False)
    good = context(spark, tmp_path, topic="good")
    send(bad, "oops")
    send(good, message(1))
    with pytest.raises(StreamingQueryException):
        run_topics([bad, good])
    assert ids(tables.read_formatted(good)) == [1]


def test_run_jobs(spark, tmp_path):
    """A list of job parameters, documents by path, hooks by registry."""
    hooks = Hooks(transform=lambda ctx, rows: rows.select("timestamp", "id", F.lit("h").alias("n")))
    contexts = [context(spark, tmp_path, topic=topic) for topic in ("one", "two")]
    jobs = [{**ctx.job, "max_offsets_per_trigger": 10} for ctx in contexts]
    for name in ("generic", "cluster"):
        documents.write_json(spark, f"{tmp_path}/{name}.json", getattr(contexts[0], name))
    for ctx in contexts:
        send(ctx, message(1), message(2))
    run_jobs(
        spark,
        jobs,
        f"{tmp_path}/generic.json",
        {"src": f"{tmp_path}/cluster.json"},
        {("src", "two"): hooks},
        register_tables=False,
        record_path=contexts[0].record_path,
    )
    found = [[r.n for r in tables.read_formatted(ctx).collect()] for ctx in contexts]
    assert found == [["x", "x"], ["h", "h"]]


def test_topics_may_not_share_a_table(spark, tmp_path):
    with pytest.raises(ValueError, match="share"):
        run_topics([context(spark, tmp_path, topic="a.b"), context(spark, tmp_path, topic="a_b")])


def test_timeout_stops_the_query(spark, tmp_path, monkeypatch):
    ctx = context(spark, tmp_path, job={"max_files_per_trigger": 1})
    for number in range(30):
        send(ctx, message(number))
    tables.provision(ctx)
    query = start_landing(ctx)
    with pytest.raises(draining.DrainTimeout):
        draining.drain(query, 0.01)
    for _ in range(100):
        if not query.isActive:
            break
        time.sleep(0.1)
    assert not query.isActive


def test_removed_and_added_columns_through_the_stream(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1, "kept"))
    run_ingest(ctx)
    ctx = context(spark, tmp_path, schema=T.StructType([SCHEMA["id"], EXTRA]))
    send(ctx, '{"id":2,"n":"unread","z":"2024-01-02"}')
    run_ingest(ctx)
    found = tables.read_formatted(ctx).select("id", "n", "z").orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, "kept", None), (2, None, dt.date(2024, 1, 2))]


# ---------------------------------------------------------------------- hooks


def test_transform_receives_context_and_structured_rows(spark, tmp_path):
    seen = {}

    def transform(ctx, rows):
        seen.update(ctx=ctx, columns=rows.columns)
        return rows.select("timestamp", "id", F.upper("value.n").alias("n"))

    registry = {("src", "demo_events"): Hooks(transform=transform)}
    ctx = context(spark, tmp_path, registry=registry)
    send(ctx, message(1, "shout"))
    run_ingest(ctx)
    assert tables.read_formatted(ctx).first().n == "SHOUT"
    assert isinstance(seen["ctx"], IngestContext)
    assert seen["columns"] == [
        "timestamp", "value", "value_raw", "id", "record_partition", "record_offset",
    ]


def test_transform_columns_match_without_case(spark, tmp_path):
    hooks = Hooks(transform=lambda ctx, rows: rows.select("timestamp", "id", F.lit("y").alias("N")))
    ctx = context(spark, tmp_path, registry={("src", "demo_events"): hooks})
    send(ctx, message(1))
    run_ingest(ctx)
    assert tables.read_formatted(ctx).first().n == "y"


def test_transform_must_keep_required_columns(spark, tmp_path):
    hooks = Hooks(transform=lambda ctx, rows: rows.select("timestamp", "value_raw"))
    ctx = context(spark, tmp_path, registry={("src", "demo_events"): hooks})
    send(ctx, message(1))
    with pytest.raises(ValueError, match="id"):
        run_ingest(ctx)


def test_write_hook_is_handed_to_foreach_batch(spark, tmp_path, monkeypatch):
    """On Delta the stream is wired to the hook; the hook itself is called directly, as
    running foreachBatch would open a callback port."""
    handed = []

    def foreach_batch(writer, function):
        handed.append(function)
        return writer.format("noop")

    def write(ctx, batch, batch_id):
        tables.write_batch(batch, f"{ctx.table_path}/custom", batch_id)

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", foreach_batch)
    for module in ("tables", "ingest"):
        monkeypatch.setattr(f"rillstone.plans.{module}.hook_in_stream", lambda ctx: True)
    ctx = context(spark, tmp_path, registry={("src", "demo_events"): Hooks(write=write)})
    send(ctx, message(1), message(2), "oops")
    run_ingest(ctx)
    batch = formatted_rows(ctx, tables.read_archive(ctx))
    for _ in range(2):
        handed[0](batch, 0)
    assert ids(tables.read_batches(spark, f"{ctx.table_path}/custom", batch.schema)) == [1, 2]


def test_replayed_batch_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "batches")
    frame = spark.range(10).withColumn("part", F.col("id") % 2)
    tables.write_batch(frame, path, 0, ("part",))
    tables.write_batch(frame.where("part = 0"), path, 0, ("part",))
    tables.write_batch(spark.range(10, 12).withColumn("part", F.col("id") % 2), path, 1, ("part",))
    assert ids(tables.read_batches(spark, path, frame.schema)) == [0, 2, 4, 6, 8, 10, 11]


def test_hook_code_reaches_the_executors(spark, tmp_path):
    """The archive named in the generic document can be imported inside tasks."""
    with zipfile.ZipFile(tmp_path / "hooks.zip", "w") as archive:
        archive.writestr("shipped_hooks.py", "def shout(text):\n    return text.upper()\n")

    def transform(ctx, rows):
        @F.pandas_udf("string")
        def shouted(texts: pd.Series) -> pd.Series:
            from shipped_hooks import shout

            return texts.map(shout)

        return rows.select("timestamp", "id", shouted("value.n").alias("n"))

    ctx = context(spark, tmp_path, registry={("src", "demo_events"): Hooks(transform=transform)})
    generic = {
        **ctx.generic,
        "installed_py_files_archive_name": " hooks.zip ",
        "installed_py_files_server_location": f"{tmp_path}/",
    }
    ctx = dataclasses.replace(ctx, generic=generic)
    send(ctx, message(1, "shout"))
    run_ingest(ctx)
    assert tables.read_formatted(ctx).first().n == "SHOUT"


# ---------------------------------------------------------------------- plans


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_ingest_plans_are_narrow_and_messages_parsed_once(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1))
    landing = landing_rows(ctx, spark.read.parquet(ctx.record_path))
    landing.write.partitionBy("outcome").parquet(ctx.raw_path)
    formatted = tables.conform(
        formatted_rows(ctx, tables.read_archive(ctx)),
        tables.formatted_schema(ctx, ctx.target_schema),
    )
    for frame, parses in ((landing, 1), (landing.where("outcome <> 'accepted'"), 1), (formatted, 0)):
        plan = physical(frame)
        assert plan.count("from_json(") == parses
        assert "Exchange" not in plan
    assert "value_raw" not in physical(formatted)


def test_rejects_read_their_partitions_only(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1), "oops")
    run_ingest(ctx)
    plan = physical(tables.read_rejects(ctx))
    assert "PartitionFilters: [isnotnull(outcome" in plan
    narrow = physical(tables.read_formatted(ctx).select("id"))
    assert "ReadSchema: struct<id:bigint>" in narrow


# ---------------------------------------------------------------------- merge


def test_merge_statement_is_valid_sql(spark):
    text = merge.merge_statement(
        "c.t", "incoming", ["a", "b"], ["a", "b", "odd name"], ["timestamp", "record_offset"]
    )
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan
    assert "old.`a` <=> new.`a` AND old.`b` <=> new.`b`" in text
    assert "struct(new.`timestamp`, new.`record_offset`) > struct(old.`timestamp`" in text


def test_merge_write_sends_one_current_row_per_key(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1, "a"), message(1, "b"), message(2, "c"))
    archive = landing_rows(ctx, spark.read.parquet(ctx.record_path))
    rows = merge.newest_in_batch(ctx, formatted_rows(ctx, archive))
    assert sorted((r.id, r.n, r.current) for r in rows.collect()) == [(1, "b", "Y"), (2, "c", "Y")]
    # A Parquet table has no MERGE; the statement reaches the table and is refused.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS demo LOCATION '{tmp_path}/db'")
    merged = context(spark, f"{tmp_path}/other", topic="merged", register_tables=True)
    tables.provision(merged)
    with pytest.raises(Exception, match="MERGE"):
        merge.merge_write(merged, formatted_rows(ctx, archive), 0)


def test_library_keeps_rows_on_the_executors():
    """No row is collected, no lineage cut machine-locally, nothing joined crosswise."""
    refused = re.compile(r"\.collect\(|toPandas|localCheckpoint|crossJoin|\.rdd\b")
    package = pathlib.Path(tables.__file__).parent.parent
    parts = ("functions", "operators", "plans", "sources", "streaming")
    sources = [f for part in parts for f in (package / part).glob("*.py")]
    for source in [*sources, *package.glob("*.py")]:
        assert not refused.search(source.read_text()), source


def test_append_write_names_query_and_batch(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1), message(2))
    batch = formatted_rows(ctx, landing_rows(ctx, spark.read.parquet(ctx.record_path)))
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q-1")
    try:
        assert merge.transaction_options(ctx, batch, 7) == {
            "txnAppId": "pre_demo_events.q-1",
            "txnVersion": "7",
        }
        # Parquet ignores the transaction options; the shape of the rows is checked.
        merge.append_write(ctx, batch, 7)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    written = spark.read.parquet(ctx.table_path)
    assert written.columns == tables.formatted_schema(ctx, ctx.target_schema).names
    assert ids(written) == [1, 2]


def test_a_batch_of_one_file_is_shared_by_tasks(spark, tmp_path):
    from rillstone import queries

    settings = ("spark.sql.files.openCostInBytes", "spark.sql.maxConcurrentOutputFileWriters")
    before = [spark.conf.get(name, None) for name in settings]
    events = spark.range(40_000).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' AS ts", "id AS user_id", "md5(string(id)) AS event_type",
        "0.5D AS value", "CAST(NULL AS STRING) AS props",
    )
    ctx = queries.event_context(spark, str(tmp_path), file_limit=1)
    queries.write_records(queries.event_records(events), ctx.record_path, 1)
    batches = run_ingest(ctx).progress().where(F.col("query").endswith(".landing")).collect()
    assert [row.input_rows for row in batches] == [40_000]
    landed = spark.read.parquet(ctx.raw_path)
    assert landed.count() == landed.select("event_id").distinct().count() == 40_000
    assert len(landed.inputFiles()) > 3
    assert [spark.conf.get(name, None) for name in settings] == before
