"""Declared changes that a table follows, refuses or is refilled for; bad messages; time limits."""

import dataclasses
import json
import subprocess
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import schemas
from rillstone.functions.schemas import IncompatibleSchema
from rillstone.operators.drift import drift_report
from rillstone.plans import ingest, tables
from rillstone.plans.ingest import run_ingest
from rillstone.sources import documents, records
from rillstone.streaming import drain as draining
from tests.test_ingest import context, ids, message, send


def ddl(text):
    return T.StructType.fromDDL(text)


def redeclared(ctx, source, keys="id", target=None, **options):
    """The topic under other declarations."""
    home = f"{ctx.generic['s3_config_prefix']}/src/demo.Events"
    documents.write_json(ctx.spark, f"{home}/config.json", {"primary_keys": keys, "has_target_schema": target is not None})
    documents.write_json(ctx.spark, f"{home}/schema.json", ddl(source).jsonValue())
    if target is not None:
        documents.write_json(ctx.spark, f"{home}/target_schema.json", ddl(target).jsonValue())
    from rillstone.context import load_context

    return load_context(
        ctx.spark, ctx.job, ctx.generic, ctx.cluster, record_path=ctx.record_path, register_tables=False, **options
    )


def everything(ctx):
    return {
        name: sorted(map(str, read(ctx).collect()))
        for name, read in (
            ("formatted", tables.read_formatted), ("archive", tables.read_archive),
            ("latest", tables.read_latest), ("raw", tables.read_raw), ("history", tables.read_history),
        )
    }


# ------------------------------------------------------------ shapes of values


CASES = [
    ("a int, b int", "b int, a int", (1, 2), (2, 1), False),
    ("a int, b int", "b int", (1, 2), (2,), False),
    ("a int", "a int, c string", (1,), (1, None), False),
    ("A int", "a bigint", (1,), (1,), False),
    ("a string", "a double", ("x",), (None,), True),
    ("a string", "a double", ("1.5",), (1.5,), False),
    ("a bigint", "a int", (2**40,), (None,), True),
]


@pytest.mark.parametrize("have,want,value,expected,lost", CASES)
@pytest.mark.parametrize("around", ["{}", "struct<m:struct<{}>>", "array<struct<{}>>", "map<string,struct<{}>>"])
def test_values_take_another_shape_by_name(spark, around, have, want, value, expected, lost):
    def kind(fields):
        inner = ddl(fields)
        if around == "{}":
            return inner
        if around.startswith("struct"):
            return T.StructType([T.StructField("m", inner)])
        return T.ArrayType(inner) if around.startswith("array") else T.MapType(T.StringType(), inner)

    def wrapped(x):
        if around == "{}":
            return x
        return (x,) if around.startswith("struct") else [x, None] if around.startswith("array") else {"k": x}

    before, after = kind(have), kind(want)
    frame = spark.createDataFrame([(wrapped(value),), (None,)], T.StructType([T.StructField("v", before)]))
    loses = schemas.loses(F.col("v"), before, after)
    found = frame.select(
        schemas.shaped(F.col("v"), before, after).alias("v"),
        (F.lit(False) if loses is None else F.coalesce(loses, F.lit(False))).alias("lost"),
    ).collect()

    def plain(x):
        if isinstance(x, tuple):
            return tuple(plain(y) for y in x)
        if isinstance(x, list):
            return [plain(y) for y in x]
        return {k: plain(y) for k, y in x.items()} if isinstance(x, dict) else x

    assert plain(found[0].v) == wrapped(expected) and found[0].lost == lost
    assert found[1].v is None and not found[1].lost


def test_what_cannot_be_converted_at_all_is_refused_before_a_message_comes(spark, tmp_path):
    ctx = context(spark, tmp_path, schema=ddl("id bigint not null, n array<int>"), target=ddl("id bigint, n int"))
    with pytest.raises(IncompatibleSchema, match="cannot become"):
        tables.provision(ctx)
    assert not tables.table_exists(ctx)


# ------------------------------------------------- refused and followed changes


@pytest.fixture
def filled(spark, tmp_path):
    ctx = context(spark, tmp_path)
    send(ctx, message(1, "a"), message(2, "b"), message(1, "c"))
    run_ingest(ctx)
    return ctx


@pytest.mark.parametrize(
    "source,keys,target",
    [
        ("id string, n string", "id", "id string, n string"),
        ("ID bigint, n string", "ID", None),
        ("id bigint, N string", "id", None),
        ("id bigint, n string, g string", "g", "id bigint, n string"),
        ("id bigint, n bigint", "id", "id bigint, n string"),
    ],
)
def test_a_refused_change_leaves_the_table_as_it_is(filled, source, keys, target):
    before = everything(filled)
    with pytest.raises(IncompatibleSchema):
        run_ingest(redeclared(filled, source, keys, target))
    assert everything(filled) == before
    again = redeclared(filled, "id bigint not null, n string")
    send(again, message(7), offset=50)
    run_ingest(again)
    assert ids(tables.read_formatted(again)) == [1, 1, 2, 7]


def test_a_lifted_key_of_another_type_is_refused(spark, tmp_path):
    """The key is no target field; only the messages say its type."""
    target = ddl("n string")
    ctx = context(spark, tmp_path, target=target)
    send(ctx, message(1, "a"))
    run_ingest(ctx)
    before = everything(ctx)
    with pytest.raises(IncompatibleSchema, match="id"):
        run_ingest(redeclared(ctx, "id string, n string", target="n string"))
    with pytest.raises(IncompatibleSchema, match="id"):
        run_ingest(redeclared(ctx, "id bigint, n string", target="n string, id string"))
    assert everything(ctx) == before


def test_added_fields_within_archived_messages(filled):
    ctx = redeclared(filled, "id bigint not null, n string, m struct<a:int>")
    send(ctx, '{"id":3,"m":{"a":1}}', offset=10)
    run_ingest(ctx)
    ctx = redeclared(filled, "id bigint not null, m struct<a:int,b:int>, n string")
    send(ctx, '{"id":4,"m":{"a":1,"b":2}}', offset=20)
    run_ingest(ctx)
    found = {r.id: r.m and (r.m.a, r.m.b) for r in tables.read_formatted(ctx).collect()}
    assert found == {1: None, 2: None, 3: (1, None), 4: (1, 2)}
    assert tables.read_raw(ctx).count() == 5


def test_a_new_key_fills_the_table_anew(spark, tmp_path):
    ctx = context(spark, tmp_path, schema=ddl("id bigint, g string"), target=ddl("id bigint"))
    sent = [f'{{"id":{i},"g":"{"xy"[i % 2]}"}}' for i in range(6)]
    send(ctx, *sent[:4])
    run_ingest(ctx)
    other = redeclared(ctx, "id bigint, g string", "g", "id bigint", refill=True)
    send(other, *sent[4:], offset=4, at=10)
    run_ingest(other)
    assert {(r.g, r.id) for r in tables.read_latest(other).collect()} == {("x", 4), ("y", 5)}
    assert ids(tables.read_formatted(other)) == list(range(6))
    # the archive's older files carry the key within the message only
    assert sorted(r.g for r in tables.read_raw(other).collect()) == ["x"] * 3 + ["y"] * 3
    back = redeclared(ctx, "id bigint, g string", "id", "id bigint")
    run_ingest(back)
    assert tables.read_latest(back).count() == 6


def test_a_refill_that_dies_is_taken_up_again(spark, tmp_path, monkeypatch):
    ctx = context(spark, tmp_path, schema=ddl("id bigint, g string"), target=ddl("id bigint"))
    send(ctx, '{"id":1,"g":"x"}', '{"id":2,"g":"x"}')
    run_ingest(ctx)
    other = redeclared(ctx, "id bigint, g string", "g", "id bigint", refill=True)
    with monkeypatch.context() as broken:
        broken.setattr(tables.documents, "make_directory", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_ingest(other)
    run_ingest(dataclasses.replace(other, refill=False))  # begun, so that it goes on
    assert [(r.g, r.id) for r in tables.read_latest(other).collect()] == [("x", 2)]


# ------------------------------------------------------------- bad messages


TEXTS = st.sampled_from(
    [None, "", "oops", "{}", '{"id":1}', '{"id":null,"v":"1"}', '{"id":2,"v":"1.5"}', '{"id":3,"v":"abc"}',
     '{"id":4,"v":null}', '{"id":"x"}', '{"id":5,"v":"7"}']
)
REASON = {
    None: "null_value", "": "null_value", "oops": "malformed", '{"id":"x"}': "malformed", "{}": "missing_key",
    '{"id":null,"v":"1"}': "missing_key", '{"id":3,"v":"abc"}': "not_castable",
}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(TEXTS, min_size=1, max_size=12))
def test_every_message_is_accepted_or_rejected(spark, tmp_path_factory, texts):
    folder = tmp_path_factory.mktemp("sorted")
    ctx = context(spark, folder, schema=ddl("id bigint, v string"), target=ddl("id bigint, v double"))
    send(ctx, *texts)
    run_ingest(ctx)
    rejected = sorted(r.reason for r in tables.read_rejects(ctx).collect())
    assert rejected == sorted(REASON[t] for t in texts if t in REASON)
    assert tables.read_formatted(ctx).count() == len([t for t in texts if t not in REASON])
    send(ctx, '{"id":9,"v":"2"}', offset=100)
    run_ingest(ctx)
    assert 9 in ids(tables.read_formatted(ctx))


def test_counts_of_differences_inside_arrays_and_maps(spark):
    old = ddl("id bigint, items array<struct<a:int>>, m map<string,struct<a:int>>, `x.y` int")
    new = ddl("id bigint, items array<struct<a:int,b:int>>, m map<string,struct<a:int,b:int>>, `x.y` bigint")
    texts = spark.createDataFrame(
        [
            ('{"id":1,"items":[{"a":1},{"a":1,"b":2}],"m":{"k":{"a":1}},"x.y":1}',),
            ('{"id":2,"items":[{"a":1}],"m":{"k":{"a":1,"b":3},"l":{}}}',),
            ('{"id":3,"items":[],"m":{}}',),
            ('{"id":4}',),
        ],
        "value string",
    )
    found = {(r.path, r.kind): r.messages for r in drift_report(texts, old, new).collect()}
    assert found == {("items.element.b", "added"): 1, ("m.value.b", "added"): 1, ("x.y", "type_changed"): 1}


# ------------------------------------------------------------- time and progress


def test_a_backlog_longer_than_the_time_makes_headway(spark, tmp_path, monkeypatch):
    """What has landed when the time is up is formatted; the next run goes on."""
    ctx = context(spark, tmp_path, job={"max_files_per_trigger": 1})
    for number in range(4):
        send(ctx, message(number), offset=number)
    real = draining.drain

    def hurried(query, timeout=None, reports=None):
        real(query, None, reports)
        if query.name.endswith(".landing"):
            raise draining.DrainTimeout("time is up")

    with monkeypatch.context() as late:
        late.setattr(ingest, "drain", hurried)
        with pytest.raises(draining.DrainTimeout):
            run_ingest(ctx)
    assert ids(tables.read_latest(ctx)) == [0, 1, 2, 3]
    send(ctx, message(9), offset=9)
    run_ingest(ctx)
    assert ids(tables.read_formatted(ctx)) == [0, 1, 2, 3, 9]


def test_progress_of_more_batches_than_are_retained(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(draining, "HELD", 2)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None)
    ctx = context(spark, tmp_path, job={"max_files_per_trigger": 1})
    for number in range(7):
        send(ctx, message(number), offset=number)
    run = run_ingest(ctx)
    landed = run.progress().where(F.col("query").endswith(".landing")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows) for r in landed] == [(i, 1) for i in range(7)]
    run.reports.seen["pre_demo_events.landing"].discard(3)
    with pytest.raises(draining.IncompleteProgress, match=r"\[3\]"):
        run.progress()
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None) == before


def test_limits_have_one_meaning_each():
    cluster = {"bootstrap_servers": "h", "consumer_group_id": "g"}
    job = {"kafka_topic_name": "t"}
    assert "maxOffsetsPerTrigger" not in records.consumer_options(cluster, job)
    limited = records.consumer_options(cluster, {**job, "max_offsets_per_trigger": 5, "max_files_per_trigger": 2})
    assert limited["maxOffsetsPerTrigger"] == "5"


def test_limits_of_files_are_not_those_of_records(spark, tmp_path):
    assert context(spark, tmp_path, job={"max_offsets_per_trigger": 5}).file_limit is None
    assert context(spark, tmp_path, job={"max_files_per_trigger": 5}).file_limit == 5


# ----------------------------------------------------------------- documents


def test_a_replacement_that_fails_leaves_the_old_document(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/doc.json"
    documents.write_json(spark, path, {"x": 1})
    with monkeypatch.context() as broken:
        broken.setattr(documents, "_replace", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            documents.write_json(spark, path, {"x": 2})
    assert documents.read_json(spark, path) == {"x": 1}
    documents.write_json(spark, path, {"x": 3})
    assert documents.read_json(spark, path) == {"x": 3}


# ----------------------------------------------------------------------- sort


RUN = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
  .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1])
  .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
  .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.shuffle.partitions", "2").getOrCreate())
from rillstone.queries import QUERIES
QUERIES["stream_drain"](spark, "/root/testdata/sf0.001").count()
spark.stop()
"""


def test_streaming_stages_do_not_sort(tmp_path):
    """From the event log: the file writer's own sort is not in any plan."""
    (tmp_path / "events").mkdir()
    args = [sys.executable, "-c", RUN, str(tmp_path / "events"), str(tmp_path / "shared")]
    subprocess.run(args, check=True, capture_output=True, cwd=tables.__file__.rsplit("/", 3)[0])
    sorted_, streamed = 0, 0
    for path in (tmp_path / "events").iterdir():
        for line in path.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageSubmitted":
                properties = event.get("Properties") or {}
                if "sql.streaming.queryId" in properties:
                    streamed += 1
                    scopes = [json.loads(r["Scope"])["name"] for r in event["Stage Info"]["RDD Info"] if "Scope" in r]
                    sorted_ += any("Sort" in scope for scope in scopes)
    assert streamed >= 2 and sorted_ == 0
