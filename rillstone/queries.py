"""The registered queries: each sends a whole table through the ingest operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.context import Hooks, IngestContext, load_context
from rillstone.functions import schemas
from rillstone.functions.keys import key_names, split_keys
from rillstone.operators.drift import drift_report
from rillstone.operators.observed import observed_fields as fields_seen
from rillstone.operators.offsets import offset_report
from rillstone.operators.parse import flatten, raw_rows, reduce_records, structured
from rillstone.operators.quality import accepted, classify, rejects
from rillstone.operators.versions import history, latest, merge_latest
from rillstone.plans import tables
from rillstone.plans.compaction import compact
from rillstone.plans.ingest import run_ingest, run_pattern, run_topics
from rillstone.plans.redrive import redrive
from rillstone.sources import documents
from rillstone.sources.records import MICROSECONDS, envelope
from rillstone.streaming.drain import DrainTimeout
from rillstone.streaming.stages import formatted_rows, landing_rows
from rillstone.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --------------------------------------------------------------------- fixtures


LONG, INT, TEXT, DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
TIME = T.TimestampNTZType()


def struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    """A schema of the given fields, of which some are non-null."""
    return T.StructType(
        [T.StructField(name, kind, name not in required) for name, kind in fields.items()]
    )


EVENT_FIELDS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENT = struct(
    required=("event_id",),
    event_id=LONG,
    ts=TIME,
    user_id=LONG,
    event_type=TEXT,
    value=DOUBLE,
    props=TEXT,
)
EVENT_KEY = split_keys("event_id")
USER_KEY = split_keys("user_id")
ORDER = struct(
    o_orderkey=LONG,
    o_custkey=LONG,
    o_orderstatus=TEXT,
    o_totalprice=DOUBLE,
    o_orderdate=TIME,
    o_orderpriority=TEXT,
)
CUSTOMER = struct(
    c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=TEXT
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def event_records(events: DataFrame, payload: Any = EVENT_FIELDS) -> DataFrame:
    """Events as records: the event id is the offset."""
    return envelope(events, payload, time=F.col("ts"), offset=F.col("event_id"), topic="events")


def event_texts(spark: SparkSession, sf_dir: str, payload: Any = EVENT_FIELDS) -> DataFrame:
    return reduce_records(event_records(read(spark, sf_dir, "events"), payload))


def naive(column: str) -> Column:
    """A record time as the tables hold it, without a zone."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def topic_files(spark: SparkSession, sf_dir: str, table: str) -> int:
    """Files of a topic's fixture: eight, as if of eight partitions, or as many times
    eight as keep each below 64 MB of its table."""
    size = documents.size(spark, f"{sf_dir}/{table}.parquet")
    return 8 * (size // (8 * 64 * 2**20) + 1)


# Messages of a row group of record files, before compression: what one task reads at least.
GROUP_BYTES = 2**20


def write_records(records: DataFrame, path: str, files: int) -> None:
    """Record files, dealt by offset, in row groups that tasks can share."""
    dealt = records.repartitionById(files, F.pmod("offset", F.lit(files)).cast("int"))
    dealt.write.mode("append").option("parquet.block.size", GROUP_BYTES).parquet(path)


def topic_context(
    spark: SparkSession,
    folder: str,
    topic: str,
    schema: T.StructType | dict[str, Any],
    primary_keys: str,
    *,
    target: T.StructType | None = None,
    file_limit: int | None = None,
    timeout: float | None = None,
    database: str = "demo",
    hooks: Hooks | None = None,
    **options: Any,
) -> IngestContext:
    """Write a topic's documents below ``folder`` and load its context from them."""
    home = f"{folder}/conf/demo/{topic}"
    config = {"primary_keys": primary_keys, "has_target_schema": target is not None}
    declared = schema if isinstance(schema, dict) else schema.jsonValue()
    documents.write_json(spark, f"{home}/config.json", config)
    documents.write_json(spark, f"{home}/schema.json", declared)
    if target is not None:
        documents.write_json(spark, f"{home}/target_schema.json", target.jsonValue())
    job = {"env": "dev", "source": "demo", "topic_name": topic, "kafka_topic_name": topic}
    if file_limit is not None:
        job["max_files_per_trigger"] = file_limit
    options = {"register_tables": False, **options}
    return load_context(
        spark,
        job,
        {
            "s3_config_prefix": f"{folder}/conf",
            "formatted_checkpoint_prefix": f"{folder}/checkpoints",
            "formatted_table_prefix": f"{folder}/tables",
            "formatted_table_catalog": database,
            "query_poll_timeout_seconds": timeout,
        },
        {"resource_name_prefix": "demo"},
        {("demo", topic): hooks} if hooks else {},
        record_path=f"{folder}/records/{topic}",
        **options,
    )


def event_context(spark: SparkSession, folder: str, **options: Any) -> IngestContext:
    options = {"schema": EVENT, "primary_keys": "event_id", **options}
    return topic_context(spark, folder, "events", **options)


# --------------------------------------------------------- parsing and keys


@query
def kafka_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = structured(event_texts(spark, sf_dir), EVENT, EVENT_KEY)
    return flatten(rows).select(*EVENT_FIELDS)


@query
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = envelope(
        read(spark, sf_dir, "orders"),
        ORDER.names,
        time=F.col("o_orderdate"),
        offset=F.col("o_orderkey"),
        topic="orders",
    )
    rows = structured(reduce_records(records), ORDER, split_keys("o_custkey, o_orderkey"))
    return rows.select(
        naive("timestamp"),
        "o_custkey",
        "o_orderkey",
        F.col("value.o_totalprice").alias("o_totalprice"),
    )


@query
def nested_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = [F.struct("user_id").alias("meta"), "event_id"]
    schema = struct(meta=struct(user_id=LONG), event_id=LONG)
    rows = structured(event_texts(spark, sf_dir, payload), schema, split_keys("meta.user_id"))
    return rows.select(F.col("value.event_id").alias("event_id"), "meta_user_id")


@query
def missing_and_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = ["event_id", "user_id", F.lit(1).alias("extra")]
    rows = structured(event_texts(spark, sf_dir, payload), EVENT, EVENT_KEY)
    return flatten(rows).select("event_id", "user_id", "props")


@query
def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat(
        F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":'), F.col("user_id"), F.lit("}")
    )
    rows = structured(event_texts(spark, sf_dir, message), EVENT, EVENT_KEY)
    return raw_rows(rows, EVENT_KEY).withColumn("timestamp", naive("timestamp"))


@query
def transform_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = struct(k=INT)

    def transform(ctx: IngestContext, rows: DataFrame) -> DataFrame:
        parsed = F.from_json(F.col("value.props"), props).getField("k")
        return flatten(rows.withColumn("k", parsed))

    ctx = event_context(spark, new_folder(spark, "transform"), hooks=Hooks(transform=transform))
    archive = landing_rows(ctx, event_records(read(spark, sf_dir, "events")))
    return formatted_rows(ctx, archive).select("event_id", "k")


@query
def documents_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with every kind of character."""
    fields = ("doc_id", "text", "lang", "source", "n_chars")
    schema = struct(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG)
    records = envelope(
        read(spark, sf_dir, "documents"),
        fields,
        time=F.timestamp_seconds("doc_id"),
        offset=F.col("doc_id"),
        topic="documents",
    )
    rows = structured(reduce_records(records), schema, split_keys("doc_id"))
    return flatten(rows).select(*fields)


@query
def pages_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup inside messages."""
    records = envelope(
        read(spark, sf_dir, "pages"),
        ("page_id", "url", "html"),
        time=F.timestamp_seconds("page_id"),
        offset=F.col("page_id"),
        topic="pages",
    )
    schema = struct(page_id=LONG, url=TEXT, html=TEXT)
    rows = structured(reduce_records(records), schema, split_keys("page_id"))
    return flatten(rows).select("page_id", "url", "html")


@query
def embeddings_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays inside messages; reported per element, counted from 1."""
    records = envelope(
        read(spark, sf_dir, "embeddings"),
        ("vec_id", "embedding", "label"),
        time=F.timestamp_seconds("vec_id"),
        offset=F.col("vec_id"),
        topic="embeddings",
    )
    schema = struct(vec_id=LONG, embedding=T.ArrayType(T.FloatType()), label=INT)
    rows = flatten(structured(reduce_records(records), schema, split_keys("vec_id")))
    return rows.select("vec_id", "label", F.posexplode("embedding").alias("i", "x")).select(
        "vec_id", "label", (F.col("i") + 1).alias("i"), F.col("x").cast("double").alias("x")
    )


# ------------------------------------------------------------------ rejects


def broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as texts; every 97th message lacks its last character."""
    message = F.to_json(F.struct(*EVENT_FIELDS))
    cut = F.col("event_id") % 97 == 0
    message = F.when(cut, F.substring(message, F.lit(1), F.length(message) - 1)).otherwise(message)
    return event_texts(spark, sf_dir, message)


@query
def deadletter_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rejects(classify(broken_events(spark, sf_dir), EVENT, EVENT_KEY))
    return found.select(F.col("record_offset").alias("event_id"), "reason")


@query
def deadletter_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(classify(broken_events(spark, sf_dir), EVENT, EVENT_KEY))
    return flatten(rows).select("event_id", "user_id", "event_type", "value")


@query
def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.when(F.col("event_id") % 50 != 0, F.to_json(F.struct("event_id", "user_id")))
    sorted_out = classify(event_texts(spark, sf_dir, message), EVENT, EVENT_KEY)
    return sorted_out.groupBy("outcome").agg(F.count("*").alias("n"))


@query
def missing_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without their user, who is the key."""
    user = F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id")
    schema = struct(event_id=LONG, user_id=LONG)
    found = rejects(classify(event_texts(spark, sf_dir, ["event_id", user]), schema, USER_KEY))
    return found.select(F.col("record_offset").alias("event_id"), "reason")


@query
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id")
    schema = struct(required=("event_id", "user_id"), event_id=LONG, user_id=LONG)
    found = rejects(classify(event_texts(spark, sf_dir, ["event_id", user]), schema, EVENT_KEY))
    return found.select(F.col("record_offset").alias("event_id"), "reason")


@query
def trailing_text_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole events, some with something behind them that a JSON parser does not reach."""
    whole = F.to_json(F.struct(*EVENT_FIELDS), MICROSECONDS)
    tails = ("x", " " , "{}", "]", "}", ",", ',{"event_id":1}', "] , [2", "\n")
    message = whole
    for number, tail in enumerate(tails):
        message = F.when(F.col("event_id") % 20 == number, F.concat(whole, F.lit(tail))).otherwise(message)
    found = classify(event_texts(spark, sf_dir, message), EVENT, EVENT_KEY)
    return found.select(F.col("record_offset").alias("event_id"), "outcome")


@query
def reject_redrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events lack a required user, some are broken. A redrive under the same declaration, and
    two under one that lets the user be absent: each event is accepted or rejected, once."""
    folder = new_folder(spark, "redrive")
    user = F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id")
    whole = F.to_json(F.struct("event_id", user, "event_type"))
    message = F.when(F.col("event_id") % 97 == 0, F.concat(whole, F.lit("}"))).otherwise(whole)
    fields = {"event_id": LONG, "user_id": LONG, "event_type": TEXT}
    ctx = event_context(spark, folder, schema=struct(required=("user_id",), **fields))
    write_records(event_records(read(spark, sf_dir, "events"), message), ctx.record_path, topic_files(spark, sf_dir, "events"))
    run_ingest(ctx)
    redrive(ctx)
    ctx = event_context(spark, folder, schema=struct(**fields))
    for _ in range(2):
        redrive(ctx)
    good = tables.read_formatted(ctx).select("event_id", "user_id", "event_type", F.lit("accepted").alias("outcome"))
    event_id = F.get_json_object("value_raw", "$.event_id").cast("long").alias("event_id")
    bad = tables.read_rejects(ctx).select(
        event_id, F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("string").alias("event_type"), "reason"
    )
    return good.union(bad)


# ----------------------------------------------------------------- versions


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten(structured(event_texts(spark, sf_dir), EVENT, USER_KEY))
    newest = latest(rows, key_names(USER_KEY), ["timestamp", "record_offset"])
    return newest.select("user_id", "event_id", "ts", "event_type", "value")


@query
def late_arrival_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest third of the events arrives first."""
    events = read(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = events.agg(F.percentile_approx(micros, 2 / 3)).first()[0]
    since = F.timestamp_micros(F.lit(cut)).cast("timestamp_ntz")
    key, order = ["event_type"], ["timestamp", "record_offset"]

    def rows(part: DataFrame) -> DataFrame:
        texts = reduce_records(event_records(part))
        return flatten(structured(texts, EVENT, split_keys("event_type")))

    state = latest(rows(events.where(F.col("ts") >= since)), key, order)
    state = merge_latest(state, rows(events.where(F.col("ts") < since)), key, order)
    return state.select("event_type", "event_id", "ts", "user_id")


@query
def orders_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many keys with few rows each."""
    records = envelope(
        read(spark, sf_dir, "orders"),
        ORDER.names,
        time=F.col("o_orderdate"),
        offset=F.col("o_orderkey"),
        topic="orders",
    )
    rows = flatten(structured(reduce_records(records), ORDER, split_keys("o_custkey")))
    newest = latest(rows, ["o_custkey"], ["timestamp", "record_offset"])
    return newest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows as one batch of a written table, as the history finds them."""
    folder = new_folder(spark, label)
    tables.write_batch(rows, folder, 0)
    return tables.read_batches(spark, folder, rows.schema)


@query
def history_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to accepted rows to a table, and its history per user."""
    rows = flatten(accepted(classify(event_texts(spark, sf_dir), EVENT, USER_KEY)))
    versions = history(stored(spark, rows, "history"), key_names(USER_KEY))
    return versions.select(
        "user_id", "event_id", naive("timestamp"), naive("valid_to"), "current"
    )


ITEM_KEY = split_keys("l_returnflag")
ITEM_TIE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
ITEM = struct(
    l_orderkey=LONG,
    l_partkey=LONG,
    l_suppkey=LONG,
    l_linenumber=INT,
    l_quantity=DOUBLE,
    l_extendedprice=DOUBLE,
    l_discount=DOUBLE,
    l_tax=DOUBLE,
    l_returnflag=TEXT,
    l_linestatus=TEXT,
    l_shipdate=TIME,
)


def item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items keyed by return flag: three keys for the whole table."""
    records = envelope(
        read(spark, sf_dir, "lineitem"),
        ITEM.names,
        time=F.col("l_shipdate"),
        offset=F.col("l_orderkey"),
        topic="lineitem",
    )
    return flatten(accepted(classify(reduce_records(records), ITEM, ITEM_KEY)))


@query
def lineitem_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys, each with a large part of the table."""
    newest = latest(item_rows(spark, sf_dir), key_names(ITEM_KEY), ["timestamp", *ITEM_TIE])
    return newest.select(*ITEM.names, naive("timestamp"))


@query
def lineitem_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys, all of them taken as hot, with many rows at one instant."""
    versions = history(
        stored(spark, item_rows(spark, sf_dir), "history"),
        key_names(ITEM_KEY),
        tie=ITEM_TIE,
        hot_rows=1000,
    )
    return versions.select(*ITEM.names, naive("timestamp"), naive("valid_to"), "current")


@query
def conversation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as versions of it."""
    schema = struct(conv_id=LONG, turn=LONG, role=TEXT, text=TEXT)
    records = envelope(
        read(spark, sf_dir, "conversations"),
        schema.names,
        time=F.timestamp_seconds("turn"),
        offset=F.col("turn"),
        topic="conversations",
    )
    keys = split_keys("conv_id")
    rows = flatten(accepted(classify(reduce_records(records), schema, keys)))
    versions = history(stored(spark, rows, "history"), key_names(keys))
    return versions.select(
        "conv_id", "turn", "role", "text", F.unix_seconds("valid_to").alias("next_turn"), "current"
    )


def in_batches(spark: SparkSession, sf_dir: str, ctx: IngestContext, batch: Column, batches: int) -> None:
    """All events, in so many runs."""
    events = read(spark, sf_dir, "events").withColumn("__batch", batch)
    files = topic_files(spark, sf_dir, "events")
    for number in range(batches):
        part = events.where(F.col("__batch") == number).drop("__batch")
        write_records(event_records(part), ctx.record_path, files)
        run_ingest(ctx)


@query
def bucketed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most events, then those of a tenth of the users: buckets of their keys are written again."""
    ctx = event_context(
        spark, new_folder(spark, "buckets"), primary_keys="user_id", publish_share=0.0, buckets=8
    )
    late = (F.col("user_id") % 10 == 0) & (F.col("event_id") % 2 == 0)
    in_batches(spark, sf_dir, ctx, late.cast("int"), 2)
    return tables.read_latest(ctx).select(*EVENT_FIELDS, naive("timestamp"), "current")


@query
def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three runs, rewritten by user after the second; the log and the latest rows."""
    ctx = event_context(spark, new_folder(spark, "compact"), primary_keys="user_id", publish_share=100.0)
    run = F.pmod("event_id", F.lit(3))
    in_batches(spark, sf_dir, ctx, run, 2)
    compact(ctx)
    in_batches(spark, sf_dir, ctx, run - 2, 1)
    newest = tables.read_latest(ctx).select("event_id", F.lit("latest").alias("place"))
    return tables.read_formatted(ctx).select("event_id", F.lit("log").alias("place")).unionByName(newest)


@query
def history_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four runs, in no order of time: intervals are stored and split by late rows."""
    ctx = event_context(
        spark, new_folder(spark, "intervals"), primary_keys="user_id",
        publish_share=0.0, buckets=8, store_history=True,
    )
    in_batches(spark, sf_dir, ctx, F.pmod(F.col("event_id") * 7 + 3, F.lit(4)), 4)
    rows = tables.read_history(ctx)
    return rows.select(*EVENT_FIELDS, naive("timestamp"), naive("valid_to"), "current")


# ------------------------------------------------------------------ schemas


@query
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of two declarations, with the events that carry each."""
    payload = [
        "event_id",
        "user_id",
        "event_type",
        F.struct("user_id", F.when(F.col("event_id") % 3 == 0, F.col("props")).alias("note")).alias(
            "meta"
        ),
        F.array(
            F.struct("user_id", F.lit(None).cast("string").alias("kind")),
            F.struct("user_id", F.when(F.col("event_id") % 5 == 0, F.col("event_type")).alias("kind")),
        ).alias("parts"),
    ]
    part = struct(user_id=LONG)
    old = struct(
        event_id=LONG, user_id=TEXT, event_type=TEXT, meta=part, parts=T.ArrayType(part)
    )
    new = struct(
        event_id=LONG,
        user_id=LONG,
        meta=struct(user_id=LONG, note=TEXT),
        parts=T.ArrayType(struct(user_id=LONG, kind=TEXT)),
        value=DOUBLE,
    )
    return drift_report(event_texts(spark, sf_dir, payload), old, new)


@query
def observed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that messages carry, declared or not, in all their types."""
    rest = lambda n: F.col("event_id") % n
    user = F.when(rest(5) == 0, F.concat(F.lit('"u'), "user_id", F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    message = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), user,
        F.lit(',"event_type":'), F.when(rest(7) == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"'))),
        F.when(rest(3) == 0, F.lit(',"meta":{"source":"web","more":{"a b":1}}')).otherwise(F.lit("")),
        F.when(rest(4) == 0, F.lit(',"parts":[{"kind":1},{"kind":2,"note":"n"}]')).otherwise(F.lit("")),
        F.when(rest(6) == 0, F.concat(F.lit(',"tags":{"t'), rest(50).cast("string"), F.lit('":1.5}'))).otherwise(F.lit("")),
        F.when(rest(97) != 0, F.lit("}")).otherwise(F.lit("")),
    )
    declared = struct(
        event_id=LONG, user_id=LONG, event_type=TEXT, value=DOUBLE,
        parts=T.ArrayType(struct(kind=TEXT)), tags=T.MapType(TEXT, LONG),
    )
    return fields_seen(event_texts(spark, sf_dir, message), declared)


@query
def schema_evolve_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events arrive under a declaration without props, the others with it."""
    folder = new_folder(spark, "evolve")
    events = read(spark, sf_dir, "events")
    files = topic_files(spark, sf_dir, "events")
    before = struct(event_id=LONG, user_id=LONG)
    after = struct(event_id=LONG, user_id=LONG, props=TEXT)
    for rest, schema in enumerate((before, after)):
        ctx = event_context(spark, folder, schema=schema)
        arrived = event_records(events.where(F.col("event_id") % 2 == rest), schema.names)
        write_records(arrived, ctx.record_path, files)
        run_ingest(ctx)
    return tables.read_formatted(ctx).select("event_id", "user_id", "props")


@query
def target_schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with fewer columns than the messages, resolved per user."""
    folder = new_folder(spark, "target")
    target = struct(event_id=LONG, user_id=LONG, event_type=TEXT)
    ctx = event_context(spark, folder, primary_keys="user_id", target=target)
    files = topic_files(spark, sf_dir, "events")
    write_records(event_records(read(spark, sf_dir, "events")), ctx.record_path, files)
    run_ingest(ctx)
    rows = tables.read_history(ctx)
    kept = [f.name for f in schemas.extend_target(target).fields]
    return rows.select(*kept).withColumn("timestamp", naive("timestamp"))


def nested_target(
    spark: SparkSession, sf_dir: str, payload: list[Column | str], source: T.StructType, target: T.StructType
) -> DataFrame:
    """Events with a payload of their own, through a whole run into another shape."""
    ctx = event_context(spark, new_folder(spark, "nested"), schema=source, target=target)
    records = event_records(read(spark, sf_dir, "events"), payload)
    write_records(records, ctx.record_path, topic_files(spark, sf_dir, "events"))
    run_ingest(ctx)
    return tables.read_formatted(ctx)


@query
def nested_target_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a struct declared in another order: they meet by name."""
    payload = ["event_id", F.struct(F.col("user_id").alias("a"), F.col("event_id").alias("b")).alias("m")]
    source = struct(event_id=LONG, m=struct(a=LONG, b=LONG))
    target = struct(event_id=LONG, m=struct(b=LONG, a=LONG))
    rows = nested_target(spark, sf_dir, payload, source, target)
    return rows.select("event_id", F.col("m.a").alias("a"), F.col("m.b").alias("b"))


@query
def nested_target_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer fields within a struct and within the elements of an array, one of them new."""
    pair = F.struct(F.col("user_id").alias("a"), F.col("event_type").alias("b"))
    payload = ["event_id", pair.alias("m"), F.array(pair, pair).alias("s")]
    inner = struct(a=LONG, b=TEXT)
    source = struct(event_id=LONG, m=inner, s=T.ArrayType(inner))
    target = struct(event_id=LONG, m=struct(b=TEXT), s=T.ArrayType(struct(a=LONG, c=TEXT)))
    rows = nested_target(spark, sf_dir, payload, source, target)
    return rows.select(
        "event_id",
        F.col("m.b").alias("b"),
        F.size("s").alias("parts"),
        F.element_at("s", 2).getField("a").alias("a"),
        F.element_at("s", 1).getField("c").alias("c"),
    )


@query
def key_change_refill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events under a key of the table, then all under one that only messages carry."""
    folder = new_folder(spark, "rekeyed")
    events = read(spark, sf_dir, "events")
    target = struct(event_id=LONG, event_type=TEXT)
    for rest, key in enumerate(("event_id", "user_id")):
        ctx = event_context(spark, folder, primary_keys=key, target=target, refill=True)
        part = event_records(events.where(F.col("event_id") % 2 == rest))
        write_records(part, ctx.record_path, topic_files(spark, sf_dir, "events"))
        run_ingest(ctx)
    return tables.read_latest(ctx).select("user_id", "event_id", "event_type")


@query
def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text in the messages is a number in the table; some texts are none."""
    text = F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.col("user_id").cast("string"))
    ctx = event_context(
        spark,
        new_folder(spark, "cast"),
        schema=struct(event_id=LONG, v=TEXT),
        target=struct(event_id=LONG, v=LONG),
    )
    records = event_records(read(spark, sf_dir, "events"), ["event_id", text.alias("v")])
    write_records(records, ctx.record_path, topic_files(spark, sf_dir, "events"))
    run_ingest(ctx)
    good = tables.read_formatted(ctx).select("event_id", "v", F.lit("accepted").alias("outcome"))
    event_id = F.get_json_object("value_raw", "$.event_id").cast("long").alias("event_id")
    bad = tables.read_rejects(ctx).select(event_id, F.lit(None).cast("long").alias("v"), "reason")
    return good.union(bad)


@query
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered tables by name, before and after a column is added."""
    folder = new_folder(spark, "catalog")
    database = f"catalog_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    events = read(spark, sf_dir, "events")
    parts = []
    declared = (struct(event_id=LONG, user_id=LONG), struct(event_id=LONG, user_id=LONG, props=TEXT))
    for rest, schema in enumerate(declared):
        ctx = event_context(spark, folder, schema=schema, database=database, register_tables=True)
        part = event_records(events.where(F.col("event_id") % 2 == rest), schema.names)
        write_records(part, ctx.record_path, topic_files(spark, sf_dir, "events"))
        run_ingest(ctx)
        props = "props" if rest else "CAST(NULL AS STRING) AS props"
        raw = "CAST(event_id AS BIGINT) AS event_id, CAST(get_json_object(value_raw, '$.user_id') AS BIGINT) AS user_id"
        for name, columns in (
            (ctx.table_name, f"event_id, user_id, {props}"),
            (ctx.latest_table_name, f"event_id, user_id, {props}"),
            (ctx.raw_table_name, f"{raw}, get_json_object(value_raw, '$.props') AS props"),
        ):
            label = f"{'after' if rest else 'before'} {name.removeprefix(database + '.')}"
            rows = spark.sql(f"SELECT '{label}' AS part, {columns} FROM {name}")
            parts.append(stored(spark, rows, "seen").drop("batch_id"))
    spark.sql(f"DROP DATABASE {database} CASCADE")  # entries only: the files lie elsewhere
    return reduce(DataFrame.unionByName, parts)


# Declarations used by the two queries below.
AVRO_EVENT = {
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "user_id", "type": ["null", "long"]},
        {"name": "event_type", "type": ["null", "string"]},
        {"name": "value", "type": ["null", "double"]},
    ],
}
AVRO_WITH_REF = {
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "user", "type": ["null", "REF_Party"]},
    ],
}
REF_TEMPLATE = {
    "type": "record",
    "name": "REF_NAME",
    "fields": [{"name": "id", "type": "long"}],
}


@query
def ref_type_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "refs")
    documents.write_json(spark, f"{folder}/conf/workflow/ref_type.json", REF_TEMPLATE)
    ctx = event_context(spark, folder, schema=AVRO_WITH_REF)
    payload = ["event_id", F.struct(F.col("user_id").alias("id")).alias("user")]
    texts = event_texts(spark, sf_dir, payload)
    rows = structured(texts, ctx.source_schema, ctx.keys)
    return rows.select("event_id", F.col("value.user.id").alias("user_ref_id"))


@query
def avro_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = event_context(spark, new_folder(spark, "avro"), schema=AVRO_EVENT)
    archive = landing_rows(ctx, event_records(read(spark, sf_dir, "events")))
    return formatted_rows(ctx, archive).select("event_id", "user_id", "event_type", "value")


AVRO_READER = {
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "user_id", "type": ["null", "long"], "aliases": ["account", "uid"]},
        {"name": "event_type", "type": "string", "default": "unknown"},
        {"name": "value", "type": ["null", "double"]},
        {
            "name": "parts",
            "type": {"type": "array", "items": {
                "type": "record", "name": "Part", "fields": [
                    {"name": "kind", "type": "string", "aliases": ["k"]},
                    {"name": "n", "type": "int", "default": 7},
                ],
            }},
            "default": [{"kind": "none"}],
        },
    ],
}


@query
def avro_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writers of one topic: old names, whole numbers and fields left out, read as declared."""
    payload = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(
        "event_id", F.col("user_id").alias("uid"), F.floor("value").alias("value"),
        F.array(F.struct(F.col("event_type").alias("k"))).alias("parts"),
    ))).when(F.col("event_id") % 3 == 1, F.to_json(F.struct(
        "event_id", F.col("user_id").alias("account"), "event_type", "value",
    ))).otherwise(F.to_json(F.struct(
        "event_id", "user_id", "event_type", "value",
        F.array(F.struct(F.col("event_type").alias("kind"), F.lit(1).alias("n"))).alias("parts"),
    )))
    ctx = event_context(spark, new_folder(spark, "resolution"), schema=AVRO_READER)
    archive = landing_rows(ctx, event_records(read(spark, sf_dir, "events"), payload))
    rows = formatted_rows(ctx, archive)
    part = F.get("parts", F.lit(0))
    return rows.select(
        "event_id", "user_id", "event_type", "value",
        part["kind"].alias("kind"), part["n"].alias("n"), F.size("parts").alias("parts"),
    )


# ---------------------------------------------------------- batches and streams


@query
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches by range of ids, each written twice."""
    folder = new_folder(spark, "replay")
    texts = event_texts(spark, sf_dir)
    rows = stored(spark, flatten(accepted(classify(texts, EVENT, EVENT_KEY))), "accepted")
    rows = rows.drop("batch_id")
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    width = (high - low) // 4 + 1
    for batch_id in range(4):
        first = low + batch_id * width
        part = rows.where(F.col("event_id").between(first, first + width - 1))
        for _ in range(2):
            tables.write_batch(part, folder, batch_id)
    batches = tables.read_batches(spark, folder, rows.schema)
    return batches.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("id_sum")
    )


@query
def write_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A custom write keeps errors only, and survives a second delivery."""
    folder = new_folder(spark, "hook")

    def write(ctx: IngestContext, batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch.where(F.col("event_type") == "error"), ctx.table_path, batch_id)

    ctx = event_context(spark, folder, hooks=Hooks(write=write))
    archive = landing_rows(ctx, event_records(read(spark, sf_dir, "events")))
    batch = formatted_rows(ctx, archive)
    for _ in range(2):
        ctx.hooks.write(ctx, batch, 0)
    stored_rows = tables.read_batches(spark, ctx.table_path, batch.schema)
    return stored_rows.select("event_id", "user_id", "value")


@query
def write_hook_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run calls the hook; the first one dies between the hook and its ledger, and more
    events come before the next: every error once."""
    folder = new_folder(spark, "hook-run")
    calls = []

    def write(ctx: IngestContext, batch: DataFrame, batch_id: int) -> None:
        errors = batch.where(F.col("event_type") == "error")
        tables.write_batch(errors, f"{folder}/errors", batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise InterruptedError("killed before the ledger is written")

    ctx = event_context(spark, folder, hooks=Hooks(write=write))
    with suppress(InterruptedError):
        in_batches(spark, sf_dir, ctx, F.pmod("event_id", F.lit(2)) * 2, 1)
    rest = event_records(read(spark, sf_dir, "events").where("event_id % 2 <> 0"))
    write_records(rest, ctx.record_path, topic_files(spark, sf_dir, "events"))
    run_ingest(ctx)
    stored_rows = tables.read_batches(spark, f"{folder}/errors", tables.read_formatted(ctx).schema)
    return stored_rows.select("event_id", "user_id", "value", "batch_id")


@query
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four record partitions, some offsets lost and some sent again."""
    ctx = event_context(spark, new_folder(spark, "offsets"))
    partition, offset = F.pmod("offset", F.lit(4)), F.expr("offset div 4")
    records = event_records(read(spark, sf_dir, "events"))
    records = records.withColumns({"partition": partition.cast("int"), "offset": offset})
    sent = F.col("offset") % 1000
    records = records.where(~sent.between(100, 119) & (sent != 777) | (F.col("partition") == 3))
    again = records.where((F.col("offset") % 500).between(40, 45) & (F.col("partition") < 2))
    records = records.unionByName(again).unionByName(again.where("offset % 500 = 42"))
    write_records(records, ctx.record_path, topic_files(spark, sf_dir, "events"))
    run_ingest(ctx)
    return offset_report(tables.read_archive(ctx), block=64)


@query
def checkpoint_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the events, all checkpoints lost, the rest among records sent again:
    every event once, in the log and in the archive."""
    folder = new_folder(spark, "reset")
    ctx = event_context(spark, folder)
    events = read(spark, sf_dir, "events")
    files = topic_files(spark, sf_dir, "events")
    write_records(event_records(events.where("event_id % 3 <> 1")), ctx.record_path, files)
    run_ingest(ctx)
    documents.remove(spark, ctx.state_path)
    write_records(event_records(events.where("event_id % 3 <> 0")), ctx.record_path, files)
    run_ingest(ctx)
    raw = tables.read_raw(ctx).select(F.col("event_id").cast("long").alias("event_id"), F.lit("archive").alias("place"))
    rows = tables.read_formatted(ctx).select("event_id", F.lit("log").alias("place"))
    return raw.unionByName(rows)


@query
def stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = event_context(spark, new_folder(spark, "drain"))
    files = topic_files(spark, sf_dir, "events")
    write_records(event_records(read(spark, sf_dir, "events")), ctx.record_path, files)
    run_ingest(ctx)
    return tables.read_formatted(ctx).select(*EVENT_FIELDS)


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the events, a run, the other half, two more runs: every event once."""
    ctx = event_context(spark, new_folder(spark, "restart"))
    events = read(spark, sf_dir, "events")
    files = topic_files(spark, sf_dir, "events")
    for half in (0, 1):
        part = events.where(F.col("event_id") % 2 == half)
        write_records(event_records(part), ctx.record_path, files)
        run_ingest(ctx)
    run_ingest(ctx)
    return tables.read_formatted(ctx).select(*EVENT_FIELDS, naive("timestamp"))


@query
def timeout_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is stopped for its time, and one that goes on: every event once."""
    folder = new_folder(spark, "timeout")
    hurried = event_context(spark, folder, file_limit=1, timeout=1.0)
    files = topic_files(spark, sf_dir, "events")
    write_records(event_records(read(spark, sf_dir, "events")), hurried.record_path, files)
    with suppress(DrainTimeout):
        run_ingest(hurried)
    ctx = event_context(spark, folder, file_limit=1)
    run_ingest(ctx)
    return tables.read_formatted(ctx).select(*EVENT_FIELDS, naive("timestamp"))


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later ids first, then the earlier ones: the published latest rows."""
    ctx = event_context(spark, new_folder(spark, "latest"), primary_keys="user_id")
    events = read(spark, sf_dir, "events")
    files = topic_files(spark, sf_dir, "events")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for part in (F.col("event_id") > middle, F.col("event_id") <= middle):
        write_records(event_records(events.where(part)), ctx.record_path, files)
        run_ingest(ctx)
    return tables.read_latest(ctx).select("user_id", "event_id", "ts", "current")


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken messages leave the stream as dead letters with their text."""
    ctx = event_context(spark, new_folder(spark, "rejects"))
    tail = F.when(F.col("event_id") % 97 == 0, F.lit("")).otherwise(F.lit("}"))
    message = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), "user_id",
        F.lit(',"event_type":"'), "event_type", F.lit('"'), tail,
    )
    files = topic_files(spark, sf_dir, "events")
    write_records(event_records(read(spark, sf_dir, "events"), message), ctx.record_path, files)
    run_ingest(ctx)
    return tables.read_rejects(ctx).select(naive("timestamp"), "value_raw", "reason")


@query
def stream_raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw archive of a streamed run, keys as text."""
    ctx = topic_context(
        spark, new_folder(spark, "archive"), "orders", ORDER, "o_custkey, o_orderkey"
    )
    records = envelope(
        read(spark, sf_dir, "orders"),
        ORDER.names,
        time=F.col("o_orderdate"),
        offset=F.col("o_orderkey"),
        topic="orders",
    )
    write_records(records, ctx.record_path, topic_files(spark, sf_dir, "orders"))
    run_ingest(ctx)
    raw = tables.read_raw(ctx)
    price = F.get_json_object("value_raw", "$.o_totalprice").cast("double")
    return raw.select(
        naive("timestamp"), "o_custkey", "o_orderkey", price.alias("o_totalprice")
    )


def batch_sizes(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """How many landing batches had so many rows, with one file in each."""
    ctx = event_context(spark, new_folder(spark, "rate"), file_limit=1)
    write_records(event_records(read(spark, sf_dir, "events")), ctx.record_path, files)
    batches = run_ingest(ctx).progress().where(F.col("query").endswith(".landing"))
    return batches.groupBy(F.col("input_rows").alias("n")).agg(F.count("*").alias("batches"))


@query
def rate_limited_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files, one in a batch."""
    return batch_sizes(spark, sf_dir, 4)


@query
def progress_many_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More batches than Spark retains reports of."""
    return batch_sizes(spark, sf_dir, 104)


@query
def multi_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "topics")
    topics = [
        ("events", EVENT, "event_id", F.col("ts")),
        ("orders", ORDER, "o_orderkey", F.col("o_orderdate")),
        ("customer", CUSTOMER, "c_custkey", F.timestamp_seconds("c_custkey")),
    ]
    contexts = []
    for topic, schema, key, time in topics:
        ctx = topic_context(spark, folder, topic, schema, key)
        records = envelope(
            read(spark, sf_dir, topic), schema.names, time=time, offset=F.col(key), topic=topic
        )
        write_records(records, ctx.record_path, topic_files(spark, sf_dir, topic))
        contexts.append(ctx)
    run_topics(contexts)
    counts = [
        tables.read_formatted(ctx).agg(F.count("*").alias("n")).select(
            F.lit(ctx.job["topic_name"]).alias("topic"), "n"
        )
        for ctx in contexts
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def topic_pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three declared topics and one that is not, landed by a single stream."""
    folder = new_folder(spark, "pattern")
    topics = [
        ("events", EVENT, "event_id", F.col("ts")),
        ("orders", ORDER, "o_orderkey", F.col("o_orderdate")),
        ("customer", CUSTOMER, "c_custkey", F.timestamp_seconds("c_custkey")),
        ("supplier", struct(s_suppkey=LONG), "s_suppkey", F.timestamp_seconds("s_suppkey")),
    ]
    contexts = []
    for topic, schema, key, time in topics:
        records = envelope(
            read(spark, sf_dir, topic), schema.names, time=time, offset=F.col(key), topic=topic
        )
        if topic == "customer":  # every 13th message is not what it should be
            broken = F.when(F.col("offset") % 13 == 0, F.lit("[]").cast("binary")).otherwise(F.col("value"))
            records = records.withColumn("value", broken)
        write_records(records, f"{folder}/records/all", topic_files(spark, sf_dir, topic))
        if topic != "supplier":
            contexts.append(topic_context(spark, folder, topic, schema, key))
    run_pattern(contexts, "everything", f"{folder}/records/all")
    label = lambda ctx: F.lit(ctx.topic_label).alias("topic")
    shared = [replace(ctx, shared="everything") for ctx in contexts]
    parts = [tables.read_formatted(ctx).select(label(ctx), F.lit("formatted").alias("place")) for ctx in shared]
    parts += [tables.read_rejects(ctx).select(label(ctx), F.col("reason").alias("place")) for ctx in shared]
    archive = spark.read.schema(tables.shared_schema([])).parquet(shared[0].raw_path)
    parts.append(archive.select("topic", F.concat(F.lit("archived "), "outcome").alias("place")))
    return reduce(DataFrame.union, parts).groupBy("topic", "place").agg(F.count("*").alias("n"))
