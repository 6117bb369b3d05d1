"""Several topics landed by one stream."""

import dataclasses

import pytest
from pyspark.sql import types as T
from test_buckets import rows_of
from test_ingest import SCHEMA, START, context, message, physical

from rillstone.plans import tables
from rillstone.plans.ingest import run_pattern
from rillstone.plans.recovery import LostCheckpoint
from rillstone.sources import documents, records
from rillstone.sources.records import RECORD_SCHEMA
from rillstone.streaming.stages import topic_rows

OTHER = T.StructType([T.StructField("id", T.LongType()), T.StructField("w", T.DoubleType())])


def topics(spark, folder, **options):
    one = context(spark, folder, topic="One.A", **options)
    two = context(spark, folder, topic="two", schema=OTHER, **options)
    return [one, two]


def post(spark, folder, *sent, offset=0):
    rows = [
        (None, bytearray(text.encode()), topic, 0, offset + n, START, 0) for n, (topic, text) in enumerate(sent)
    ]
    spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/all")


def shared(contexts):
    return [dataclasses.replace(ctx, shared="both") for ctx in contexts]


def test_topics_land_together_and_go_on_apart(spark, tmp_path):
    contexts = topics(spark, tmp_path)
    post(spark, tmp_path, ("One.A", message(1)), ("two", '{"id":1,"w":2}'), ("two", '{"id":2,"w":"x"}'), ("three", "{}"), ("One.A", "{}"))
    first = run_pattern(contexts, "both", f"{tmp_path}/all")
    post(spark, tmp_path, ("two", '{"id":1,"w":3}'), ("One.A", message(7)), offset=10)
    run_pattern(contexts, "both", f"{tmp_path}/all")
    run_pattern(contexts, "both", f"{tmp_path}/all")
    one, two = shared(contexts)
    assert [run.provisioned.action for run in first] == ["created", "created"]
    assert rows_of(tables.read_formatted(one), "id", "n") == [(1, "x"), (7, "x")]
    assert rows_of(tables.read_formatted(two), "id", "w") == [(1, 2.0), (1, 3.0)]
    assert rows_of(tables.read_latest(two), "id", "w") == [(1, 3.0)]
    assert rows_of(tables.read_rejects(one), "value_raw", "reason") == [("{}", "missing_required")]
    assert rows_of(tables.read_rejects(two), "reason") == [("malformed",)]
    assert rows_of(tables.read_raw(two), "id", "value_raw") == [("1", '{"id":1,"w":2}'), ("1", '{"id":1,"w":3}')]
    archive = spark.read.schema(tables.shared_schema([])).parquet(one.raw_path)
    assert rows_of(archive.where("topic = 'three'"), "outcome", "value_raw") == [("undeclared_topic", "{}")]


def test_a_declaration_grows(spark, tmp_path):
    contexts = topics(spark, tmp_path)
    post(spark, tmp_path, ("two", '{"id":1,"w":2}'))
    run_pattern(contexts, "both", f"{tmp_path}/all")
    wider = T.StructType([*OTHER.fields, T.StructField("z", T.StringType())])
    contexts[1] = context(spark, tmp_path, topic="two", schema=wider)
    post(spark, tmp_path, ("two", '{"id":2,"z":"new"}'), offset=5)
    run_pattern(contexts, "both", f"{tmp_path}/all")
    assert rows_of(tables.read_formatted(shared(contexts)[1]), "id", "w", "z") == [(1, 2.0, None), (2, None, "new")]


def test_one_parse_each_and_no_exchange(spark, tmp_path):
    contexts = shared(topics(spark, tmp_path))
    post(spark, tmp_path, ("One.A", message(1)))
    rows = topic_rows(contexts, spark.read.schema(RECORD_SCHEMA).parquet(f"{tmp_path}/all"))
    plan = physical(rows)
    assert plan.count("from_json(") == 2 and "Exchange" not in plan and "Sort" not in plan


def test_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS demo")
    contexts = topics(spark, tmp_path, register_tables=True)
    for number in range(2):
        post(spark, tmp_path, ("One.A", message(number)), ("two", '{"id":1,"w":2}'), offset=10 * number)
        run_pattern(contexts, "both", f"{tmp_path}/all")
        for ctx in contexts:
            assert spark.table(ctx.table_name).count() == spark.table(ctx.raw_table_name).count() == number + 1
    assert spark.table("demo.both_src").count() == 4
    assert spark.table(contexts[0].raw_table_name).columns[:3] == ["timestamp", "id", "value_raw"]


def test_refused(spark, tmp_path):
    one, two = topics(spark, tmp_path)
    with pytest.raises(ValueError, match="share"):
        run_pattern([one, one], "both", f"{tmp_path}/all")
    post(spark, tmp_path, ("two", '{"id":1}'))
    run_pattern([one, two], "both", f"{tmp_path}/all")
    documents.remove(spark, shared([one])[0].checkpoint("landing"))
    with pytest.raises(LostCheckpoint):
        run_pattern([one, two], "both", f"{tmp_path}/all")


def test_pattern_of_kafka_topics():
    cluster = {"bootstrap_servers": "b:1", "consumer_group_id": "g"}
    options = records.consumer_options(cluster, {"kafka_topic_name": "t", "kafka_topic_pattern": "t-.*"})
    assert options["subscribePattern"] == "t-.*" and "subscribe" not in options
    assert SCHEMA.names == ["id", "n"]
