"""Consumer options, documents on Hadoop paths, scratch folders."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from rillstone.sources import documents, records
from rillstone.workspace import new_folder

CLUSTER = {
    "bootstrap_servers": "host:9093",
    "group_id_prefix": "demo",
    "consumer_group_id": "demo-1",
    "trust_store_location": "/x/ts.jks",
    "trust_store_password": "secret1",
    "sasl_plain_user": "u",
    "sasl_plain_password": 'p"q\\r',
    "resource_name_prefix": "demo",
}
JOB = {"kafka_topic_name": "demo.Events", "max_offsets_per_trigger": 1000}


def test_consumer_options():
    assert records.consumer_options(CLUSTER, JOB) == {
        "kafka.bootstrap.servers": "host:9093",
        "subscribe": "demo.Events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "kafka.group.id": "demo-1",
    }


def test_credential_options():
    assert "maxRecordsPerPartition" in records.kafka_options(CLUSTER, JOB)
    options = records.kafka_options(CLUSTER, JOB)
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.ssl.enabled.protocols"] == "TLSv1.2"
    assert options["kafka.ssl.truststore.location"] == "/x/ts.jks"
    assert options["kafka.ssl.truststore.password"] == "secret1"
    assert options["kafka.sasl.jaas.config"].endswith(
        'PlainLoginModule required username="u" password="p\\"q\\\\r";'
    )
    # Host names stay verified.
    assert "kafka.ssl.endpoint.identification.algorithm" not in options
    assert all(isinstance(value, str) for value in options.values())


def test_envelope_has_the_kafka_columns(spark):
    table = spark.range(3).withColumn("ts", F.timestamp_seconds("id"))
    found = records.envelope(
        table, ["id"], time=F.col("ts"), offset=F.col("id"), topic="t"
    )
    assert [(f.name, f.dataType) for f in found.schema] == [
        (f.name, f.dataType) for f in records.RECORD_SCHEMA
    ]
    assert [bytes(r.value) for r in found.orderBy("offset").collect()][2] == b'{"id":2}'


def test_documents(spark, tmp_path):
    path = f"{tmp_path}/a/b/doc.json"
    assert documents.read_json_if_present(spark, path) is None
    documents.write_json(spark, path, {"x": "ä"})
    documents.write_json(spark, path, {"x": "ö"})
    assert documents.read_json(spark, path) == {"x": "ö"}
    assert documents.size(spark, f"{tmp_path}/a") > 0
    assert sorted(p.name for p in (tmp_path / "a" / "b").iterdir() if p.suffix != ".crc") == [
        "doc.json"
    ]


def test_missing_and_damaged_documents_raise(spark, tmp_path):
    with pytest.raises(Py4JJavaError, match="FileNotFound"):
        documents.read_json(spark, f"{tmp_path}/none.json")
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(json.JSONDecodeError):
        documents.read_json_if_present(spark, f"{tmp_path}/bad.json")


def test_scratch_folders_are_below_the_shared_one(spark):
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
