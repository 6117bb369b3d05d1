"""Kafka-shaped records: the Kafka source, its file stand-in, and envelopes."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of Spark's Kafka source.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# to_json cuts to milliseconds unless told otherwise.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Fixed value: what Kafka's option takes as the earliest offset of a partition.
EARLIEST = -2


def consumer_options(
    cluster: Mapping[str, Any], job: Mapping[str, Any], positions: Mapping[str, int] | None = None
) -> dict[str, str]:
    """Topic, starting point, rate limit and group of the Kafka consumer.

    ``kafka_topic_pattern`` subscribes to every topic that it matches, instead of one. With
    ``positions``, partitions go on there. Kafka wants all partitions named: those
    below ``kafka_partitions`` that have no position start from the earliest.
    """
    # Option names of Spark's Kafka source.
    options = {
        "kafka.bootstrap.servers": cluster["bootstrap_servers"],
        "subscribe": job["kafka_topic_name"],
        "startingOffsets": "earliest",
        "kafka.group.id": cluster["consumer_group_id"],
    }
    if job.get("kafka_topic_pattern"):
        del options["subscribe"]
        options["subscribePattern"] = job["kafka_topic_pattern"]
    if positions:
        known = {str(number): EARLIEST for number in range(int(job.get("kafka_partitions", 0)))}
        starts = {job["kafka_topic_name"]: {**known, **positions}}
        options["startingOffsets"] = json.dumps(starts, sort_keys=True)
    if job.get("max_offsets_per_trigger") is not None:
        options["maxOffsetsPerTrigger"] = str(job["max_offsets_per_trigger"])
    return options


def credential_options(cluster: Mapping[str, Any]) -> dict[str, str]:
    """SASL/PLAIN over TLS. Host names stay verified (Kafka's default)."""

    def quoted(text: str) -> str:
        return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

    login = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f"username={quoted(cluster['sasl_plain_user'])} "
        f"password={quoted(cluster['sasl_plain_password'])};"
    )
    # Option names and security settings of the Kafka client.
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": login,
        "kafka.ssl.truststore.location": cluster["trust_store_location"],
        "kafka.ssl.truststore.password": cluster["trust_store_password"],
        "kafka.ssl.enabled.protocols": "TLSv1.2",
    }


# One Kafka partition may hold much of the topic; this bounds what one task reads.
RECORDS_PER_TASK = 1_000_000


def kafka_options(
    cluster: Mapping[str, Any],
    job: Mapping[str, Any],
    records_per_task: int = RECORDS_PER_TASK,
    positions: Mapping[str, int] | None = None,
) -> dict[str, str]:
    return {
        **consumer_options(cluster, job, positions),
        **credential_options(cluster),
        "maxRecordsPerPartition": str(records_per_task),
    }


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None, file_age: str = "36500d"
) -> DataFrame:
    """Stream of record files, read from the earliest on the first run.

    Files older than the newest one seen by more than ``file_age`` are forgotten, and
    skipped if they were never read; by default that is never, and the driver
    remembers every file. A topic whose files arrive in order of time can do with less.
    """
    reader = spark.readStream.schema(RECORD_SCHEMA).option("maxFileAge", file_age)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def envelope(
    table: DataFrame,
    payload: Sequence[str | Column] | Column,
    *,
    time: Column,
    offset: Column,
    topic: str,
) -> DataFrame:
    """Turn table rows into Kafka-shaped records.

    ``payload`` is the list of message fields, or a finished message string.
    """
    if isinstance(payload, Column):
        message = payload
    else:
        message = F.to_json(F.struct(*payload), MICROSECONDS)
    return table.select(
        F.lit(None).cast("binary").alias("key"),
        message.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        time.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
