"""The two streaming stages of a topic.

``start_landing``: records are parsed once, sorted into outcomes and appended to
the raw archive, text and parsed message side by side, partitioned by outcome.
``start_formatting``: parsed messages of the archive go through the topic's transform
into the formatted table; the text is not read again.

Both are chains of narrow projections into an exactly-once file sink: no shuffle, no
sort, no state, no Python per row, and no watermark, which would drop old records when
a topic is first read from its beginning.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillstone.context import IngestContext
from rillstone.functions import names, schemas
from rillstone.functions.keys import lift
from rillstone.operators.parse import reduce_records, structured
from rillstone.operators.quality import Topic, classify, classify_topics
from rillstone.plans import recovery, tables
from rillstone.sources import records

# Files that a task writes side by side. With fewer partitions than that, the file
# writer does not sort its rows by partition first: there are at most so many outcomes,
# and one run number.
OPEN_FILES = 8
# A batch may be one file: its tasks read parts of it from this size on, by row groups. Spark's
# own least size is 4 MB, so that one core would parse most files while others wait.
PART_BYTES = 256 * 2**10
_counting, _running, _before = Lock(), [], []
_TOPIC = "__topic"


def ship_hook_code(ctx: IngestContext) -> None:
    """Send the archive with the hooks' modules to the executors, if one is named."""
    archive = ctx.generic.get("installed_py_files_archive_name", "").strip()
    if archive:
        place = ctx.generic.get("installed_py_files_server_location", "").strip()
        ctx.spark.sparkContext.addPyFile(place + archive)


def open_records(ctx: IngestContext) -> DataFrame:
    """The topic's record stream, limited per batch as configured."""
    if ctx.record_path is None:
        positions = recovery.starting_positions(ctx)
        options = records.kafka_options(ctx.cluster, ctx.job, ctx.records_per_task, positions)
        stream = records.kafka_stream(ctx.spark, options)
    else:
        stream = records.file_stream(ctx.spark, ctx.record_path, ctx.file_limit, ctx.record_file_age)
    return recovery.not_stored(ctx, stream)


def landing_rows(ctx: IngestContext, record_rows: DataFrame) -> DataFrame:
    """Raw archive rows of Kafka-shaped records."""
    return archived(ctx, reduce_records(record_rows))


def archived(ctx: IngestContext, texts: DataFrame) -> DataFrame:
    """Raw archive rows of message texts."""
    if ctx.dead_letters:
        # what another transform makes of a message is not known here
        target = ctx.target_schema if ctx.default_transform else None
        parsed = classify(texts, ctx.source_schema, ctx.keys, target)
    else:
        parsed = structured(texts, ctx.source_schema, ctx.keys).withColumn(
            names.OUTCOME, F.lit(names.ACCEPTED)
        )
    good = F.when(F.col(names.OUTCOME) == names.ACCEPTED, F.col(names.VALUE))
    return tables.conform(parsed.withColumn(names.VALUE, good), tables.raw_schema(ctx))


def formatted_rows(ctx: IngestContext, archive: DataFrame) -> DataFrame:
    """Accepted archive rows, transformed."""
    kept = archive.where(F.col(names.OUTCOME) == names.ACCEPTED)
    held = archive.schema[names.VALUE].dataType
    value = schemas.shaped(F.col(names.VALUE), held, ctx.source_schema).alias(names.VALUE)
    rows = kept.select(names.TIMESTAMP, value, names.VALUE_RAW, *names.POSITION)
    rows = rows.select(
        names.TIMESTAMP, names.VALUE, names.VALUE_RAW, *lift(ctx.keys), *names.POSITION
    )
    return ctx.hooks.transform(ctx, rows)


def start_landing(ctx: IngestContext) -> StreamingQuery:
    rows = landing_rows(ctx, open_records(ctx))
    sink = _sink(ctx, rows, "landing").partitionBy(names.OUTCOME)
    return sink.outputMode("append").start(ctx.raw_path)


def topic_rows(contexts: list[IngestContext], record_rows: DataFrame) -> DataFrame:
    """Rows of the archive that several topics share, of records of any topic."""
    texts = reduce_records(record_rows.withColumnRenamed(names.TOPIC, _TOPIC), (_TOPIC,))
    declared = [
        Topic(
            ctx.job["kafka_topic_name"], ctx.topic_label, ctx.source_schema, ctx.keys,
            ctx.target_schema if ctx.default_transform else None,
        )
        for ctx in contexts
    ]
    rows = classify_topics(texts.withColumnRenamed(_TOPIC, names.TOPIC), declared)
    good = F.col(names.OUTCOME) == names.ACCEPTED
    values = {t.column: F.when(good, F.col(f"`{t.column}`")) for t in declared}
    # one name for the partition and the table: in lower case, without dots
    label = F.replace(F.lower(names.TOPIC), F.lit("."), F.lit("_"))
    for t in declared:
        label = F.when(F.col(names.TOPIC) == t.name, F.lit(t.column)).otherwise(label)
    schema = tables.shared_schema([(t.column, tables.archived_type(ctx)) for t, ctx in zip(declared, contexts)])
    return tables.conform(rows.withColumns({**values, names.TOPIC: label}), schema)


def start_shared_landing(contexts: list[IngestContext], record_rows: DataFrame) -> StreamingQuery:
    """One stream of all topics' records into their archive, by topic and outcome."""
    first = contexts[0]
    return (
        topic_rows(contexts, record_rows)
        .writeStream.format(first.table_format)
        .queryName(f"{first.shared}.landing")
        .option("checkpointLocation", first.checkpoint("landing"))
        .trigger(availableNow=True)
        .partitionBy(names.TOPIC, names.OUTCOME)
        .outputMode("append")
        .start(first.raw_path)
    )


def start_formatting(ctx: IngestContext) -> StreamingQuery:
    reader = ctx.spark.readStream.format(ctx.table_format).option(
        "maxBytesPerTrigger", ctx.formatting_batch_bytes
    )
    if ctx.table_format == "parquet":
        reader = reader.schema(tables.archive_schema(ctx))
    rows = formatted_rows(ctx, tables.own_rows(ctx, reader.load(ctx.raw_path)))
    if tables.hook_in_stream(ctx):
        sink = _sink(ctx, rows, "formatting").outputMode("update")
        return sink.foreachBatch(partial(ctx.hooks.write, ctx)).start()
    numbered = rows.withColumn(names.RUN_ID, F.lit(tables.open_run(ctx)))
    shaped = tables.conform(numbered, tables.stored_schema(ctx))
    sink = _sink(ctx, shaped, "formatting").partitionBy(names.RUN_ID)
    return sink.outputMode("append").start(ctx.table_path)


@contextmanager
def files_side_by_side(spark: SparkSession) -> Iterator[None]:
    """While in here, tasks of file sinks keep a file open for each partition, and a file's parts
    are read side by side.

    Streams read the settings of the session; they are set back when the last run that
    needs them ends.
    """
    settings = {
        "spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES,
        "spark.sql.files.openCostInBytes": PART_BYTES,
    }
    with _counting:
        if not _running:
            _before.append({setting: spark.conf.get(setting, None) for setting in settings})
            for setting, value in settings.items():
                spark.conf.set(setting, value)
        _running.append(spark)
    try:
        yield
    finally:
        with _counting:
            _running.pop()
            if not _running:
                for setting, before in _before.pop().items():
                    if before is None:
                        spark.conf.unset(setting)
                    else:
                        spark.conf.set(setting, before)


def _sink(ctx: IngestContext, rows: DataFrame, stage: str) -> DataStreamWriter:
    return (
        rows.writeStream.format(ctx.table_format)
        .queryName(f"{ctx.resource_name}.{stage}" + (f".{ctx.epoch}" if ctx.epoch else ""))
        .option("checkpointLocation", ctx.checkpoint(stage))
        .trigger(availableNow=True)
    )
