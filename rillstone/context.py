"""What one ingest run knows: configuration, schemas, keys, names, hooks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rillstone.functions import schemas
from rillstone.functions.keys import KeyColumn, check_keys, split_keys
from rillstone.operators.parse import flatten
from rillstone.sources import documents


def default_transform(ctx: IngestContext, rows: DataFrame) -> DataFrame:
    """One column per message field."""
    return flatten(rows)


@dataclass(frozen=True)
class Hooks:
    """User code of one topic, on whole DataFrames.

    ``transform(ctx, rows)`` shapes accepted rows for the formatted table.
    ``write(ctx, batch, batch_id)`` gets the rows of each run in the table's shape, after
    they are appended; on Delta it replaces the append and gets each micro-batch. It may be
    called twice with the same rows, so it has to be idempotent per ``batch_id``.
    """

    transform: Callable[[IngestContext, DataFrame], DataFrame] = default_transform
    write: Callable[[IngestContext, DataFrame, int], None] | None = None


HookRegistry = Mapping[tuple[str, str], Hooks]


def normal_topic(topic_name: str) -> str:
    """Topic name as used in table and hook names."""
    return topic_name.lower().replace(".", "_")


def find_hooks(registry: HookRegistry, job: Mapping[str, Any]) -> Hooks:
    """Hooks registered for ``(source, topic)``; the defaults when there are none."""
    return registry.get((job["source"], normal_topic(job["topic_name"])), Hooks())


@dataclass(frozen=True)
class IngestContext:
    spark: SparkSession = field(repr=False)
    job: Mapping[str, Any]
    generic: Mapping[str, Any]
    # Holds credentials: kept out of repr and of every log line.
    cluster: Mapping[str, Any] = field(repr=False)
    topic: Mapping[str, Any]
    source_schema: T.StructType = field(repr=False)
    target_schema: T.StructType = field(repr=False)
    hooks: Hooks = Hooks()
    # None reads Kafka; a path reads Kafka-shaped Parquet files.
    record_path: str | None = None
    table_format: str = "parquet"
    # False makes one bad message fail the run instead of becoming a reject.
    dead_letters: bool = True
    # New rows, as a share of the snapshot's bytes, that make a new snapshot worth it. None
    # writes none: for topics of ever new keys, whose snapshot would be the table again.
    publish_share: float | None = 0.25
    # Buckets by key of the snapshot and the history. A run rewrites those that its keys fall
    # into, each by one task; some hundred megabytes are a good size for one.
    buckets: int = 16
    # True keeps the history beside the snapshot: its intervals are stored, and only those of
    # keys with new rows are settled again. None is stored where no snapshot is.
    store_history: bool = False
    # False registers no tables. For the time of a rewrite the old buckets are in the
    # catalog's current database all the same.
    register_tables: bool = True
    # True formats the archive anew when a key is declared that the table does not hold.
    refill: bool = False
    # Bytes of archive in one formatting batch: a long backlog is worked off in pieces.
    formatting_batch_bytes: int = 2**40
    # One Kafka partition may hold much of the topic; this bounds what one task reads.
    records_per_task: int = 1_000_000
    # How much older than the newest one a record file may be and still be read.
    record_file_age: str = "36500d"
    # Name of the archive that several topics land in by one stream; None: one of its own.
    shared: str | None = None
    # Times that the topic began anew after it lost a checkpoint; found by each run.
    epoch: int = 0

    def __post_init__(self) -> None:
        check_keys(self.keys, self.source_schema)

    @property
    def keys(self) -> list[KeyColumn]:
        return split_keys(self.topic["primary_keys"])

    @property
    def file_limit(self) -> int | None:
        """Record files in a batch; Kafka's limit, in records, is another setting."""
        limit = self.job.get("max_files_per_trigger")
        return None if limit is None else int(limit)

    @property
    def default_transform(self) -> bool:
        return self.hooks.transform is default_transform

    @property
    def timeout_seconds(self) -> float | None:
        return self.generic.get("query_poll_timeout_seconds")

    # names and places -------------------------------------------------------

    @property
    def resource_name(self) -> str:
        return f"{self.cluster['resource_name_prefix']}_{normal_topic(self.job['topic_name'])}"

    @property
    def table_name(self) -> str:
        return f"{self.generic['formatted_table_catalog']}.{self.resource_name}"

    def at(self, epoch: int) -> IngestContext:
        """The same topic in another epoch."""
        return replace(self, epoch=epoch)

    @property
    def _of_epoch(self) -> str:
        return f".{self.epoch}" if self.epoch else ""

    @property
    def _base_path(self) -> str:
        return f"{self.generic['formatted_table_prefix']}/{self.resource_name}"

    @property
    def table_path(self) -> str:
        return self._base_path + (self._of_epoch if self.table_format == "parquet" else "")

    @property
    def raw_table_name(self) -> str:
        return f"{self.table_name}_src"

    @property
    def raw_path(self) -> str:
        if self.shared is not None:
            return f"{self.generic['formatted_table_prefix']}/{self.shared}_src"
        return f"{self._base_path}_src" + (self._of_epoch if self.table_format == "parquet" else "")

    @property
    def shared_table_name(self) -> str:
        return f"{self.generic['formatted_table_catalog']}.{self.shared}_src"

    @property
    def topic_label(self) -> str:
        """The topic's name among others: its partition and its column of a shared archive."""
        return normal_topic(self.job["topic_name"])

    @property
    def latest_table_name(self) -> str:
        return f"{self.table_name}_latest"

    def snapshot_table_name(self, run: int) -> str:
        return f"{self.table_name}_snapshot_{run}"

    @property
    def snapshot_path(self) -> str:
        return f"{self._base_path}_snapshot"

    @property
    def history_path(self) -> str:
        return f"{self._base_path}_history"

    @property
    def redriven_path(self) -> str:
        return f"{self._base_path}_redriven"

    @property
    def redriven_document(self) -> str:
        """The run that the rows of each redrive belong to."""
        return f"{self.state_path}.redriven.json"

    @property
    def compacted_path(self) -> str:
        return f"{self._base_path}_compacted"

    @property
    def compacted_document(self) -> str:
        """Up to which run the log is rewritten by key, and in how many parts."""
        return f"{self.state_path}.compacted.json"

    @property
    def state_path(self) -> str:
        prefix = self.generic["formatted_checkpoint_prefix"]
        return f"{prefix}/{self.job['source']}/{self.job['topic_name']}"

    def checkpoint(self, stage: str) -> str:
        if self.shared is not None and stage == "landing":
            return f"{self.generic['formatted_checkpoint_prefix']}/{self.shared}/{stage}"
        return f"{self.state_path}/{stage}{self._of_epoch}"

    @property
    def saved_schema_path(self) -> str:
        """Last declared target schema that was applied."""
        return f"{self.state_path}.target_schema.json"

    @property
    def published_path(self) -> str:
        """The last published run, its keys, and where their buckets lie."""
        return f"{self.state_path}.published.json"

    @property
    def delivered_path(self) -> str:
        """The runs that the ``write`` hook has been given."""
        return f"{self.state_path}.delivered.json"

    @property
    def table_schema_path(self) -> str:
        """Columns of the formatted table, including ones no longer declared."""
        return f"{self.state_path}.table_schema.json"

    @property
    def layout_path(self) -> str:
        """Messages as archived, lifted key columns, and the keys in force."""
        return f"{self.state_path}.layout.json"

    @property
    def epoch_path(self) -> str:
        """The present epoch, if it is not the first."""
        return f"{self.state_path}.epoch.json"

    @property
    def stored_path(self) -> str:
        """Ranges of offsets that were stored when the epoch began."""
        return f"{self.state_path}.stored/{self.epoch}"

    @property
    def progress_path(self) -> str:
        return f"{self.state_path}.progress"


def config_root(generic: Mapping[str, Any]) -> str:
    """Folder of the topic documents: a path as it stands, or a prefix in a bucket."""
    prefix = generic["s3_config_prefix"].rstrip("/")
    if prefix.startswith("/") or "://" in prefix or "s3_config_bucket" not in generic:
        return prefix
    return f"s3a://{generic['s3_config_bucket']}/{prefix}"


def load_context(
    spark: SparkSession,
    job: Mapping[str, Any],
    generic: Mapping[str, Any] | str,
    cluster: Mapping[str, Any] | str,
    registry: HookRegistry | None = None,
    **options: Any,
) -> IngestContext:
    """Build a context from its documents; ``generic`` and ``cluster`` may be paths."""
    if isinstance(generic, str):
        generic = documents.read_json(spark, generic)
    if isinstance(cluster, str):
        cluster = documents.read_json(spark, cluster)
    root = config_root(generic)
    folder = f"{root}/{job['source']}/{job['topic_name']}"
    topic = documents.read_json(spark, f"{folder}/config.json")
    source_schema = load_schema(spark, f"{folder}/schema.json", root)
    target_schema = source_schema
    if topic.get("has_target_schema"):
        target_schema = load_schema(spark, f"{folder}/target_schema.json", root)
    return IngestContext(
        spark=spark,
        job=job,
        generic=generic,
        cluster=cluster,
        topic=topic,
        source_schema=source_schema,
        target_schema=target_schema,
        hooks=find_hooks(registry or {}, job),
        **options,
    )


def load_schema(spark: SparkSession, path: str, root: str) -> T.StructType:
    """A declared schema: Spark's JSON form, or an Avro record with placeholders."""
    document = documents.read_json(spark, path)
    if document.get("type") != "record":
        return schemas.from_document(document)
    template = documents.read_json_if_present(spark, f"{root}/workflow/ref_type.json")
    if template is not None:
        document = schemas.expand_refs(document, template)
    return schemas.from_avro(spark, document)
