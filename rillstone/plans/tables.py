"""The tables of a topic: shapes, provisioning, reading, batch writing.

Every topic has a raw archive ``<name>_src`` and a formatted table ``<name>``, both
append-only. The archive holds each message as it came and, if it was accepted, parsed.
Rejected messages are partitions of the raw archive. Appended files
cannot be updated, so the formatted table's ``current`` column stays NULL on disk
and ``read_history`` resolves it.

Beside it lies a snapshot of the latest row of every key, and, where it is asked for, the
history: every version with its interval. Both are parted into buckets by key. The formatted
table is partitioned by run number, so that the next snapshot needs the rows since the last
one and the buckets of their keys, not the whole log; of the history only the versions of
these keys are settled anew, so that a late row splits the interval it falls into. Buckets are
written once the new rows amount to a share of them: keys that are mostly new would else
rewrite everything in every run. Readers merge the buckets with the rows since.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.context import IngestContext
from rillstone.functions import names, schemas
from rillstone.functions.keys import field, key_names, key_type
from rillstone.operators.versions import history, latest, merge_latest
from rillstone.plans import buckets
from rillstone.sources import documents

_POSITION_FIELDS = [
    T.StructField(names.RECORD_PARTITION, T.IntegerType()),
    T.StructField(names.RECORD_OFFSET, T.LongType()),
]


# ---------------------------------------------------------------------- shapes


def formatted_schema(
    ctx: IngestContext, target: T.StructType, lifted: T.StructType | None = None
) -> T.StructType:
    """Extended target, key columns that are not target fields, position, run.

    ``lifted`` are key columns of earlier declarations, which stay.
    """
    extended = schemas.extend_target(target)
    columns = schemas.merge(lifted or T.StructType([]), lifted_keys(ctx))
    beside = [f for name, f in schemas.by_name(columns).items() if name not in schemas.by_name(target)]
    run = T.StructField(names.RUN_ID, T.LongType())
    return T.StructType([*extended.fields, *beside, *_POSITION_FIELDS, run])


def lifted_keys(ctx: IngestContext) -> T.StructType:
    """The declared key columns, typed as in the messages."""
    return T.StructType(
        [T.StructField(key.name, key_type(ctx.source_schema, key.path)) for key in ctx.keys]
    )


def raw_schema(ctx: IngestContext) -> T.StructType:
    """Record time, keys as strings, message as text and parsed; position and outcome."""
    return T.StructType(
        [
            T.StructField(names.TIMESTAMP, T.TimestampType()),
            *[T.StructField(name, T.StringType()) for name in key_names(ctx.keys)],
            T.StructField(names.VALUE_RAW, T.StringType()),
            T.StructField(names.VALUE, _layout(ctx).source),
            *_POSITION_FIELDS,
            T.StructField(names.OUTCOME, T.StringType()),
        ]
    )


def archive_schema(ctx: IngestContext) -> T.StructType:
    """What is read of the archive's files: of a shared one, the topic's own column."""
    if ctx.shared is None:
        return raw_schema(ctx)
    return shared_schema([(ctx.topic_label, _layout(ctx).source)])


def shared_schema(values: list[tuple[str, T.StructType]]) -> T.StructType:
    """An archive of several topics: one column of parsed messages for each."""
    return T.StructType(
        [
            T.StructField(names.TIMESTAMP, T.TimestampType()),
            T.StructField(names.VALUE_RAW, T.StringType()),
            *[T.StructField(column, kind) for column, kind in values],
            *_POSITION_FIELDS,
            T.StructField(names.TOPIC, T.StringType()),
            T.StructField(names.OUTCOME, T.StringType()),
        ]
    )


def archived_type(ctx: IngestContext) -> T.StructType:
    """Messages as archived, with fields no longer declared."""
    return _layout(ctx).source


def own_rows(ctx: IngestContext, files: DataFrame) -> DataFrame:
    """The topic's rows of an archive's files, in the shape of an archive of its own."""
    if ctx.shared is None:
        return files
    rows = files.where(F.col(names.TOPIC) == ctx.topic_label)
    rows = rows.withColumnRenamed(ctx.topic_label, names.VALUE)
    keys = [F.lit(None).cast("string").alias(name) for name in key_names(ctx.keys)]
    return rows.select("*", *keys).select(*raw_schema(ctx).names)


class Layout(NamedTuple):
    """What was applied to the tables beside the target."""

    source: T.StructType  # messages as archived, with fields no longer declared
    lifted: T.StructType  # key columns, with those of earlier declarations
    keys: list[str]
    refilling: bool  # the formatted table is being filled anew


def _layout(ctx: IngestContext) -> Layout:
    found = documents.read_json_if_present(ctx.spark, ctx.layout_path)
    if found is None:
        return Layout(ctx.source_schema, T.StructType([]), [], False)
    source, lifted = (T.StructType.fromJson(found[part]) for part in ("source", "lifted"))
    return Layout(source, lifted, found["keys"], found["refilling"])


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the table's columns in its types; absent nullable ones are NULL.

    Fields inside columns meet by name. What cannot be converted becomes NULL; landing has
    set such messages aside.
    """
    present = schemas.by_name(rows.schema)
    missing = [f.name for f in schema.fields if f.name.lower() not in present and not f.nullable]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    columns = []
    for f in schema.fields:
        own = present.get(f.name.lower())
        if own is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            columns.append(schemas.shaped(F.col(f"`{own.name}`"), own.dataType, f.dataType).alias(f.name))
    return rows.select(*columns)


# --------------------------------------------------------------------- epochs


def epochs(ctx: IngestContext) -> list[IngestContext]:
    """The topic in every epoch that it has folders of, the present one last."""
    found = documents.read_json_if_present(ctx.spark, ctx.epoch_path)
    last = 0 if found is None else found["epoch"]
    return [ctx.at(epoch) for epoch in range(last + 1)] if ctx.table_format == "parquet" else [ctx.at(last)]


def write_epoch(ctx: IngestContext) -> None:
    documents.write_json(ctx.spark, ctx.epoch_path, {"epoch": ctx.epoch})


# ---------------------------------------------------------------- provisioning


class Provisioned(NamedTuple):
    action: str  # created, evolved or unchanged
    changes: list[schemas.Change]


def provision(ctx: IngestContext) -> Provisioned:
    """Create the tables, or let them follow their declared schemas and keys.

    Everything is compared before anything is written: the target, the messages, key
    columns with their types, and the keys. A refused change leaves the tables as they
    are. What was applied is saved last, so that a failed attempt is repeated by the next
    run. A saved document that exists but cannot be read raises.
    """
    spark = ctx.spark
    exists = table_exists(ctx)
    saved = read_saved_schema(ctx) if exists else None
    before = _layout(ctx) if exists else Layout(ctx.source_schema, T.StructType([]), [], False)
    after = _next_layout(ctx, before)
    previous = documents.read_json_if_present(spark, ctx.table_schema_path) if exists else None
    known = None if previous is None else T.StructType.fromJson(previous)

    changes = [] if saved is None else schemas.diff(saved, ctx.target_schema)
    schemas.require_compatible(changes)
    table = ctx.target_schema
    if known is not None:
        # A column dropped earlier may come back, but not with another type.
        schemas.require_compatible(schemas.diff(known, ctx.target_schema))
        table = schemas.merge(known, ctx.target_schema)
    _require_lifted(after.lifted, table, known)
    # Field by field, so that what cannot be converted is known before a message comes.
    if ctx.default_transform:
        schemas.loses(F.lit(None), ctx.source_schema, ctx.target_schema)
    refill = before.refilling or _needs_refill(ctx, before, known)

    if saved == ctx.target_schema and after == before:
        if ctx.register_tables and not _registered(ctx):
            register(ctx, stored_schema(ctx))
        return Provisioned("unchanged", [])
    if refill:
        _write_layout(ctx, before._replace(refilling=True))
        for each in epochs(ctx):
            documents.remove(spark, each.table_path)
            documents.remove(spark, each.checkpoint("formatting"))
        for path in (
            ctx.snapshot_path, ctx.history_path, ctx.published_path, ctx.redriven_document, ctx.redriven_path,
            ctx.compacted_document, ctx.compacted_path,
        ):
            documents.remove(spark, path)

    wanted = formatted_schema(ctx, table, after.lifted)
    if ctx.table_format != "parquet":
        partition = None if getattr(ctx.hooks.write, "one_row_per_key", False) else names.RUN_ID
        _append_nothing(ctx, wanted, ctx.table_path, partition)
        if not _is_table(ctx, ctx.raw_path):
            _append_nothing(ctx, raw_schema(ctx), ctx.raw_path, names.OUTCOME)
    else:
        for each in epochs(ctx):
            documents.make_directory(spark, each.table_path)
            documents.make_directory(spark, each.raw_path)
    documents.write_json(spark, ctx.table_schema_path, table.jsonValue())
    _write_layout(ctx, after)
    if ctx.register_tables:
        register(ctx, wanted)
    documents.write_json(spark, ctx.saved_schema_path, ctx.target_schema.jsonValue())
    return Provisioned("evolved" if exists else "created", changes)


def _next_layout(ctx: IngestContext, before: Layout) -> Layout:
    """What the layout becomes; refuses messages that the archive could not hold."""
    schemas.require_compatible(schemas.diff(before.source, ctx.source_schema))
    keys = lifted_keys(ctx)
    schemas.require_compatible(schemas.diff(before.lifted, keys))
    source = schemas.merge(before.source, ctx.source_schema)
    return Layout(source, schemas.merge(before.lifted, keys), key_names(ctx.keys), False)


def _require_lifted(lifted: T.StructType, table: T.StructType, known: T.StructType | None) -> None:
    """Refuse a target field that would take the place of a key column of another type."""
    fields = schemas.by_name(table)
    stored = {} if known is None else schemas.by_name(known)
    for name, key in schemas.by_name(lifted).items():
        fresh = name in fields and name not in stored and known is not None
        if fresh and not schemas.same_shape(fields[name].dataType, key.dataType):
            change = schemas.Change((key.name,), "type_changed", key.dataType.simpleString(), fields[name].dataType.simpleString())
            schemas.require_compatible([change])


def _needs_refill(ctx: IngestContext, before: Layout, known: T.StructType | None) -> bool:
    """Whether a key is declared now that stored rows do not carry."""
    if known is None or not before.keys:
        return False
    held = {*schemas.by_name(known), *schemas.by_name(before.lifted)}
    new = [key.name for key in ctx.keys if key.name.lower() not in held]
    if new and not ctx.refill:
        raise schemas.IncompatibleSchema(
            f"rows of the table do not carry the new keys {', '.join(new)}; refill=True formats the archive anew"
        )
    return bool(new)


def _write_layout(ctx: IngestContext, layout: Layout) -> None:
    parts = {"source": layout.source.jsonValue(), "lifted": layout.lifted.jsonValue()}
    documents.write_json(
        ctx.spark, ctx.layout_path, {**parts, "keys": layout.keys, "refilling": layout.refilling}
    )


def fill_anew(ctx: IngestContext) -> None:
    """Let the next provisioning empty the log, so that the archive is formatted again."""
    _write_layout(ctx, _layout(ctx)._replace(refilling=True))


def table_exists(ctx: IngestContext) -> bool:
    return _is_table(ctx, ctx.at(0).table_path)


def _is_table(ctx: IngestContext, path: str) -> bool:
    if ctx.table_format == "delta":
        return documents.exists(ctx.spark, f"{path}/_delta_log")
    return documents.exists(ctx.spark, path)


def _append_nothing(
    ctx: IngestContext, schema: T.StructType, path: str, partition: str | None
) -> None:
    """Create or widen a table by appending no rows of the wanted schema."""
    writer = ctx.spark.createDataFrame([], schema).write.format(ctx.table_format)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.mode("append").option("mergeSchema", "true").save(path)


def register(ctx: IngestContext, formatted: T.StructType) -> None:
    """Make both tables known to the catalog, following added columns.

    A topic of several epochs has a table for each, and views of them all.
    """
    all_ = epochs(ctx)
    parts = [(ctx.table_name, formatted, lambda e: e.table_path, names.RUN_ID)]
    if ctx.shared is None:
        parts.append((ctx.raw_table_name, raw_schema(ctx), lambda e: e.raw_path, names.OUTCOME))
    for name, schema, place, partition in parts:
        if len(all_) == 1:
            _register(ctx, name, schema, place(ctx), partition)
            continue
        for each in all_:
            _register(ctx, f"{name}_{each.epoch}", schema, place(each), partition)
        if ctx.spark.catalog.tableExists(name) and ctx.spark.catalog.getTable(name).tableType == "EXTERNAL":
            ctx.spark.sql(f"DROP TABLE {name}")
        columns = ", ".join(f"`{f.name}`" for f in schema.fields)
        parts = " UNION ALL ".join(f"SELECT {columns} FROM {name}_{each.epoch}" for each in all_)
        ctx.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {parts}")


def register_shared(contexts: list[IngestContext]) -> None:
    """The archive of several topics as a table, and each topic's part of it as a view."""
    first = contexts[0]
    schema = shared_schema([(ctx.topic_label, _layout(ctx).source) for ctx in contexts])
    _register(first, first.shared_table_name, schema, first.raw_path, f"{names.TOPIC}, {names.OUTCOME}")
    first.spark.catalog.refreshTable(first.shared_table_name)
    for ctx in contexts:
        keys = [f"CAST(`{ctx.topic_label}`.{_quoted_path(key.path)} AS STRING) AS `{key.name}`" for key in ctx.keys]
        columns = [names.TIMESTAMP, *keys, names.VALUE_RAW, f"`{ctx.topic_label}` AS {names.VALUE}", *names.POSITION, names.OUTCOME]
        ctx.spark.sql(
            f"CREATE OR REPLACE VIEW {ctx.raw_table_name} AS SELECT {', '.join(columns)} "
            f"FROM {ctx.shared_table_name} WHERE {names.TOPIC} = {buckets.quoted(ctx.topic_label)}"
        )


def _quoted_path(path: str) -> str:
    return ".".join(f"`{step}`" for step in path.split("."))


def _registered(ctx: IngestContext) -> bool:
    last = epochs(ctx)[-1].epoch
    wanted = [ctx.table_name] if not last else [ctx.table_name, f"{ctx.table_name}_{last}"]
    return all(ctx.spark.catalog.tableExists(name) for name in wanted)


def refresh(ctx: IngestContext) -> None:
    """Let the catalog see the files of the last run."""
    of_epochs = epochs(ctx)
    suffixes = [""] if len(of_epochs) == 1 else [f"_{each.epoch}" for each in of_epochs]
    for name in (ctx.table_name, ctx.raw_table_name) if ctx.shared is None else (ctx.table_name,):
        for suffix in suffixes:
            ctx.spark.catalog.refreshTable(name + suffix)


def register_latest(ctx: IngestContext) -> None:
    """Let the view of latest rows follow the snapshot and the rows since."""
    spark, state = ctx.spark, _published(ctx)
    columns = ", ".join(f"`{f.name}`" for f in _snapshot_schema(ctx) if f.name != names.CURRENT)
    if _usable(ctx, state):
        # Its name says which run it is of: by itself it lacks the rows since.
        name = ctx.snapshot_table_name(state.run)
        # anew each time: after a refill another snapshot has the same number
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        snapshot = _latest_buckets(ctx)
        buckets.create_table(snapshot, name, f"{snapshot.path}.declared", state.latest)
        if state.older >= 0:
            spark.sql(f"DROP TABLE IF EXISTS {ctx.snapshot_table_name(state.older)}")
        rows = f"SELECT {columns} FROM {name}"
        if _rows_since(ctx, state.run):
            new = f"SELECT {columns} FROM {ctx.table_name} WHERE {names.RUN_ID} > {state.run}"
            rows = _latest_sql(ctx, columns, f"{rows} UNION ALL {new}")
    else:
        rows = _latest_sql(ctx, columns, f"SELECT {columns} FROM {ctx.table_name}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {ctx.latest_table_name} AS "
        f"SELECT {columns}, 'Y' AS {names.CURRENT} FROM ({rows})"
    )


def _latest_sql(ctx: IngestContext, columns: str, rows: str) -> str:
    """``latest`` as text, for the view."""
    order = ", ".join([names.TIMESTAMP, *names.POSITION])
    keys = ", ".join(f"`{name}`" for name in key_names(ctx.keys))
    newest = f"max_by(struct({columns}), struct({order})) AS newest"
    return f"SELECT newest.* FROM (SELECT {newest} FROM ({rows}) GROUP BY {keys})"


def _register(
    ctx: IngestContext, name: str, schema: T.StructType, path: str, partition: str | None = None
) -> None:
    spark = ctx.spark
    if ctx.table_format != "parquet" and partition is not None:
        create = f"CREATE TABLE IF NOT EXISTS {name} USING {ctx.table_format} LOCATION"
        spark.sql(f"{create} {buckets.quoted(path)}")
        return
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} exists and is not a table of this library")
        known = {f.name.lower(): f.dataType.simpleString() for f in spark.table(name).schema}
        added = [f for f in schema.fields if f.name.lower() not in known]
        kept = [f for f in schema.fields if f.name.lower() in known]
        if any(known[f.name.lower()] != f.dataType.simpleString() for f in kept):
            # Fields inside a column cannot be added in place. The files of a table
            # with a location outlive its catalog entry.
            spark.sql(f"DROP TABLE {name}")
        elif added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(added)})")
    layout = f"PARTITIONED BY ({partition})" if partition else ""
    # Created over files a stream has written, a table would take the columns of those
    # files and not the declared ones; hence the location is set afterwards.
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema.fields)}) USING parquet {layout} "
        f"LOCATION {buckets.quoted(path + '.declared')}"
    )
    spark.sql(f"ALTER TABLE {name} SET LOCATION {buckets.quoted(path)}")


def _ddl(fields: list[T.StructField]) -> str:
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields]).toDDL()


def read_saved_schema(ctx: IngestContext) -> T.StructType | None:
    document = documents.read_json_if_present(ctx.spark, ctx.saved_schema_path)
    return None if document is None else T.StructType.fromJson(document)


# --------------------------------------------------------------------- reading


def read_path(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Read with the declared schema: no footer is opened to merge schemas, and
    files older than a column give NULL."""
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path)


def stored_schema(ctx: IngestContext) -> T.StructType:
    """Columns of the formatted table as it stands."""
    table = T.StructType.fromJson(documents.read_json(ctx.spark, ctx.table_schema_path))
    return formatted_schema(ctx, table, _layout(ctx).lifted)


def _read_log(ctx: IngestContext) -> DataFrame:
    schema, state = stored_schema(ctx), compacted(ctx)
    parts = [read_runs(ctx, state.upto)]
    if state.parts:
        rewritten = [compacted_folder(ctx, part) for part in range(state.parts)]
        parts.append(ctx.spark.read.schema(schema).parquet(*rewritten))
    folders = [redrive_folder(ctx, number) for number in range(len(redriven(ctx)))]
    parts += [ctx.spark.read.schema(schema).parquet(*folders)] if folders else []
    return reduce(DataFrame.unionByName, parts)


def read_runs(ctx: IngestContext, after: int, upto: int | None = None) -> DataFrame:
    """Rows as the stream appended them, of the runs after one and up to another."""
    schema, run = stored_schema(ctx), F.col(names.RUN_ID)
    parts = [read_path(ctx.spark, each.table_path, schema, ctx.table_format) for each in epochs(ctx)]
    rows = reduce(DataFrame.unionByName, parts)
    rows = rows if after < 0 else rows.where(run > after)
    return rows if upto is None else rows.where(run <= upto)


class Compacted(NamedTuple):
    """The last run that is rewritten by key, and the parts that rewritten rows lie in."""

    upto: int = -1
    parts: int = 0


def compacted(ctx: IngestContext) -> Compacted:
    return Compacted(**(documents.read_json_if_present(ctx.spark, ctx.compacted_document) or {}))


def compacted_folder(ctx: IngestContext, part: int) -> str:
    return f"{ctx.compacted_path}/part={part}"


def redriven(ctx: IngestContext) -> list[int]:
    """The run that the rows of each redrive belong to."""
    return documents.read_json_if_present(ctx.spark, ctx.redriven_document) or []


def redrive_folder(ctx: IngestContext, number: int) -> str:
    return f"{ctx.redriven_path}/redrive={number}"


def _redriven_rows(ctx: IngestContext, rows: DataFrame, how: str) -> DataFrame:
    """Rows whose position was redriven, or was not."""
    folders = [redrive_folder(ctx, number) for number in range(len(redriven(ctx)))]
    if not folders:
        return rows if how == "left_anti" else rows.limit(0)
    ledger = ctx.spark.read.schema(T.StructType(_POSITION_FIELDS)).parquet(*folders)
    return rows.join(ledger, list(names.POSITION), how).select(*rows.columns)


def waiting_rejects(ctx: IngestContext) -> DataFrame:
    """Archive rows that were rejected and not accepted since."""
    return _redriven_rows(ctx, read_archive(ctx).where(F.col(names.OUTCOME) != names.ACCEPTED), "left_anti")


def read_formatted(ctx: IngestContext) -> DataFrame:
    """All accepted rows, as appended."""
    return _read_log(ctx).drop(names.RUN_ID)


def read_archive(ctx: IngestContext) -> DataFrame:
    """The raw archive with every outcome; keys come from the message where a file is
    older than their declaration."""
    schema, all_ = archive_schema(ctx), epochs(ctx) if ctx.shared is None else [ctx]
    parts = [read_path(ctx.spark, each.raw_path, schema, ctx.table_format) for each in all_]
    rows = own_rows(ctx, reduce(DataFrame.unionByName, parts))
    archived = schemas.by_name(rows.schema[names.VALUE].dataType)
    filled = {
        key.name: F.coalesce(F.col(f"`{key.name}`"), field(key.path).cast("string"))
        for key in ctx.keys
        if key.path.split(".")[0].lower() in archived
    }
    return rows.withColumns(filled)


def read_raw(ctx: IngestContext) -> DataFrame:
    """Accepted messages, redriven ones too: record time, keys as strings, original text.

    Keys of redriven messages are in the log; here they are those found when they landed.
    """
    archive = read_archive(ctx)
    rows = archive.where(F.col(names.OUTCOME) == names.ACCEPTED)
    if redriven(ctx):
        rejected = archive.where(F.col(names.OUTCOME) != names.ACCEPTED)
        rows = rows.unionByName(_redriven_rows(ctx, rejected, "left_semi"))
    return rows.drop(names.OUTCOME, names.VALUE, *names.POSITION)


def read_rejects(ctx: IngestContext) -> DataFrame:
    """Dead letters that no redrive accepted: record time, original text, reason."""
    rows = waiting_rejects(ctx)
    return rows.select(names.TIMESTAMP, names.VALUE_RAW, F.col(names.OUTCOME).alias("reason"))


def read_latest(ctx: IngestContext) -> DataFrame:
    """The newest row of every key: the snapshot, and rows not yet published."""
    state = _published(ctx)
    if not _usable(ctx, state):
        rows = latest(read_formatted(ctx), key_names(ctx.keys), _ORDER)
    else:
        rows = _with_rows_since(ctx, state, _latest_buckets(ctx), state.latest, _newest)
    return rows.withColumn(names.CURRENT, F.lit("Y"))


def read_history(ctx: IngestContext) -> DataFrame:
    """Every row with ``valid_to`` and ``current`` resolved.

    Stored intervals are read as they are; those of keys with rows not yet published are settled
    anew. A topic that stores no history (``store_history``) settles the whole log.
    """
    state = _published(ctx)
    if state.history is None or not _usable(ctx, state):
        return history(read_formatted(ctx).drop(names.CURRENT), key_names(ctx.keys))
    return _with_rows_since(ctx, state, _history_buckets(ctx), state.history, _settled)


def _with_rows_since(ctx, state: Published, of: buckets.Buckets, held: buckets.Held, merge) -> DataFrame:
    """Buckets without new rows as they are, and the others merged with them."""
    if not _rows_since(ctx, state.run):
        return buckets.read(of, held)
    new = _log_since(ctx, state.run)
    slots = set(buckets.touched(new, of.keys, of.count).slots)
    resting = buckets.read(of, {slot: run for slot, run in held.items() if slot not in slots})
    old = buckets.read(of, {slot: run for slot, run in held.items() if slot in slots})
    return resting.unionByName(merge(ctx, old, new))


def _newest(ctx: IngestContext, old: DataFrame, new: DataFrame) -> DataFrame:
    return merge_latest(old, new, key_names(ctx.keys), _ORDER)


def _settled(ctx: IngestContext, old: DataFrame, new: DataFrame) -> DataFrame:
    """Versions of the keys that have new rows anew, all others as they were."""
    keys = key_names(ctx.keys)
    theirs = new.select(*keys).distinct()
    return _spliced(old, _join_keys(old, theirs, "left_anti"), _join_keys(old, theirs, "left_semi"), new, keys)


def _spliced(old: DataFrame, others: DataFrame, same: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    versions = history(same.drop(names.VALID_TO, names.CURRENT).unionByName(new.drop(names.CURRENT)), keys)
    return others.unionByName(versions.select(*old.columns))


def _join_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows whose key is among these, or is not; NULL matches NULL."""
    named = keys.withColumnsRenamed({name: f"__k_{name}" for name in keys.columns})
    same = [rows[name].eqNullSafe(named[f"__k_{name}"]) for name in keys.columns]
    return rows.join(named, reduce(and_, same), how)


def _log_since(ctx: IngestContext, run: int) -> DataFrame:
    return _read_log(ctx).where(F.col(names.RUN_ID) > run).drop(names.RUN_ID)


_ORDER = [names.TIMESTAMP, *names.POSITION]


# ------------------------------------------------------------------ publishing


class Published(NamedTuple):
    """What the buckets hold: rows up to a run, by which keys, and where they lie."""

    run: int = -1
    keys: list[str] = []
    count: int = 0
    latest: dict[int, int] = {}
    history: dict[int, int] | None = None
    null_keys: bool = False  # a key of some row is NULL
    before: dict = {}  # what was held before, which readers may still use
    previous: int = -1  # the run published before, and the one before that
    older: int = -1


def _published(ctx: IngestContext) -> Published:
    found = documents.read_json_if_present(ctx.spark, ctx.published_path) or {}
    state = Published(**{name: found[name] for name in Published._fields if name in found})
    by_slot = {
        name: None if held is None else {int(slot): run for slot, run in held.items()}
        for name, held in (("latest", state.latest), ("history", state.history))
    }
    return state._replace(**by_slot)


def _usable(ctx: IngestContext, state: Published) -> bool:
    """Whether there are buckets, by the present keys and as many as are asked for."""
    return state.run >= 0 and state.keys == key_names(ctx.keys) and state.count == ctx.buckets


def open_run(ctx: IngestContext) -> int:
    """Number under which rows are appended: that of no run published or delivered yet."""
    return max(_published(ctx).run, delivered_runs(ctx).closed) + 1


def log_runs(ctx: IngestContext) -> list[int]:
    """The runs that the stream appended rows under, but for those whose files were removed."""
    found = [name for each in epochs(ctx) for name in documents.names(ctx.spark, each.table_path)]
    marked = [name.removeprefix(f"{names.RUN_ID}=") for name in found if name.startswith(f"{names.RUN_ID}=")]
    return sorted({int(number) for number in marked if number.isdigit()})


def log_bytes(ctx: IngestContext, runs: list[int]) -> int:
    """Bytes of the rows of these runs, as appended."""
    folders = [f"{each.table_path}/{names.RUN_ID}={run}" for each in epochs(ctx) for run in runs]
    folders += [redrive_folder(ctx, number) for number, run in enumerate(redriven(ctx)) if run in runs]
    return sum(documents.size(ctx.spark, folder) for folder in folders if documents.exists(ctx.spark, folder))


def _rows_since(ctx: IngestContext, run: int) -> list[int]:
    """The runs after this one that have rows, in the log, rewritten or redriven."""
    rewritten = range(run + 1, compacted(ctx).upto + 1)
    return sorted({number for number in (*log_runs(ctx), *redriven(ctx), *rewritten) if number > run})


def _snapshot_schema(ctx: IngestContext) -> T.StructType:
    return T.StructType([f for f in stored_schema(ctx).fields if f.name != names.RUN_ID])


def _history_schema(ctx: IngestContext) -> T.StructType:
    rows = [f for f in _snapshot_schema(ctx).fields if f.name != names.CURRENT]
    return T.StructType(
        [*rows, T.StructField(names.VALID_TO, T.TimestampType()), T.StructField(names.CURRENT, T.StringType())]
    )


def _latest_buckets(ctx: IngestContext) -> buckets.Buckets:
    keys = tuple(key_names(ctx.keys))
    return buckets.Buckets(ctx.spark, ctx.snapshot_path, _snapshot_schema(ctx), keys, ctx.buckets)


def _history_buckets(ctx: IngestContext) -> buckets.Buckets:
    return _latest_buckets(ctx)._replace(path=ctx.history_path, schema=_history_schema(ctx))


def publish_latest(ctx: IngestContext) -> bool:
    """Write the buckets that new rows touch, once there are enough of these.

    The document that names the buckets is replaced last. An attempt that dies earlier leaves
    the number open: later rows join it and the buckets are written again. What was published
    before stays for readers, what lies further back goes.
    """
    state = _published(ctx)
    since = _rows_since(ctx, state.run)
    if ctx.publish_share is None or not since:
        return False
    usable = _usable(ctx, state) and (state.history is not None or not ctx.store_history)
    new = _log_since(ctx, state.run if usable else -1)
    keys = key_names(ctx.keys)
    found = buckets.touched(new, keys, ctx.buckets)
    if not found.slots:
        return False
    nulls = found.null_keys or usable and state.null_keys
    kinds = {"latest": (_latest_buckets(ctx), _write_latest)}
    if ctx.store_history:
        kinds["history"] = (_history_buckets(ctx), _write_history)
    held = {name: dict(getattr(state, name) or {}) if usable else {} for name in kinds}
    theirs = {name: {s: r for s, r in held[name].items() if s in set(found.slots)} for name in kinds}
    if usable:
        if log_bytes(ctx, since) < ctx.publish_share * buckets.size(_latest_buckets(ctx), theirs["latest"]):
            return False
    run = max(since)
    for name, (of, write) in kinds.items():
        write(ctx, of, run, theirs[name], new, nulls)
    after = {name: {**held[name], **dict.fromkeys(found.slots, run)} for name in kinds}
    before = {name: dict(getattr(state, name) or {}) for name in ("latest", "history")}
    document = Published(
        run, keys, ctx.buckets, after["latest"], after.get("history"), nulls, before, state.run, state.previous
    )
    documents.write_json(ctx.spark, ctx.published_path, document._asdict())
    places = {"latest": _latest_buckets(ctx), "history": _history_buckets(ctx)}
    for name, further in state.before.items():
        old = {int(slot): number for slot, number in further.items()}
        buckets.clean(places[name], old, before[name], after.get(name, {}))
    return True


def _write_latest(ctx, of: buckets.Buckets, run: int, held: buckets.Held, new: DataFrame, nulls: bool) -> None:
    """The newer of each key's old and new row; only new rows are shuffled.

    Rows with NULL in a key meet no other in a join of equal keys. Where there are any, the old rows
    of the touched buckets are shuffled too.
    """
    keys = list(of.keys)
    newest = latest(new, keys, _ORDER).withColumn(names.CURRENT, F.lit("Y"))
    if not held or nulls:
        rows = newest if not held else merge_latest(buckets.read(of, held), newest, keys, _ORDER)
        buckets.write(of, run, rows.repartition(of.count, *keys))
        return
    with buckets.bucketed(of, held) as old:
        whole = F.struct(*[F.col(f"`{f.name}`") for f in of.schema.fields])
        fresh = newest.repartition(of.count, *keys).select(
            whole.alias("__new"), *[F.col(f"`{key}`").alias(f"__k_{key}") for key in keys]
        )
        known = old.select(whole.alias("__old"), *[F.col(f"`{key}`") for key in keys])
        same = [known[key] == fresh[f"__k_{key}"] for key in keys]
        met = known.join(fresh.hint("shuffle_hash"), reduce(and_, same), "full_outer")
        version = {side: F.struct(*[F.col(side)[name] for name in _ORDER]) for side in ("__old", "__new")}
        newer = F.col("__old").isNull() | F.col("__new").isNotNull() & (version["__new"] > version["__old"])
        kept = F.when(newer, F.col("__new")).otherwise(F.col("__old"))
        buckets.write(of, run, met.select(kept.alias("__row")).select("__row.*"))


def _write_history(ctx, of: buckets.Buckets, run: int, held: buckets.Held, new: DataFrame, nulls: bool) -> None:
    """Versions of keys with new rows anew; all others pass without a shuffle."""
    keys = list(of.keys)
    if not held:
        versions = history(new.drop(names.CURRENT), keys)
        buckets.write(of, run, versions.repartition(of.count, *keys))
        return
    if nulls:
        buckets.write(of, run, _settled(ctx, buckets.read(of, held), new).repartition(of.count, *keys))
        return
    with buckets.bucketed(of, held) as old:
        theirs = new.select(*keys).distinct().repartition(of.count, *keys).hint("shuffle_hash")
        others, same = old.join(theirs, keys, "left_anti"), old.join(theirs, keys, "left_semi")
        versions = history(same.drop(names.VALID_TO, names.CURRENT).unionByName(new.drop(names.CURRENT)), keys)
        spread = versions.select(*old.columns).repartition(of.count, *keys)
        buckets.write(of, run, others.select(*old.columns).unionByName(spread))


# ---------------------------------------------------------------- delivering


class Delivered(NamedTuple):
    """Runs that are closed to new rows, and those that the hook has written."""

    closed: int = -1
    written: int = -1


def hook_in_stream(ctx: IngestContext) -> bool:
    """Whether the stream calls the ``write`` hook itself, for each micro-batch.

    That takes a callback from Spark and a table that takes part of a batch back, as Delta does.
    """
    return ctx.hooks.write is not None and ctx.table_format != "parquet"


def delivered_runs(ctx: IngestContext) -> Delivered:
    found = documents.read_json_if_present(ctx.spark, ctx.delivered_path)
    return Delivered() if found is None else Delivered(**found)


def close_runs(ctx: IngestContext, run: int) -> None:
    """Let rows that come later belong to a run after this one."""
    state = delivered_runs(ctx)
    if state.closed < run:
        documents.write_json(ctx.spark, ctx.delivered_path, state._replace(closed=run)._asdict())


def deliver(ctx: IngestContext) -> list[int]:
    """Hand the rows of every run that is not written yet to the ``write`` hook.

    First the open run is closed: later rows get the next number, so that a run that is
    handed over again, because the last attempt died, has the very same rows. Then the
    hook gets one closed run after the other, and a ledger notes each once the hook has
    returned. A hook that replaces what it wrote under a number gives each row once.
    """
    state = delivered_runs(ctx)
    waiting = _rows_since(ctx, state.written)
    if not waiting:
        return []
    state = state._replace(closed=max(state.closed, *waiting))
    documents.write_json(ctx.spark, ctx.delivered_path, state._asdict())
    for run in waiting:
        rows = _read_log(ctx).where(F.col(names.RUN_ID) == run).drop(names.RUN_ID)
        ctx.hooks.write(ctx, rows, run)
        state = state._replace(written=run)
        documents.write_json(ctx.spark, ctx.delivered_path, state._asdict())
    return waiting


# --------------------------------------------------------------- batch writing


def write_batch(
    rows: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()
) -> None:
    """Write one batch so that writing it again replaces it.

    For ``write`` hooks: Spark delivers a batch at least once. Batch ids count within
    one checkpoint; after resetting a checkpoint, write to another path.
    """
    target = f"{path}/{names.BATCH_ID}={int(batch_id)}"
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(target)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches below ``path``; files older than a column give NULL."""
    stored = T.StructType([*schema.fields, T.StructField(names.BATCH_ID, T.LongType())])
    return spark.read.schema(stored).parquet(path)
