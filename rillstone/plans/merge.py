"""``write`` hooks for Delta tables: one row per key, or every row once."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.context import IngestContext
from rillstone.functions import names
from rillstone.functions.keys import key_names
from rillstone.operators.versions import latest
from rillstone.plans.tables import conform, formatted_schema, open_run

_ORDER = (names.TIMESTAMP, *names.POSITION)


def merge_statement(
    table: str, source: str, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]
) -> str:
    """Newer rows replace older ones of their key; NULL keys match each other.

    Repeating a batch changes nothing, as no row is newer than itself.
    """

    def version(side: str) -> str:
        return "struct(" + ", ".join(f"{side}.`{name}`" for name in order) + ")"

    same = " AND ".join(f"old.`{name}` <=> new.`{name}`" for name in keys)
    assigned = ", ".join(f"old.`{name}` = new.`{name}`" for name in columns)
    listed = ", ".join(f"`{name}`" for name in columns)
    values = ", ".join(f"new.`{name}`" for name in columns)
    return (
        f"MERGE INTO {table} AS old USING {source} AS new ON {same} "
        f"WHEN MATCHED AND {version('new')} > {version('old')} THEN UPDATE SET {assigned} "
        f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values})"
    )


def newest_in_batch(ctx: IngestContext, batch: DataFrame) -> DataFrame:
    """The batch in the table's shape, one row per key, marked current."""
    schema = formatted_schema(ctx, ctx.target_schema)
    rows = conform(batch, schema).drop(names.RUN_ID)
    current = latest(rows, key_names(ctx.keys), _ORDER)
    return current.selectExpr(
        *[
            f"'Y' AS `{name}`" if name == names.CURRENT else f"`{name}`"
            for name in current.columns
        ]
    )


def merge_write(ctx: IngestContext, batch: DataFrame, batch_id: int) -> None:
    """``Hooks(write=merge_write)``: upsert each micro-batch into the table.

    The table has no partitions by run, which its rows do not belong to.
    """
    rows = newest_in_batch(ctx, batch)
    source = re.sub(r"\W", "_", f"incoming_{ctx.resource_name}")
    rows.createOrReplaceTempView(source)
    rows.sparkSession.sql(
        merge_statement(ctx.table_name, source, key_names(ctx.keys), rows.columns, _ORDER)
    )


merge_write.one_row_per_key = True


def transaction_options(ctx: IngestContext, batch: DataFrame, batch_id: int) -> dict[str, str]:
    """Options by which Delta skips a batch it already holds.

    Batch ids count within one checkpoint, so the id of the checkpointed query goes
    with them: after a reset, batch 0 is a new batch.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return {"txnAppId": f"{ctx.resource_name}.{query}", "txnVersion": str(batch_id)}


def append_write(ctx: IngestContext, batch: DataFrame, batch_id: int) -> None:
    """``Hooks(write=append_write)``: append each micro-batch exactly once."""
    numbered = batch.withColumn(names.RUN_ID, F.lit(open_run(ctx)))
    rows = conform(numbered, formatted_schema(ctx, ctx.target_schema))
    options = transaction_options(ctx, batch, batch_id)
    rows.write.format(ctx.table_format).mode("append").options(**options).save(ctx.table_path)
