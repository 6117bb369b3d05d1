"""Going on after a checkpoint was lost.

A file sink remembers by number which batches it holds. A stream that lost its checkpoint
counts from 0 again: what it reads anew would be taken for batches that are there, and new
records among them would be dropped without a word. So a topic whose landing checkpoint lags behind
its archive begins a new epoch: archive, log and checkpoints in folders of their own, beside
the old ones, which readers see as one. Its stream reads the records once more and leaves out
those whose offsets are stored, told by ranges of them; Kafka starts behind the last ones.

The log of formatted rows can be made again from the archive: when only its checkpoint is
lost, it is filled anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.context import IngestContext
from rillstone.functions import names
from rillstone.operators.offsets import BLOCK, next_offsets, stored_ranges
from rillstone.plans import tables
from rillstone.sources import documents


def recover(ctx: IngestContext) -> IngestContext:
    """The context of the epoch that this run belongs to: a new one if landing lost its checkpoint."""
    epochs = tables.epochs(ctx)
    ctx = epochs[-1]
    if not tables.table_exists(ctx):
        return ctx
    recover_log(ctx)
    lost = _lags(ctx, "landing", ctx.raw_path) if ctx.table_format == "parquet" else _unread(ctx)
    return _next_epoch(ctx) if lost else ctx


def recover_log(ctx: IngestContext) -> None:
    """Let the archive be formatted again if the checkpoint of that is lost."""
    lost = ctx.table_format == "parquet" and tables.table_exists(ctx)
    if lost and any(_lags(each, "formatting", each.table_path) for each in tables.epochs(ctx)):
        tables.fill_anew(ctx)


class LostCheckpoint(RuntimeError):
    """An archive holds batches that its stream does not know of."""


def require_checkpoint(ctx: IngestContext) -> None:
    """Refuse to land into an archive whose checkpoint is lost: batches would be dropped."""
    if ctx.table_format == "parquet" and _lags(ctx, "landing", ctx.raw_path):
        raise LostCheckpoint(f"{ctx.checkpoint('landing')} lags behind {ctx.raw_path}")


def _lags(ctx: IngestContext, stage: str, path: str) -> bool:
    """Whether a sink holds batches that its stream's checkpoint does not know."""
    held = [name.split(".")[0] for name in documents.names(ctx.spark, f"{path}/_spark_metadata")]
    last = max((int(name) for name in held if name.isdigit()), default=-1)
    return last > documents.largest_number(ctx.spark, f"{ctx.checkpoint(stage)}/offsets")


def _unread(ctx: IngestContext) -> bool:
    """On Delta, whose tables tell streams apart: rows without any checkpoint."""
    known = documents.largest_number(ctx.spark, f"{ctx.checkpoint('landing')}/offsets") >= 0
    return not known and not tables.read_archive(ctx).isEmpty()


def _next_epoch(ctx: IngestContext) -> IngestContext:
    """Note what is stored, and only then that a new epoch has begun."""
    spark, fresh = ctx.spark, ctx.at(ctx.epoch + 1)
    archive = tables.read_archive(ctx)
    blocks = stored_ranges(archive).withColumn(
        "block", F.explode(F.expr(f"sequence(first_offset div {BLOCK}, last_offset div {BLOCK})"))
    )
    blocks.write.mode("overwrite").parquet(fresh.stored_path)
    # a row for each record partition
    following = next_offsets(archive).agg(F.collect_list(F.struct("*"))).first()[0]
    positions = {str(row[names.RECORD_PARTITION]): row["next_offset"] for row in following}
    documents.write_json(spark, f"{fresh.stored_path}.json", positions)
    for path in (fresh.table_path, fresh.raw_path):
        documents.make_directory(spark, path)
    tables.write_epoch(fresh)
    return fresh


def not_stored(ctx: IngestContext, records: DataFrame) -> DataFrame:
    """Records whose offsets no earlier epoch stored."""
    if not ctx.epoch:
        return records
    known = ctx.spark.read.schema(
        f"{names.RECORD_PARTITION} int, first_offset bigint, last_offset bigint, block bigint"
    ).parquet(ctx.stored_path)
    here = (
        (F.col("partition") == F.col(names.RECORD_PARTITION))
        & (F.expr(f"offset div {BLOCK}") == F.col("block"))
        & F.col("offset").between(F.col("first_offset"), F.col("last_offset"))
    )
    return records.join(known, here, "left_anti")


def starting_positions(ctx: IngestContext) -> dict[str, int] | None:
    """Where each record partition goes on, in an epoch that followed another."""
    return documents.read_json(ctx.spark, f"{ctx.stored_path}.json") if ctx.epoch else None
