"""Rejected messages, classified again under a corrected declaration.

Messages stay where they landed. What a redrive accepts is formatted and stored beside the log,
with its positions: they are the ledger, by which later redrives and readers of rejects
leave these messages out. A redrive counts once the document that lists it is
replaced, so that one that dies is done again from the same rejects.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.context import IngestContext
from rillstone.functions import names
from rillstone.plans import tables
from rillstone.plans.ingest import publish
from rillstone.plans.recovery import recover
from rillstone.sources import documents
from rillstone.streaming.stages import archived, formatted_rows


def redrive(ctx: IngestContext) -> int:
    """Give every message that is still rejected another try; how many were accepted.

    The declaration is applied first, as a run does. Accepted rows join the open run: they
    are published, or handed to the ``write`` hook, like rows that have just come. Not to be
    called while the topic is being ingested.
    """
    ctx = recover(ctx)
    tables.provision(ctx)
    waiting = tables.waiting_rejects(ctx).select(
        names.TIMESTAMP, F.col(names.VALUE_RAW).alias(names.VALUE), *names.POSITION
    )
    done = tables.redriven(ctx)
    number, run = len(done), tables.open_run(ctx)
    rows = formatted_rows(ctx, archived(ctx, waiting)).withColumn(names.RUN_ID, F.lit(run))
    folder = tables.redrive_folder(ctx, number)
    tables.conform(rows, tables.stored_schema(ctx)).write.mode("overwrite").parquet(folder)
    accepted = ctx.spark.read.schema(tables.stored_schema(ctx)).parquet(folder).count()
    if accepted:
        documents.write_json(ctx.spark, ctx.redriven_document, [*done, run])
    else:
        documents.remove(ctx.spark, folder)
    publish(ctx)
    return accepted
