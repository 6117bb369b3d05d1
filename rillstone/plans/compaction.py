"""The log's closed runs, rewritten by key.

Many small batches leave many small files, each with rows of any key. Runs that get no more rows are
rewritten beside the log, in ranges of keys with files of a chosen size, whose statistics and
bloom filters let a lookup of one key skip nearly all of them. Readers go over to the
rewritten rows when the document that names them is replaced; only then may the old files go.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.context import IngestContext
from rillstone.functions import names
from rillstone.functions.keys import key_names
from rillstone.plans import tables
from rillstone.sources import documents

FILE_BYTES = 256 * 2**20


def compact(ctx: IngestContext, file_bytes: int = FILE_BYTES, remove: bool = True) -> int:
    """Rewrite the runs that are in the log, and close them; how many runs that were.

    Rows that come later belong to the next run. With ``remove``, the files of the rewritten
    runs are deleted; a reader that began before may miss them. A key with more rows than a file
    has is spread over several by time. Not to be called while the topic is being ingested.
    """
    ctx = tables.epochs(ctx)[-1]
    state = tables.compacted(ctx)
    waiting = [run for run in tables.log_runs(ctx) if run > state.upto]
    if not waiting:
        return 0
    tables.close_runs(ctx, max(waiting))
    rows = tables.read_runs(ctx, state.upto, max(waiting))
    keys, order = key_names(ctx.keys), [names.TIMESTAMP, *names.POSITION]
    files = -(-tables.log_bytes(ctx, waiting) // file_bytes)
    by = [F.col(f"`{name}`") for name in (*keys, *order)]
    writer = rows.repartitionByRange(max(1, files), *by).sortWithinPartitions(*by).write.mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    folder = tables.compacted_folder(ctx, state.parts)
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(folder)
    after = state._replace(upto=max(waiting), parts=state.parts + 1)
    documents.write_json(ctx.spark, ctx.compacted_document, after._asdict())
    if remove:
        for each in tables.epochs(ctx):
            for run in waiting:
                documents.remove(ctx.spark, f"{each.table_path}/{names.RUN_ID}={run}")
    return len(waiting)
