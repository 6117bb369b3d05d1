"""Run a query until its backlog is gone, and report what it did."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS_SCHEMA = (
    "query string, batch_id bigint, input_rows bigint, rows_per_second double, millis bigint"
)
# Spark keeps the last reports of a query only; they are fetched at this interval.
POLL_SECONDS = 0.2
# Reports held before they are written out.
HELD = 1000


class DrainTimeout(TimeoutError):
    """The backlog was not drained in time; the query has been stopped."""


class IncompleteProgress(RuntimeError):
    """Batches went by unseen, faster than Spark's retained reports were fetched."""


class Reports:
    """Progress of every batch of a run, fetched while it goes on.

    Long runs have more batches than Spark retains reports of, and than its checkpoint
    remembers; what has been fetched goes to a folder in portions.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.seen: dict[str, set[int]] = {}
        self.held: list[tuple] = []
        self.written = False

    def fetch(self, query: StreamingQuery) -> None:
        seen = self.seen.setdefault(query.name, set())
        for report in query.recentProgress:
            if report.batchId in seen or report.numInputRows == 0 and not report.durationMs.get("addBatch"):
                continue
            seen.add(report.batchId)
            if report.numInputRows > 0:
                rate, millis = report.processedRowsPerSecond, report.batchDuration
                self.held.append((report.name, report.batchId, report.numInputRows, rate, millis))
        if len(self.held) >= HELD:
            self._write()

    def _write(self) -> None:
        rows = self.spark.createDataFrame(self.held, PROGRESS_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(self.folder)
        self.held, self.written = [], True

    def require(self, name: str, first: int, last: int) -> None:
        """Raise unless every batch from ``first`` to ``last`` has been seen."""
        gone = [number for number in range(first, last + 1) if number not in self.seen.get(name, ())]
        if gone:
            raise IncompleteProgress(f"{name}: no report of batches {gone[:10]} (of {len(gone)})")

    def frame(self) -> DataFrame:
        """One row per batch with input."""
        held = self.spark.createDataFrame(self.held, PROGRESS_SCHEMA)
        if not self.written:
            return held
        return self.spark.read.schema(held.schema).parquet(self.folder).unionByName(held)


def drain(
    query: StreamingQuery, timeout_seconds: float | None = None, reports: Reports | None = None
) -> None:
    """Wait for an ``availableNow`` query; raises its error, or on timeout stops it."""
    end = None if timeout_seconds is None else time.monotonic() + timeout_seconds
    ended = False
    while not ended:
        left = POLL_SECONDS if end is None else min(POLL_SECONDS, end - time.monotonic())
        if left < 0.001:
            status = query.status
            query.stop()
            if reports is not None:
                reports.fetch(query)
            raise DrainTimeout(f"not drained after {timeout_seconds} s: {status}")
        ended = query.awaitTermination(left)
        if reports is not None:
            reports.fetch(query)
    error = query.exception()
    if error is not None:
        raise error
