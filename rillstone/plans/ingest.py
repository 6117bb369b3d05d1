"""Whole runs: provision the tables, drain the topic, publish, stop."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillstone.context import HookRegistry, IngestContext, load_context
from rillstone.plans.recovery import recover, recover_log, require_checkpoint
from rillstone.plans.tables import (
    Provisioned,
    deliver,
    epochs,
    hook_in_stream,
    provision,
    publish_latest,
    refresh,
    register_latest,
    register_shared,
    shared_schema,
)
from rillstone.sources import documents
from rillstone.streaming.drain import DrainTimeout, Reports, drain
from rillstone.streaming.stages import (
    files_side_by_side,
    open_records,
    ship_hook_code,
    start_formatting,
    start_landing,
    start_shared_landing,
)


class Run(NamedTuple):
    provisioned: Provisioned
    landing: StreamingQuery
    formatting: StreamingQuery
    reports: Reports
    batches: dict[str, tuple[int, int]]  # first and last batch by query

    def progress(self) -> DataFrame:
        """One row per batch with input; raises if a batch went by unseen."""
        for name, (first, last) in self.batches.items():
            self.reports.require(name, first, last)
        return self.reports.frame()


def run_ingest(ctx: IngestContext) -> Run:
    """Ingest everything available now; a rerun continues from the checkpoints.

    When landing takes too long, what has landed is formatted and published all the same
    before the timeout is raised: each run makes headway, however long the backlog.
    """
    with files_side_by_side(ctx.spark):
        return _run(ctx)


def _run(ctx: IngestContext) -> Run:
    ctx = recover(ctx)
    provisioned = provision(ctx)
    ship_hook_code(ctx)
    drained = _Drained(ctx)
    landing = drained.stage(ctx, "landing", start_landing)
    formatting = [drained.stage(each, "formatting", start_formatting) for each in epochs(ctx)]
    publish(ctx)
    if drained.late is not None:
        raise drained.late
    return Run(provisioned, landing, formatting[-1], drained.reports, drained.batches)


class _Drained:
    """Stages that were drained one after the other, and what they reported."""

    def __init__(self, ctx: IngestContext):
        self.reports = Reports(ctx.spark, f"{ctx.progress_path}/{uuid.uuid4().hex}")
        self.batches: dict[str, tuple[int, int]] = {}
        self.late: DrainTimeout | None = None

    def stage(self, ctx: IngestContext, stage: str, start: Callable[[IngestContext], StreamingQuery]) -> StreamingQuery:
        commits = f"{ctx.checkpoint(stage)}/commits"
        first = documents.largest_number(ctx.spark, commits) + 1
        query = start(ctx)
        try:
            drain(query, ctx.timeout_seconds, self.reports)
        except DrainTimeout as timeout:
            self.late = self.late or timeout
        self.batches[query.name] = (first, documents.largest_number(ctx.spark, commits))
        return query


def run_pattern(
    contexts: Iterable[IngestContext], name: str, record_path: str | None = None, at_once: int = 8
) -> list[Run]:
    """Ingest several topics that land by one stream, in one archive called ``name``.

    The stream reads every topic that the first context's ``kafka_topic_pattern`` matches, or
    the record files below ``record_path``, whatever topics they hold; each message is parsed by
    its own topic's declaration, and messages of other topics are archived as rejects.
    Formatting goes by topic, side by side. A shared landing that lost its checkpoint
    raises: which topic's offsets are stored is not told apart there.
    """
    contexts = [replace(ctx, shared=name, record_path=record_path) for ctx in contexts]
    first = contexts[0]
    labels = [ctx.topic_label for ctx in contexts]
    reserved = {*shared_schema([]).names}
    if len({*labels}) != len(labels) or reserved & {*labels}:
        raise ValueError(f"topics cannot share an archive: {', '.join(labels)}")
    require_checkpoint(first)
    with files_side_by_side(first.spark):
        for ctx in contexts:
            recover_log(ctx)
            ship_hook_code(ctx)
        provisioned = [provision(ctx) for ctx in contexts]
        drained = _Drained(first)
        records = open_records(first)
        landing = drained.stage(first, "landing", lambda _: start_shared_landing(contexts, records))

        def format_one(ctx: IngestContext) -> tuple[_Drained, StreamingQuery]:
            own = _Drained(ctx)
            query = own.stage(ctx, "formatting", start_formatting)
            publish(ctx)
            return own, query

        if first.register_tables:
            register_shared(contexts)
        with ThreadPoolExecutor(at_once) as pool:
            formatted = [pool.submit(format_one, ctx) for ctx in contexts]
    _raise_any([each.exception() for each in formatted])
    late = [own.late for own in (drained, *(each.result()[0] for each in formatted)) if own.late is not None]
    if late:
        raise late[0]
    done = [each.result() for each in formatted]
    return [
        Run(was, landing, query, own.reports, own.batches) for was, (own, query) in zip(provisioned, done)
    ]


def _raise_any(errors: list[BaseException | None]) -> None:
    errors = [error for error in errors if error is not None]
    if len(errors) == 1:
        raise errors[0]
    if errors:
        raise ExceptionGroup("topics failed", errors)


def publish(ctx: IngestContext) -> None:
    """What follows new rows: buckets or the hook, and the catalog."""
    if ctx.hooks.write is None:
        publish_latest(ctx)
    elif not hook_in_stream(ctx):
        deliver(ctx)
    if ctx.register_tables:
        refresh(ctx)
        if ctx.hooks.write is None:
            register_latest(ctx)


def run_topics(contexts: Iterable[IngestContext], at_once: int = 8) -> list[Run]:
    """Ingest several topics side by side, each with its own checkpoints.

    The threads only submit work to Spark. A failing topic does not keep the others
    from finishing; its error is raised at the end.
    """
    contexts = list(contexts)
    paths = [ctx.table_path for ctx in contexts]
    if len(set(paths)) != len(paths):
        raise ValueError("two topics share one table")
    with ThreadPoolExecutor(at_once) as pool:
        runs = [pool.submit(run_ingest, ctx) for ctx in contexts]
    _raise_any([run.exception() for run in runs])
    return [run.result() for run in runs]


def run_jobs(
    spark: SparkSession,
    jobs: Iterable[Mapping[str, Any]],
    generic: Mapping[str, Any] | str,
    clusters: Mapping[str, Mapping[str, Any] | str],
    registry: HookRegistry | None = None,
    **options: Any,
) -> list[Run]:
    """Ingest the topics of a list of job parameters; ``clusters`` goes by source."""
    return run_topics(
        load_context(spark, job, generic, clusters[job["source"]], registry, **options)
        for job in jobs
    )
