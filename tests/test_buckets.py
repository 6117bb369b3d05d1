"""Buckets of latest rows and of history: what a run reads, writes and leaves."""

import dataclasses
import pathlib
import shutil

import pytest
from test_ingest import SCHEMA, context, message, physical, send

from rillstone.operators.versions import history
from rillstone.plans import buckets, tables
from rillstone.plans.ingest import run_ingest
from rillstone.sources import documents

TIE = ["record_partition", "record_offset"]


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=str)


def files(folder):
    return {str(p) for p in pathlib.Path(folder).rglob("*.parquet")}


def slots(spark, ids, count):
    found = spark.createDataFrame([(i,) for i in ids], "id long").select("id", buckets.slot_of(["id"], count))
    return dict(map(tuple, found.collect()))


@pytest.mark.parametrize("kind", ["snapshot", "history"])
def test_a_run_writes_the_buckets_of_its_keys_only(spark, tmp_path, kind):
    ctx = context(spark, tmp_path, buckets=8, store_history=True)
    send(ctx, *[message(i, "old") for i in range(200)])
    run_ingest(ctx)
    folder = f"{ctx.table_path}_{kind}"
    before = files(folder)
    by_id = slots(spark, range(200), 8)
    theirs = [i for i, slot in by_id.items() if slot == 3][:1]
    send(ctx, *[message(i, "new") for i in theirs], at=500, offset=500)
    run_ingest(ctx)
    added = files(folder) - before
    assert before <= files(folder)  # the run before may still be read
    assert {pathlib.Path(p).parent.name for p in added} == {"__slot=3"}
    newest = {r.id: r.n for r in tables.read_latest(ctx).collect()}
    assert newest == {i: "new" if i in theirs else "old" for i in range(200)}
    assert tables.read_history(ctx).count() == 201


def test_old_rows_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Neither those of the snapshot, nor the versions of keys without new rows."""
    plans = []
    write = buckets.write

    def seen(of, run, rows):
        plans.append(physical(rows))
        write(of, run, rows)

    ctx = context(spark, tmp_path, buckets=4, store_history=True)
    send(ctx, *[message(i, "old") for i in range(50)])
    run_ingest(ctx)
    monkeypatch.setattr(buckets, "write", seen)
    send(ctx, message(1, "new"), message(77, "new"), at=500, offset=500)
    run_ingest(ctx)
    newest, versions = plans
    assert exchanged(newest) == {"new"}
    # of the versions, those whose keys have new rows are settled anew, the others pass
    assert exchanged(versions) == {"new", "same"}


def exchanged(plan):
    """What an exchange stands above: new rows of the log, and old ones of the keys these have.

    Old rows are scanned as a bucketed table, of which two keys at most are kept.
    """
    above, found = [], set()
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = [entry for entry in above if entry[0] < depth]
        parents = " ".join(text for _, text in above)
        if "FileScan" in line:
            old = "rillstone_" in line
            assert old == ("Bucketed: true" in line)
            kind = "same" if old and "LeftSemi" in parents else "old" if old else "new"
            if "Exchange" in parents:
                found.add(kind)
        above.append((depth, line))
    return found


def test_next_run_does_not_read_the_log(spark, tmp_path):
    """What earlier runs appended may be gone: the buckets have it."""
    ctx = context(spark, tmp_path, store_history=True)
    send(ctx, message(1, "a"), message(2, "b"), message(1, "c"))
    run_ingest(ctx)
    for part in pathlib.Path(f"{ctx.table_path}/run_id=0").glob("*.parquet"):
        shutil.copyfile(part, tmp_path / part.name)
        part.write_bytes(b"not a file of rows")
    send(ctx, message(1, "late"), message(3, "d"), at=1, offset=9)
    run_ingest(ctx)
    assert rows_of(tables.read_latest(ctx), "id", "n") == [(1, "c"), (2, "b"), (3, "d")]
    versions = tables.read_history(ctx).orderBy("id", "timestamp", *TIE).collect()
    assert [(v.id, v.n, v.current) for v in versions] == [
        (1, "a", "N"), (1, "late", "N"), (1, "c", "Y"), (2, "b", "Y"), (3, "d", "Y"),
    ]
    # the late row split the interval it fell into
    assert [v.valid_to for v in versions[:2]] == [versions[1].timestamp, versions[2].timestamp]


@pytest.mark.parametrize("share", [0.0, 0.4, 100.0])
def test_stored_history_is_that_of_one_pass(spark, tmp_path, share):
    ctx = context(spark, tmp_path, buckets=3, store_history=True, publish_share=share)
    order = [7, 3, 3, 9, 1, 8, 0, 3, 5, 2, 6, 4]
    for number, second in enumerate(order):
        send(ctx, message(second % 3, f"n{number}"), message(number, "x"), at=second, offset=10 * number)
        if number % 3 == 2:
            run_ingest(ctx)
            whole = history(tables.read_formatted(ctx).drop("current"), ["id"])
            columns = ("id", "n", "timestamp", "valid_to", "current", *TIE)
            assert rows_of(tables.read_history(ctx), *columns) == rows_of(whole, *columns)


def test_attempts_that_die_leave_what_was_published(spark, tmp_path, monkeypatch):
    ctx = context(spark, tmp_path, buckets=2, store_history=True)
    send(ctx, message(1, "a"))
    run_ingest(ctx)
    send(ctx, message(1, "b"), message(2, "c"), at=5, offset=5)
    with monkeypatch.context() as broken:
        broken.setattr(documents, "write_json", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_ingest(ctx)
    assert tables.open_run(ctx) == 1  # its buckets are there, and nobody reads them
    assert rows_of(tables.read_latest(ctx), "id", "n") == [(1, "b"), (2, "c")]
    run_ingest(ctx)
    assert tables.open_run(ctx) == 2
    assert rows_of(tables.read_latest(ctx), "id", "n") == [(1, "b"), (2, "c")]
    assert rows_of(tables.read_history(ctx), "id", "n", "current") == [(1, "a", "N"), (1, "b", "Y"), (2, "c", "Y")]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rillstone_")]


def test_another_number_of_buckets_writes_all_anew(spark, tmp_path):
    ctx = context(spark, tmp_path, buckets=2)
    send(ctx, message(1, "a"), message(2, "b"))
    run_ingest(ctx)
    wider = dataclasses.replace(ctx, buckets=5, store_history=True)
    assert rows_of(tables.read_latest(wider), "id", "n") == [(1, "a"), (2, "b")]
    send(wider, message(3, "c"), offset=7)
    run_ingest(wider)
    assert rows_of(tables.read_latest(wider), "id", "n") == [(1, "a"), (2, "b"), (3, "c")]
    assert set(documents.read_json(spark, wider.published_path)["latest"].values()) == {1}
    assert tables.read_history(wider).count() == 3


def test_null_keys_are_keys(spark, tmp_path):
    """Without dead letters a message may lack its key: such rows are versions of one key."""
    schema = type(SCHEMA)([type(SCHEMA.fields[0])("id", SCHEMA["id"].dataType), SCHEMA["n"]])
    ctx = context(spark, tmp_path, schema=schema, dead_letters=False, buckets=2, store_history=True)
    for number in range(3):
        send(ctx, f'{{"n":"none{number}"}}', message(1, f"one{number}"), at=number, offset=10 * number)
        run_ingest(ctx)
    assert rows_of(tables.read_latest(ctx), "id", "n") == [(1, "one2"), (None, "none2")]
    assert tables.read_history(ctx).where("id is null and current = 'N'").count() == 2


def test_hook_gets_each_run_once_more_after_a_crash(spark, tmp_path):
    from rillstone.context import Hooks

    calls = []

    def write(ctx, batch, batch_id):
        tables.write_batch(batch, f"{tmp_path}/out", batch_id)
        calls.append((batch_id, batch.count()))
        if len(calls) == 1:
            raise InterruptedError

    ctx = context(spark, tmp_path, registry={("src", "demo_events"): Hooks(write=write)})
    send(ctx, message(1), message(2), "oops")
    with pytest.raises(InterruptedError):
        run_ingest(ctx)
    send(ctx, message(3), offset=5)
    run_ingest(ctx)
    run_ingest(ctx)
    assert calls == [(0, 2), (0, 2), (1, 1)]  # the same rows again, whatever came meanwhile
    out = tables.read_batches(spark, f"{tmp_path}/out", tables.read_formatted(ctx).schema)
    assert rows_of(out, "id", "batch_id") == [(1, 0), (2, 0), (3, 1)]
    # without the hook the topic goes on, and its latest rows are those of all runs
    plain = dataclasses.replace(ctx, hooks=Hooks())
    send(plain, message(1, "later"), at=50, offset=9)
    run_ingest(plain)
    assert rows_of(tables.read_latest(plain), "id", "n") == [(1, "later"), (2, "x"), (3, "x")]
