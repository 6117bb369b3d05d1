"""Rows by key in a fixed number of buckets; a run replaces the buckets that it touches.

Every run writes its buckets to a folder of its own, ``run=<n>/__slot=<bucket>``. Which run holds
the present rows of which bucket is a small document beside it, replaced last: readers
see all of a run or nothing, and a run that dies leaves folders that nobody reads.

Buckets are those of Spark's bucketed tables. For the time of a rewrite the old buckets are
entered in the catalog as such a table, so that Spark knows by which keys their files
are parted: joined with new rows, only the new ones are shuffled, however large the old ones
are. Files of untouched buckets are neither read nor written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.sources import documents

SLOT = "__slot"
# Partitions that one statement adds to a catalog table.
ADDED = 500

#: Which run holds the present rows of each bucket that has any.
Held = Mapping[int, int]


class Buckets(NamedTuple):
    """Where the rows lie, and by which keys they are parted."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    count: int

    def folder(self, run: int) -> str:
        return f"{self.path}/run={run}"

    def folders(self, held: Held) -> list[str]:
        return [f"{self.folder(run)}/{SLOT}={slot}" for slot, run in sorted(held.items())]


def slot_of(keys: Iterable[str], count: int) -> Column:
    """The bucket of a row: that of a table clustered by the keys."""
    hashed = F.hash(*[F.col(f"`{key}`") for key in keys])
    return F.pmod(hashed, F.lit(count)).cast("int")


class Touched(NamedTuple):
    slots: list[int]
    null_keys: bool


def touched(rows: DataFrame, keys: Iterable[str], count: int) -> Touched:
    """The buckets that have a row among these, and whether a key is NULL."""
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(f"`{key}`").isNull()
    found = rows.agg(F.collect_set(slot_of(keys, count)), F.bool_or(absent)).first()
    return Touched(sorted(found[0]), bool(found[1]))


def read(buckets: Buckets, held: Held) -> DataFrame:
    """Rows of the given buckets, from their files."""
    if not held:
        return buckets.spark.createDataFrame([], buckets.schema)
    return buckets.spark.read.schema(buckets.schema).parquet(*buckets.folders(held))


def create_table(buckets: Buckets, name: str, location: str, held: Held = {}) -> None:  # noqa: B006
    """Enter buckets in the catalog as a bucketed table, each with its folder."""
    spark = buckets.spark
    fields = T.StructType([T.StructField(f.name, f.dataType) for f in buckets.schema.fields]).toDDL()
    keys = ", ".join(f"`{key}`" for key in buckets.keys)
    spark.sql(
        f"CREATE TABLE {name} ({fields}, {SLOT} INT) USING parquet PARTITIONED BY ({SLOT}) "
        f"CLUSTERED BY ({keys}) INTO {buckets.count} BUCKETS LOCATION {quoted(location)}"
    )
    places = [
        f"PARTITION ({SLOT}={slot}) LOCATION {quoted(folder)}"
        for slot, folder in zip(sorted(held), buckets.folders(held))
    ]
    for at in range(0, len(places), ADDED):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(places[at : at + ADDED])}")


def quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _table(buckets: Buckets, location: str, held: Held = {}) -> Iterator[str]:  # noqa: B006
    """A catalog entry that lasts as long as this; its files outlive it."""
    name = f"`{buckets.spark.catalog.currentDatabase()}`.rillstone_{uuid.uuid4().hex}"
    create_table(buckets, name, location, held)
    try:
        yield name
    finally:
        buckets.spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def bucketed(buckets: Buckets, held: Held) -> Iterator[DataFrame]:
    """Rows of the given buckets, known to be parted by the keys, while in here."""
    with _table(buckets, f"{buckets.path}.declared", held) as name:
        yield buckets.spark.table(name).drop(SLOT)


def write(buckets: Buckets, run: int, rows: DataFrame) -> None:
    """Write a run's buckets; what an earlier attempt at this run left is replaced.

    Rows are expected to be parted by the keys into as many tasks as there are buckets;
    each then writes one file.
    """
    documents.remove(buckets.spark, buckets.folder(run))
    columns = [F.col(f"`{f.name}`") for f in buckets.schema.fields]
    with _table(buckets, buckets.folder(run)) as name:
        rows.select(*columns, slot_of(buckets.keys, buckets.count).alias(SLOT)).write.insertInto(name)


def clean(buckets: Buckets, old: Held, *kept: Held) -> None:
    """Remove the folders of ``old`` that none of the others names."""
    used = {(slot, run) for held in kept for slot, run in held.items()}
    runs = {run for _, run in used}
    for run in set(old.values()) - runs:
        documents.remove(buckets.spark, buckets.folder(run))
    gone = {slot: run for slot, run in old.items() if run in runs and (slot, run) not in used}
    for folder in buckets.folders(gone):
        documents.remove(buckets.spark, folder)


def size(buckets: Buckets, held: Held) -> int:
    """Bytes of the given buckets."""
    return sum(documents.size(buckets.spark, folder) for folder in buckets.folders(held))
