"""Centroid clustering over a vector approximation file.

Vectors are integers. Each component is also kept as the number of a cell, a few bits; the
cells of all components, packed, are the approximation of a vector. For a set of
centroids, lookup tables hold what a component in a cell adds to the distance at
least and at most, so that the sums over a vector's cells bound its distance to each centroid.
Where one centroid's interval ends before all others begin, the vector is assigned; the vector
itself is fetched only where intervals overlap.

Distances are taken relative to a common middle point m: |v-c|² - |v-m|² is linear in v,
has the same order over the centroids as the distance, and far narrower intervals.

The file is a written table in pages. Pages hold vectors of one first centroid and of similar
margin to the next one, so that undecided vectors gather in few pages. A round has two
narrow scans: the cells alone tell which pages hold vectors that intervals leave open, or that
change their centroid; of these pages the vectors are read, and the exact changes of each
centroid's count and sums come back, a few numbers for each task. A vector that did not move
changes nothing, so that a page may be read without need, but none is left out. No round
keeps state outside the centroids, their counts and sums.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import cut, table
from rillstone.workspace import new_folder

#: Components are multiplied by this and rounded down.
SCALE = 1024
#: Scaled components beyond this, either way, count as this, so that all sums of squares of
#: up to 128 components fit 64 bits.
MOST = 1 << 26
#: Bits of a cell.
BITS = 6
#: Standard deviations from the mean over which the inner cells are spread.
SPREAD = 2.2
#: Vectors of a page at least; a page has the square root of all vectors if that is more, so
#: that neither pages nor their number grow in proportion to the table.
PAGE = 4096
#: Ranges of pages that one scan names at most; neighbouring ones are joined beyond that.
RANGES = 64


class Cells(NamedTuple):
    """The cells of each component, by component and cell."""

    edges: np.ndarray  # from which value on each cell but the first begins
    low: np.ndarray  # smallest value of each cell
    high: np.ndarray  # largest value of each cell
    middle: np.ndarray  # the common point that distances are relative to


def make_cells(low: np.ndarray, high: np.ndarray, mean: np.ndarray, deviation: np.ndarray, bits: int) -> Cells:
    """Equal steps around the mean; the outer cells reach to the smallest and largest value."""
    at = np.linspace(-SPREAD, SPREAD, (1 << bits) - 1)
    edges = np.ceil(mean[:, None] + deviation[:, None] * at[None, :]).astype(np.int64)
    begin = np.concatenate([np.minimum(low, edges[:, 0])[:, None], edges], axis=1)
    end = np.concatenate([edges - 1, np.maximum(high, edges[:, -1])[:, None]], axis=1)
    return Cells(edges, begin, end, np.rint(mean).astype(np.int64))


def cell_numbers(cells: Cells, vectors: np.ndarray) -> np.ndarray:
    """The cell of every component of every vector."""
    out = np.empty(vectors.shape, dtype=np.uint8)
    for d, edges in enumerate(cells.edges):
        out[:, d] = np.searchsorted(edges, vectors[:, d], side="right")
    return out


def pack(numbers: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` of each number, side by side."""
    each = np.unpackbits(numbers[:, :, None], axis=2)[:, :, 8 - bits :]
    return np.packbits(each.reshape(len(numbers), -1), axis=1)


def unpack(packed: np.ndarray, bits: int, dimension: int) -> np.ndarray:
    each = np.unpackbits(packed, axis=1)[:, : bits * dimension].reshape(len(packed), dimension, bits)
    return np.packbits(each, axis=2)[:, :, 0] >> (8 - bits)


def lookup(cells: Cells, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid, component and cell: the least and the largest share of the distance."""
    minus, plus = cells.middle - centroids, (cells.middle + centroids)[:, :, None]
    at = [minus[:, :, None] * (2 * value[None] - plus) for value in (cells.low, cells.high)]
    return np.minimum(*at), np.maximum(*at)


def intervals(numbers: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the relative distance of each vector to each centroid."""
    flat = numbers.astype(np.int64) + np.arange(numbers.shape[1]) * tables[0].shape[2]
    return tuple(np.stack([t.ravel()[flat].sum(axis=1) for t in side], axis=1) for side in tables)


def decided(numbers: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The nearest centroid of each vector, or -1 where intervals overlap."""
    low, high = intervals(numbers, tables)
    best = high.argmin(axis=1)
    rows = np.arange(len(numbers))
    upto = high[rows, best]
    low[rows, best] = np.iinfo(np.int64).max
    return np.where((upto[:, None] < low).all(axis=1), best, -1)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    out = np.empty((len(vectors), len(centroids)), dtype=np.int64)
    for c, centroid in enumerate(centroids):
        gap = vectors - centroid
        np.einsum("ij,ij->i", gap, gap, out=out[:, c])
    return out


# -- tasks ----------------------------------------------------------------------------


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _scaled(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors as integers; the caller has left out all that cannot be."""
    with np.errstate(over="ignore"):
        values = _matrix(column, dimension).astype(np.float64) * SCALE
    return np.floor(np.clip(values, -MOST, MOST)).astype(np.int64)


def _packed(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(bytearray().join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _nested(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _usable(vectors: DataFrame, dimension: int) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that can be clustered."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = (F.size("embedding") == dimension) & ~F.exists("embedding", bad)
    return vectors.select("vec_id", "embedding").where(F.coalesce(kept, F.lit(False)))


def _sums(frame: DataFrame, tasks, centroids: int, dimension: int) -> np.ndarray:
    """Sums over all tasks of what each one yields: by centroid, its components and a count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((centroids, dimension + 1), dtype=np.int64)
        for batch in batches:
            total += tasks(batch)
        c, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(total[c, d])], names=["c", "d", "x"]
        )

    exact = F.sum(F.col("x").cast("decimal(38,0)"))
    out = np.zeros((centroids, dimension + 1), dtype=object)
    rows = frame.mapInArrow(run, "c int, d int, x long").groupBy("c", "d").agg(exact.alias("x"))
    for c, d, x in rows.collect():  # centroids * (dimension + 1) rows at most
        out[c, d] = int(x)
    return out


def _by_cluster(vectors: np.ndarray, cluster: np.ndarray, centroids: int) -> np.ndarray:
    out = np.zeros((centroids, vectors.shape[1] + 1), dtype=np.int64)
    for c in range(centroids):
        mine = vectors[cluster == c]
        out[c, :-1], out[c, -1] = mine.sum(axis=0), len(mine)
    return out


def _statistics(rows: DataFrame, dimension: int) -> tuple[int, np.ndarray]:
    """The number of vectors; smallest, largest value, mean and deviation of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            if batch.num_rows:
                v = _scaled(batch.column("embedding"), dimension)
                f = v.astype(np.float64)
                found.append((len(v), v.min(axis=0), v.max(axis=0), f.sum(axis=0), (f * f).sum(axis=0)))
        if found:
            n, low, high, s, ss = zip(*found)
            columns = [np.arange(dimension, dtype=np.int32), np.full(dimension, sum(n)), np.min(low, axis=0), np.max(high, axis=0)]
            columns += [np.sum(s, axis=0), np.sum(ss, axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["d", "n", "low", "high", "s", "ss"])

    parts = rows.mapInArrow(run, "d int, n long, low long, high long, s double, ss double")
    names = ("sum(n)", "min(low)", "max(high)", "sum(s)", "sum(ss)")
    total = parts.groupBy("d").agg(*[F.expr(x) for x in names]).collect()  # a row for each component
    if not total:
        return 0, np.empty((0, 4))
    n = total[0][1]
    by = np.array([[r[2], r[3], r[4] / n, math.sqrt(max(0.0, r[5] / n - (r[4] / n) ** 2))] for r in sorted(total)])
    return n, by


# -- clustering -----------------------------------------------------------------------


class File(NamedTuple):
    """The written table: ``page``, ``vec_id``, ``cells``, ``v``."""

    rows: DataFrame
    cells: Cells
    bits: int
    dimension: int


def write_file(
    rows: DataFrame, count: int, cells: Cells, centroids: np.ndarray, bits: int, least: int = PAGE
) -> File:
    """Write vectors with their cells, in pages of similar assignment to the given centroids."""
    dimension = centroids.shape[1]
    kind = rows.schema["vec_id"].dataType.simpleString()

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _scaled(batch.column("embedding"), dimension)
            far = distances(v, centroids)
            nearest = far.argmin(axis=1)
            two = np.partition(far, 1, axis=1) if len(centroids) > 1 else np.concatenate([far, far], axis=1)
            packed = pack(cell_numbers(cells, v), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), pa.array([x.tobytes() for x in packed], pa.binary()),
                    _nested(v.astype(np.int32)), pa.array(nearest.astype(np.int32)), pa.array(two[:, 1] - two[:, 0]),
                ],
                names=["vec_id", "cells", "v", "nearest", "margin"],
            )

    placed = rows.mapInArrow(approximate, f"vec_id {kind}, cells binary, v array<int>, nearest int, margin long")
    pages = -(-count // max(least, math.isqrt(count)))
    # the hash deals out equal vectors, however many there are
    any_ = F.xxhash64(F.monotonically_increasing_id())
    placed = placed.withColumn("any", any_)
    paged = placed.repartitionByRange(pages, "nearest", "margin", "any") if pages > 1 else placed.coalesce(1)
    path = new_folder(rows.sparkSession, "vectors")
    paged.select(F.spark_partition_id().alias("page"), "vec_id", "cells", "v").write.partitionBy("page").parquet(path)
    schema = f"vec_id {kind}, cells binary, v array<int>, page int"
    return File(rows.sparkSession.read.schema(schema).parquet(path), cells, bits, dimension)


def open_pages(file: File, before: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """From the cells alone: pages and their numbers of vectors that are undecided or move."""
    old, new = lookup(file.cells, before), lookup(file.cells, after)
    bits, dimension = file.bits, file.dimension
    width = -(-bits * dimension // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = unpack(_packed(batch.column("cells"), width), bits, dimension)
            was, now = decided(numbers, old), decided(numbers, new)
            wanted = (now < 0) | (was != now)
            page, n = np.unique(batch.column("page").to_numpy()[wanted], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(page.astype(np.int32)), pa.array(n)], names=["page", "n"])

    found = file.rows.select("page", "cells").mapInArrow(run, "page int, n long").groupBy("page").agg(F.sum("n"))
    return sorted(tuple(r) for r in found.collect())  # a row for each page, of which there are few


def ranges(pages: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges that cover the pages; the narrowest gaps are closed until there are few."""
    if not pages:
        return []
    gaps = sorted(range(1, len(pages)), key=lambda i: pages[i - 1] - pages[i])
    cuts = sorted(i for i in gaps[: most - 1] if pages[i] - pages[i - 1] > 1)
    return [(pages[i], pages[j - 1]) for i, j in zip([0, *cuts], [*cuts, len(pages)])]


def _moves(file: File, pages: list[int], before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What the vectors of these pages change in each centroid's sums and count."""
    wanted = F.lit(False)
    for low, high in ranges(pages):
        wanted = wanted | F.col("page").between(low, high)
    k, dimension = len(after), file.dimension

    def task(batch: pa.RecordBatch) -> np.ndarray:
        v = _matrix(batch.column("v"), dimension).astype(np.int64)
        was, now = distances(v, before).argmin(axis=1), distances(v, after).argmin(axis=1)
        v, was, now = (x[was != now] for x in (v, was, now))
        return _by_cluster(v, now, k) - _by_cluster(v, was, k)

    return _sums(file.rows.where(wanted).select("v"), task, k, dimension)


def _updated(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Exact floored means; a centroid without vectors stays."""
    rows = [[int(s) // int(row[-1]) for s in row[:-1]] if row[-1] else old for old, row in zip(centroids.tolist(), sums)]
    return np.array(rows, dtype=np.int64)


def first_centroids(rows: DataFrame, k: int, seed: int, dimension: int) -> np.ndarray:
    """The vectors whose ids have the smallest salted hashes; null ids come last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    taken = rows.orderBy(order.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()  # k rows
    column = pa.array([r[0] for r in taken], pa.list_(pa.float64()))
    return _scaled(column, dimension) if taken else np.empty((0, dimension), dtype=np.int64)


def fit(file: File, start: np.ndarray, rounds: int) -> tuple[np.ndarray, list[int]]:
    """Centroids after the rounds, and the vectors in the pages that each round left open."""
    k, dimension = len(start), file.dimension

    def all_(batch: pa.RecordBatch) -> np.ndarray:
        v = _matrix(batch.column("v"), dimension).astype(np.int64)
        return _by_cluster(v, distances(v, start).argmin(axis=1), k)

    before, fetched = start, []
    sums = _sums(file.rows.select("v"), all_, k, dimension)
    after = _updated(start, sums)
    for _ in range(rounds - 1):
        if (before == after).all():
            break  # nothing moves any more
        found = open_pages(file, before, after)
        fetched.append(sum(n for _, n in found))
        if found:
            sums = sums + _moves(file, [page for page, _ in found], before, after)
        before, after = after, _updated(after, sums)
    return after, fetched


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dimension: int = 64, seed: int = 3, bits: int = BITS, page: int = PAGE
) -> DataFrame:
    """Assignments of the usable rows of ``vec_id``, ``embedding`` to ``k`` centroids.

    Null vectors, those of another length than ``dimension`` and those with null or non-finite
    components are left out; components count as floor(1024 x) and at most 2^26 either way.
    Repeated rows and rows without an id are vectors like all others; a null id is the last
    to start a centroid, and of equal ids the smaller vector is first. Fewer vectors than
    ``k`` make as many centroids; an empty table gives an empty result. Other columns are
    left out. Ties go to the smaller centroid.

    Returned: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia``, ``centroid_sha256`` of the final centroid's components joined by commas.
    """
    if k < 1 or rounds < 1 or not 1 <= bits <= 8 or not 1 <= dimension <= 128:
        raise ValueError("k and rounds must be positive, bits from 1 to 8 and dimension from 1 to 128")
    rows = _usable(vectors, dimension)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    count, by = _statistics(rows, dimension)
    if not count:
        names = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {names}")
    cells = make_cells(by[:, 0].astype(np.int64), by[:, 1].astype(np.int64), by[:, 2], by[:, 3], bits)
    start = first_centroids(rows, k, seed, dimension)
    file = write_file(rows, count, cells, start, bits, page)
    centroids, _ = fit(file, start, rounds)
    tables, width = lookup(cells, centroids), -(-bits * dimension // 8)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dimension).astype(np.int64)
            nearest = decided(unpack(_packed(batch.column("cells"), width), bits, dimension), tables)
            open_ = nearest < 0
            nearest[open_] = distances(v[open_], centroids).argmin(axis=1)
            gap = v - centroids[nearest]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(nearest.astype(np.int32)), pa.array(np.einsum("ij,ij->i", gap, gap))],
                names=["vec_id", "cluster", "distance"],
            )

    out = cut(file.rows.select("vec_id", "cells", "v").mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    held = {r[0]: r[1] for r in out.groupBy("cluster").agg(F.sum("distance")).collect()}  # a row for each centroid
    of = lambda values, kind: F.get(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster"))
    spelled = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return out.select(
        "vec_id", "cluster", "distance",
        of([held.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(held.values())).cast("long").alias("inertia"),
        of(spelled, "string").alias("centroid_sha256"),
    )


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings in 8 clusters, after 10 rounds."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle(k: int = 8, rounds: int = 10, dimension: int = 64, seed: int = 3) -> str:
    """The same in SQL: every round assigns all vectors and averages them."""
    steps = [f"""
  v as materialized (select row_number() over () as r, vec_id, [floor(1024 * x::double)::bigint for x in embedding] as v from embeddings
    where len(embedding) = {dimension} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  x as materialized (select r, unnest(v) as x, unnest(range({dimension})) as d from v),
  c0 as materialized (select c, unnest(v) as y, unnest(range({dimension})) as d from
    (select v, row_number() over (order by sha256('{seed}:' || vec_id) nulls last, v) - 1 as c from v) where c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
  a{i} as materialized (select r, c, s::bigint as s from
    (select r, c, s, row_number() over (partition by r order by s, c) as place from
      (select r, c, sum((x - y) * (x - y)) as s from x join c{i} using (d) group by r, c)) where place = 1)""")
        if i < rounds:
            steps.append(f"""
  c{i + 1} as materialized (select p.c, p.d, coalesce(m, p.y) as y from c{i} p left join
    (select c, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m from x join a{i} using (r) group by c, d) n
    on n.c = p.c and n.d = p.d)""")
    return f"""
with {",".join(steps)},
  h as (select c, sha256(string_agg(y::bigint::varchar, ',' order by d)) as h from c{rounds} group by c)
select vec_id, c::int as cluster, s as distance, (sum(s) over (partition by c))::bigint as cluster_inertia,
  (sum(s) over ())::bigint as inertia, h as centroid_sha256
from a{rounds} join v using (r) join h using (c)
"""


ORACLE_OP11 = _oracle()
