"""Whitening of embeddings: principal components scaled to unit variance.

Vectors are integers. Their sums, and the sums of products of all pairs of components,
are exact: products are taken after centring at the rounded mean, and what the rounding
leaves is subtracted exactly at the end. Tasks send a triangle of numbers each, whatever the
rows; the driver holds one matrix of the components, not of the vectors.

The centred scatter is factored by Cholesky's method with the largest remaining diagonal
element as pivot. One-sided Jacobi rotations then act on the columns of that triangular
factor until they are orthogonal to each other: their squared norms are the eigenvalues
and the normalised columns the components. Neither step squares the factor, so that small
eigenvalues keep their relative accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import table

#: Components are multiplied by the one, rounded down, and moved by the other.
SCALE, OFFSET = 1024, 100_000
#: Scaled components beyond this, either way, count as this.
MOST = 1 << 31
#: Rotations stop at columns whose cosine is below this; sweeps over all pairs, at most.
ORTHOGONAL, SWEEPS = 1e-15, 60
#: Rows that are worked on at a time.
ROWS = 8192


# -- the decomposition ----------------------------------------------------------------


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A factor with ``a = f f^T``, and the order of rows in which it is lower triangular.

    The factor has as many columns as the matrix has rank, to rounding.
    """
    size = len(a)
    left = a.diagonal().astype(np.float64).copy()
    least = size * np.finfo(np.float64).eps * max(0.0, left.max(initial=0.0))
    factor, order = np.zeros((size, size)), []
    for k in range(size):
        pivot = int(np.argmax(left))
        if not left[pivot] > least:
            break
        column = (a[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[order] = 0.0
        column[pivot] = np.sqrt(left[pivot])
        factor[:, k] = column
        left -= column * column
        order.append(pivot)
        left[order] = -np.inf
    rest = [i for i in range(size) if i not in set(order)]
    return factor[:, : len(order)], np.array(order + rest, dtype=np.int64)


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns, rotated in pairs until each is orthogonal to every other."""
    columns = np.ascontiguousarray(factor.T)  # a row for each column
    for _ in range(SWEEPS):
        turned = False
        for p in range(len(columns) - 1):
            for q in range(p + 1, len(columns)):
                x, y = columns[p], columns[q]
                alpha, beta, gamma = x @ x, y @ y, x @ y
                if abs(gamma) <= ORTHOGONAL * np.sqrt(alpha * beta):
                    continue
                turned = True
                zeta = (beta - alpha) / (2 * gamma)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                columns[p], columns[q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    return columns.T


class Components(NamedTuple):
    """Eigenvalues, falling, and their unit vectors as columns."""

    values: np.ndarray
    vectors: np.ndarray


def decompose(covariance: np.ndarray) -> Components:
    """Components of all eigenvalues above rounding; the largest entry of each is positive."""
    factor, order = pivoted_cholesky(covariance)
    rotated = np.empty_like(factor)
    rotated[order] = one_sided_jacobi(factor[order])
    norms = np.linalg.norm(rotated, axis=0)
    by = np.argsort(-norms, kind="stable")
    vectors = rotated[:, by] / norms[by]
    if vectors.size:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(by))])
    return Components(norms[by] ** 2, vectors)


# -- sums over all vectors ------------------------------------------------------------


def _whole(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors as integers; the caller has left out all that cannot be."""
    with np.errstate(over="ignore"):
        values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64) * SCALE
    return np.floor(np.clip(values, -MOST, MOST)).astype(np.int64) + OFFSET


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns, as Python integers.

    Sums of products below 2^53 are exact in floating point; larger numbers are split in two.
    """
    if not y.size or int(np.abs(y).max()) ** 2 * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    high, low = (y >> 17).astype(np.float64), (y & 0x1FFFF).astype(np.float64)
    hh, hl, ll = high.T @ high, high.T @ low, low.T @ low
    hh, hl, ll = (m.astype(np.int64).astype(object) for m in (hh, hl, ll))
    return (hh << 34) + ((hl + hl.T) << 17) + ll


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(x) if x < 10**38 else None for x in values], pa.decimal128(38, 0))


class Fit(NamedTuple):
    """What all vectors have in common."""

    count: int
    near: np.ndarray  # the mean, rounded
    rest: np.ndarray  # sums of what is left after subtracting it, as Python integers
    components: Components
    trace: float


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id`` and ``embedding`` of rows that can be whitened, and their number of components.

    That number is the most frequent one among vectors without null or non-finite entries,
    the larger one if two are as frequent.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = F.coalesce((F.size("embedding") > 0) & ~F.exists("embedding", bad), F.lit(False))
    rows = vectors.select("vec_id", "embedding").where(whole)
    lengths = rows.groupBy(F.size("embedding").alias("d")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dimension = first[0][0] if first else 0
    return rows.where(F.size("embedding") == dimension), dimension


def _column_sums(rows: DataFrame, dimension: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(dimension, dtype=np.int64)
        for batch in _slices(batches):
            x = _whole(batch.column("embedding"), dimension)
            count, total = count + len(x), total + x.sum(axis=0)
        names = np.arange(-1, dimension, dtype=np.int32)  # -1: the count
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([count, *total.tolist()])], names=["d", "x"])

    parts = rows.select("embedding").mapInArrow(run, "d int, x long")
    held = dict(parts.groupBy("d").agg(F.sum(F.col("x").cast("decimal(38,0)"))).collect())  # dimension + 1 rows
    return int(held.get(-1, 0)), [int(held.get(d, 0)) for d in range(dimension)]


def _scatter(rows: DataFrame, dimension: int, near: np.ndarray) -> np.ndarray:
    """Exact sums of products after centring at ``near``."""
    i, j = np.triu_indices(dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension), dtype=object)
        for batch in _slices(batches):
            total = total + products(_whole(batch.column("embedding"), dimension) - near)
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(total[i, j].tolist())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "x"])

    parts = rows.select("embedding").mapInArrow(run, "i int, j int, x decimal(38,0)")
    out = np.zeros((dimension, dimension), dtype=object)
    for a, b, x in parts.groupBy("i", "j").agg(F.sum("x")).collect():  # half of dimension squared
        out[a, b] = out[b, a] = int(x)
    return out


def fit(rows: DataFrame, dimension: int) -> Fit | None:
    """Mean and components of all rows; none without rows."""
    count, sums = _column_sums(rows, dimension) if dimension else (0, [])
    if not count:
        return None
    near = np.array([(2 * s + count) // (2 * count) for s in sums], dtype=np.int64)
    rest = np.array([s - count * int(c) for s, c in zip(sums, near)], dtype=object)
    exact = count * _scatter(rows, dimension, near) - np.outer(rest, rest)  # count squared times the covariance
    covariance = np.array([[x / count**2 for x in row] for row in exact.tolist()])
    trace = sum(exact.diagonal().tolist()) / count**2
    return Fit(count, near, rest, decompose(covariance), trace)


def _projected(y: np.ndarray, model: Fit, most: int) -> np.ndarray:
    """Whitened values of vectors centred at the rounded mean."""
    values, vectors = model.components.values[:most], model.components.vectors[:, :most]
    left = np.array([r / model.count for r in model.rest.tolist()])
    return (y - left) @ vectors / np.sqrt(values)


def _identity_error(rows: DataFrame, dimension: int, model: Fit, most: int) -> float:
    """The largest entry of the covariance of whitened rows minus the identity."""
    kept = min(most, len(model.components.values))
    i, j = np.triu_indices(kept + 1)  # the last one stands for the constant 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept + 1, kept + 1))
        for batch in _slices(batches):
            w = _projected(_whole(batch.column("embedding"), dimension) - model.near, model, most)
            w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
            total += w.T @ w
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "x"])

    parts = rows.select("embedding").mapInArrow(run, "i int, j int, x double")
    sums = np.zeros((kept + 1, kept + 1))
    for a, b, x in parts.groupBy("i", "j").agg(F.sum("x")).collect():  # at most 45 rows for 8 components
        sums[a, b] = sums[b, a] = x
    mean = sums[:kept, kept] / model.count
    found = sums[:kept, :kept] / model.count - np.outer(mean, mean)
    return float(np.abs(found - np.eye(kept)).max(initial=0.0))


def deviations(y: np.ndarray, model: Fit) -> list[int]:
    """For each row, the sum over components of (n x - S)^2, exactly."""
    n, rest = model.count, model.rest
    most = n * int(np.abs(y).max(initial=0)) + max((abs(int(r)) for r in rest), default=0)
    if most**2 * y.shape[1] < 1 << 63:
        gap = y * n - rest.astype(np.int64)
        return np.einsum("ij,ij->i", gap, gap).tolist()
    gap = y.astype(object) * n - rest
    return (gap * gap).sum(axis=1).tolist()


def whiten(vectors: DataFrame, most: int = 8) -> DataFrame:
    """A row for each usable vector of ``vec_id``, ``embedding`` and each of ``most`` components.

    Null and empty vectors, those with null or non-finite entries, and those of another
    length than most have are left out; entries count as floor(1024 c) + 100000, where
    1024 c beyond 2^31 either way counts as that. Repeated rows and rows without an id are
    vectors like all others. Components without variance cannot be scaled and have no rows:
    equal vectors, a single one or an empty table give an empty result. Other columns
    are left out.

    Returned: ``vec_id``, ``component`` from 1, ``n`` (vectors), ``deviation``, ``whitened``,
    ``explained`` (share of the variance), ``identity_error`` (the largest entry of the
    whitened covariance minus the identity, measured over all rows), ``deviation_exact``.
    Where ``deviation`` exceeds a long it is null, and ``deviation_exact`` has it.
    """
    if most < 1:
        raise ValueError("at least one component")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, deviation_exact decimal(38,0)"
    )
    rows, dimension = usable(vectors)
    model = fit(rows, dimension)
    if model is None or not len(model.components.values):
        return vectors.sparkSession.createDataFrame([], schema)
    kept = min(most, len(model.components.values))
    explained = model.components.values[:kept] / model.trace
    error = _identity_error(rows, dimension, model, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            y = _whole(batch.column("embedding"), dimension) - model.near
            far, size = deviations(y, model), len(y) * kept
            each = np.repeat(np.arange(len(y)), kept)
            long_ = pa.array([x if x < 1 << 63 else None for x in far], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(y))),
                    pa.array(np.full(size, model.count, dtype=np.int64)),
                    long_.take(pa.array(each)),
                    pa.array(_projected(y, model, most).ravel()),
                    pa.array(np.tile(explained, len(y))),
                    pa.array(np.full(size, error)),
                    _decimals(far).take(pa.array(each)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    return rows.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight largest components, each of unit variance."""
    return whiten(table(spark, sf_dir, "embeddings"))
