"""Near-duplicate vectors by binary codes of random rotations.

A unit vector is rotated at random and kept as one sign bit for each dimension, with one
correction factor, the inner product of the vector and its code. The code's inner
product with another rotated vector, over the factor, is an unbiased estimate of
the cosine; its error has a standard deviation known from the factor and the cosine, so
that pairs whose estimate falls below the confidence bound of the threshold are dropped, and
all others are computed exactly, in double precision.

Bits of the codes also make buckets: as many tables as it takes for a pair at the
threshold to meet in one with probability ``RECALL``. Small labels are compared whole. A
bucket beyond ``BLOCK`` vectors is compared in pairs of blocks, each a task. Pairs stay in
their task: what leaves it is each vector's number of links, and its smallest partner. A
pair that meets in several tables counts in the first of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.graph import components
from rillstone.llm.shared import cut, runs, table

#: Probability that a pair at the threshold meets in a bucket.
RECALL = 0.9999
#: Standard deviations of the estimate that a pair may fall below the threshold.
CONFIDENCE = 6.0
#: Vectors that a bucket is meant to have at most, and that one task compares with as many.
BUCKET, BLOCK = 2048, 1024
#: Pairs that are recomputed at a time.
PAIRS = 1 << 18


def tables_needed(bits: int, threshold: float, recall: float = RECALL) -> int:
    """Tables of ``bits`` bits each in which a pair at the threshold meets at least once."""
    if not bits:
        return 1
    equal = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - equal))


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A uniformly random rotation, the same on every machine."""
    gauss = np.random.default_rng([seed, dimension]).standard_normal((dimension, dimension))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def bucket_codes(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """For each vector and table, ``bits`` sign bits of rotations made for buckets."""
    if not bits:
        return np.zeros((len(unit), tables), dtype=np.int64)
    dimension = unit.shape[1]
    signs = [
        unit @ rotation(dimension, 1 + r).T >= 0 for r in range(-(-bits * tables // dimension))
    ]
    all_ = np.concatenate(signs, axis=1)[:, : bits * tables].reshape(len(unit), tables, bits)
    return all_ @ (1 << np.arange(bits, dtype=np.int64))


def _units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = np.array([np.asarray(x, dtype=np.float64) for x in column.to_numpy(zero_copy_only=False)])
    # by the largest component first: squares of very small or large ones are no numbers
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _bound(factor: np.ndarray, dimension: int, threshold: float) -> np.ndarray:
    """The least estimate that a pair at the threshold gives, but for CONFIDENCE deviations."""
    spread = np.sqrt((1 - threshold**2) * np.maximum(0, 1 - factor**2) / max(1, dimension - 1)) / factor
    return threshold - CONFIDENCE * spread


def links(unit: np.ndarray, left: int, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of the first ``left`` vectors with the rest, or among all if ``same``."""
    dimension = unit.shape[1]
    rotated = (unit @ rotation(dimension, 0).T).astype(np.float32)
    code = np.where(rotated >= 0, 1, -1).astype(np.int8)  # a bit each; the scale is in the factor
    factor = np.abs(rotated).sum(axis=1) / math.sqrt(dimension)
    floor = (_bound(factor.astype(np.float64), dimension, threshold) - 1e-5).astype(np.float32)
    for low in range(0, left, 256):
        some = slice(low, min(low + 256, left))
        estimate = (code[some].astype(np.float32) @ rotated.T) / (factor[some, None] * math.sqrt(dimension))
        i, j = np.nonzero(estimate >= floor[some, None])
        i += low
        wanted = j > i if same else j >= left
        i, j = i[wanted], j[wanted]
        for at in range(0, len(i), PAIRS):
            a, b = i[at : at + PAIRS], j[at : at + PAIRS]
            exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            yield a[exact], b[exact]


def _partition(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches along the links."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def _usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and all components finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(
        ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0) & (F.size(vector) > 0), F.lit(False)
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, bucket: int = BUCKET, recall: float = RECALL
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row of ``vec_id``, ``embedding``, ``label``.

    Vectors are compared when their labels are equal and not null and they have as many
    components. Null or zero vectors, those with null or non-finite components and
    rows without an id link with nothing. Equal vectors of a label are linked with each
    other, one stands for all of them, and each counts. Other columns are left out.

    Labels of more than ``bucket`` vectors are compared within buckets, in which a pair at the
    threshold meets with probability ``recall``; with a recall of 1 they are compared whole, by
    blocks, and no link can be missed but by the confidence bound.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _usable(F.col("embedding"))
    rows = cut(rows.withColumn("usable", usable))
    classes = cut(
        rows.where("usable").groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    )
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = 0 if recall >= 1 else max(0, math.ceil(math.log2(max(1, largest) / bucket)))
    tables = tables_needed(bits, threshold, recall)
    found = _compared(classes, bits, tables, threshold)

    more = found.groupBy("id", "label").agg(F.sum("links").alias("links"))
    # classes are nodes; an id that several vectors share is one node
    roots = components(found.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v")))
    of_class = (
        classes.join(more, ["id", "label"], "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("label").alias("l"), F.col("embedding").alias("e"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
            F.coalesce("root", "id").alias("c"),
        )
    )
    same = rows["usable"] & (rows["label"] == of_class["l"]) & (rows["embedding"] == of_class["e"])
    component = F.coalesce("c", "vec_id")
    return rows.join(of_class, same, "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _compared(classes: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """For each vector and bucket in which it has links: their number, and a smaller node."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(x) for x in batch.column("embedding").to_numpy(zero_copy_only=False)], dtype=np.int64)
            codes: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                for i, row in zip(at, bucket_codes(_units(batch.column("embedding").take(pa.array(at))), bits, tables)):
                    codes[i] = row.tolist()
            yield batch.append_column("codes", pa.array(codes, pa.list_(pa.int64())))

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("id", "label", "embedding", "copies").mapInArrow(
        place, f"id long, label {kind}, embedding {classes.schema['embedding'].dataType.simpleString()}, copies long, codes array<long>"
    )
    each = placed.select("*", F.posexplode("codes").alias("t", "code")).withColumn(
        "key", F.xxhash64("label", F.size("embedding"), "t", "code")
    )
    held = each.groupBy("key").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("id", "embedding"), F.col("blocks")).cast("int")
    dealt = (
        each.join(held, "key").withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
        .withColumn("task", F.xxhash64("key", "i", "j"))
        .select("task", "key", "i", "j", "mine", "t", "id", "label", "embedding", "copies", "codes")
        .repartition("task")
        .sortWithinPartitions("task", "key", "i", "j", "mine")
    )

    def group(whole: pa.Table) -> pa.RecordBatch | None:
        unit = _units(whole["embedding"])
        node, copies = whole["id"].to_numpy(), whole["copies"].to_numpy()
        i, j, mine = (whole[c].to_numpy() for c in ("i", "j", "mine"))
        t, codes = int(whole["t"][0].as_py()), np.array(whole["codes"].to_pylist())
        count = np.zeros(len(node), dtype=np.int64)
        first, second = [], []
        for a, b in links(unit, int((mine == i).sum()), bool(i[0] == j[0]), threshold):
            fresh = ~(codes[a, :t] == codes[b, :t]).any(axis=1)  # not met in an earlier table
            np.add.at(count, a, copies[b] * fresh)
            np.add.at(count, b, copies[a] * fresh)
            first.append(a), second.append(b)
        if not first or not sum(map(len, first)):
            return None
        order = np.argsort(node, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        root = _partition(len(node), rank[np.concatenate(first)], rank[np.concatenate(second)])
        least = node[order][root][rank]
        tell = (count > 0) | (least != node)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[tell]), whole["label"].combine_chunks().filter(pa.array(tell)), pa.array(count[tell]), pa.array(least[tell])],
            names=["id", "label", "links", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in runs(batches, ("key", "i", "j")):
            if whole.num_rows > 1 and (out := group(whole)) is not None:
                yield out

    return cut(dealt.mapInArrow(run, f"id long, label {kind}, links long, root long"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between all embeddings of equal labels at a cosine of 0.98."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: The same in SQL: exact cosines of all pairs of a label.
ORACLE_OP3 = """
with recursive v as (
  select vec_id, label, [x::double for x in embedding] as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
    and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) as (select vec_id, vec_id from v union select reach.x, link.y from reach join link on reach.y = link.x)
select e.vec_id, coalesce(n, 0)::bigint as n_links, coalesce(c, e.vec_id) as component_id, e.vec_id = coalesce(c, e.vec_id) as kept
from embeddings e left join (select x, count(*) as n from link group by x) l on l.x = e.vec_id
left join (select x, min(y) as c from reach group by x) r on r.x = e.vec_id
"""
