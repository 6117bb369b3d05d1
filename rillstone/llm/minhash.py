"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Every document's set of word shingles is hashed once; its sketch is the K smallest
   values. Documents with equal sets form a class, and one row stands for it.
2. Inverted lists of retained values. Two sets with a Jaccard index at the threshold share
   at least S of their retained values (five standard deviations below what is expected;
   exactly what follows from their sizes where sketches are whole sets), so that one of
   the rarest ``K - S + 1`` values of either is in both. Only those are listed: values that
   many documents share (common lines, passages) drop out by their frequency, and a
   document with enough values of its own has no entry at all.
3. The members of a list are compared where they are, and the sketch of the union
   estimates the index of each pair. No pair leaves its task: the result is each member's
   smallest partner, and what hangs together becomes a family of candidates.
4. Within a family, links are confirmed on full sets, again within a task. Lists and
   families beyond ``BLOCK`` members are compared in pairs of blocks, each a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.graph import components
from rillstone.llm.shared import LOWER, UPPER, Words, batches, cut, mix, runs, shingles, table

#: Values in a sketch.
K = 48
#: Text that is turned into shingles at a time.
BATCH_BYTES = 4 << 20
#: Members of a list or a family that one task compares with as many others.
BLOCK = 512
SKETCH = "doc_id long, n long, high long, low long, sketch array<long>"


def _sets(texts: list, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts)
    hashes, of = shingles(words, size)
    edge = np.searchsorted(of, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        yield np.unique(hashes[edge[i] : edge[i + 1]])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))


def _prints(sets: list[np.ndarray]) -> list[pa.Array]:
    """128 bits that tell sets apart, as two columns."""
    salt = np.uint64(0xA0761D6478BD642F)
    return [
        pa.array(np.array([mix(s ^ x).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64))
        for x in (np.uint64(0), salt)
    ]


def sketches(docs: DataFrame, size: int = 5) -> DataFrame:
    """``n``, the number of distinct shingles, a 128-bit print of their set, and the sketch."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text", BATCH_BYTES):
            sets = list(_sets(batch.column("text").to_pylist(), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *_prints(sets),
                    _lists([s[:K] for s in sets]),
                ],
                names=["doc_id", "n", "high", "low", "sketch"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return narrow.mapInArrow(run, SKETCH)


def full_sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id``, the print of the set as in ``sketches``, and all distinct hashes."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text", BATCH_BYTES):
            sets = list(_sets(batch.column("text").to_pylist(), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *_prints(sets), _lists(sets)], names=["doc_id", "high", "low", "full"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, high long, low long, full array<long>")


def least_shared(percent: int) -> int:
    """Values of K that sketches of similar sets share, but for five standard deviations."""
    p = percent / 100
    return int(K * p - 5 * (K * p * (1 - p)) ** 0.5)


def _shared(n: Column, percent: int) -> Column:
    """Values that a sketch of a set of ``n`` shares with that of any similar set, at least.

    Sketches of sets small enough that no similar set exceeds K are whole sets.
    """
    exact = F.ceil(n * percent / F.lit(100.0))
    return F.when(n <= K * percent // 100, exact).otherwise(F.lit(least_shared(percent))).cast("int")


def _inverted(classes: DataFrame, percent: int) -> DataFrame:
    """``value`` and ``node`` for the rarest values of each sketch that others share too."""
    values = classes.select("node", F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    listed = (
        values.join(common, "value")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
        .join(classes.select("node", "n"), "node")
    )  # at most K values for each node
    held = F.least(F.col("n"), F.lit(K))
    rarest = F.size("shared") - _shared(F.col("n"), percent) + 1  # after those that nobody shares
    entries = (
        listed.where(F.col("n") > 0)
        .withColumn("take", F.least(rarest, held).cast("int"))
        .where("take > 0")
        .select("node", F.explode(F.slice("shared", F.lit(1), F.col("take"))).alias("x"))
        .select("node", F.col("x.value").alias("value"))
    )
    several = entries.groupBy("value").agg(F.count("*").alias("m")).where("m > 1").select("value")
    return entries.join(several, "value")


def _overlaps(sets: list[np.ndarray], left: int) -> np.ndarray:
    """How many values each of the first ``left`` sets shares with each of all sets."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(values := np.concatenate(sets), kind="stable")
    values, of = values[order], of[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(fresh) - 1
    held = np.bincount(column)
    several = held[column] > 1  # what one set holds alone is shared with none
    column, of = np.unique(column[several], return_inverse=True)[1], of[several]
    out = np.zeros((left, len(sets)), dtype=np.float32)  # exact below 2**24
    wide = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, wide, 4096):
        low, high = np.searchsorted(column, (at, at + 4096))
        has = np.zeros((len(sets), min(4096, wide - at)), dtype=np.float32)
        has[of[low:high], column[low:high] - at] = 1
        out += has[:left] @ has.T
    return out


def _linked(sets: list[np.ndarray], left: int, near, sure=None) -> np.ndarray:
    """The component of each set, by the links between the first ``left`` and all.

    ``near(overlaps, i)`` says which sets are near set i; ``sure(i, j)``, if given, has
    the last word on pairs that are not in one component yet.
    """
    part = np.arange(len(sets))
    overlaps = _overlaps(sets, left)
    for i in range(left):
        close = np.flatnonzero(near(overlaps[i], i) & (part != part[i]))
        if sure is None:
            part[np.isin(part, part[close])] = part[i]
            continue
        while len(close):
            j, close = close[0], close[1:]
            if sure(i, j):
                part[part == part[j]] = part[i]
                close = close[part[close] != part[i]]
    return part


def _shared_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Values that a sketch of a set of ``n`` shares with that of any similar set, at least.

    Sketches of sets small enough that no similar set exceeds K are whole sets.
    """
    return np.where(n <= K * percent // 100, -(-n * percent // 100), least_shared(percent))


def _by_sketch(n: np.ndarray, sets: list[np.ndarray], left: int, percent: int) -> np.ndarray:
    need = np.minimum(_shared_of(n, percent), least_shared(percent))

    def near(overlap: np.ndarray, i: int) -> np.ndarray:
        sizes = np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent
        return sizes & (overlap >= np.minimum(need, need[i]))

    def sure(i: int, j: int) -> bool:
        union = np.union1d(sets[i], sets[j])[:K]
        both = np.intersect1d(sets[i], sets[j], assume_unique=True)
        return int((both <= union[-1]).sum()) >= min(need[i], need[j])

    return _linked(sets, left, near, sure)


def _by_set(n: np.ndarray, sets: list[np.ndarray], left: int, percent: int) -> np.ndarray:
    def near(overlap: np.ndarray, i: int) -> np.ndarray:
        shared = overlap.astype(np.int64)
        return shared * 100 >= (n + n[i] - shared) * percent

    return _linked(sets, left, near)


def _compared(rows: DataFrame, key: str, percent: int, compare) -> DataFrame:
    """Edges ``u``, ``v`` that ``compare`` finds among the rows of each key.

    Rows have ``node``, ``n`` and ``hashes``. A key with more than ``BLOCK`` rows is dealt
    into blocks, and every pair of its blocks is compared in a group of its own.
    """
    held = rows.groupBy(key).agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        rows.join(held, key).withColumn("mine", mine).withColumn("other", other)
        .select(
            F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")).alias("task"),
            F.col(key).alias("key"), F.least("mine", "other").alias("i"),
            F.greatest("mine", "other").alias("j"), "mine", "node", "n", "hashes",
        )
        .repartition("task")
        .sortWithinPartitions("task", "key", "i", "j", "mine")
    )

    def group(whole: pa.Table) -> pa.RecordBatch:
        node, n = whole["node"].to_numpy(), whole["n"].to_numpy()
        sets = [np.asarray(x).view(np.uint64) for x in whole["hashes"].to_numpy()]
        i, mine = whole["i"].to_numpy(), whole["mine"].to_numpy()
        part = compare(n, sets, int((mine == i).sum()), percent)
        order = np.lexsort((node, part))
        head = np.concatenate([[True], part[order][1:] != part[order][:-1]])
        least = node[order][head][np.cumsum(head) - 1]
        apart = node[order] != least
        return pa.RecordBatch.from_arrays(
            [pa.array(node[order][apart]), pa.array(least[apart])], names=["u", "v"]
        )

    def run(rows_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for whole in runs(rows_, ("key", "i", "j")):
            if whole.num_rows > 1:
                waiting.append(group(whole))
            if len(waiting) >= 1000:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting = []
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each document.

    Links are pairs whose Jaccard index is ``percent`` hundredths or more.

    Shingles are runs of ``size`` words (parted by ASCII white space, A to Z in lower
    case); a text with fewer words is one shingle. Texts without words, null ones too,
    and rows without an id are linked with nothing and kept. ``component_id`` is the
    smallest id that links can reach. Rows that share an id are one document: its first
    set in the order of prints counts. Columns other than the id and the text are left out.
    """
    known = cut(sketches(docs, size))
    named = known.where("n > 0 and doc_id is not null")
    members = named.groupBy("high", "low").agg(F.min("doc_id").alias("node"))
    classes = cut(
        named.join(members, ["high", "low"]).where("doc_id = node")
        .groupBy("node").agg(F.min(F.struct("high", "low", "n", "sketch")).alias("x"))
        .select("node", "x.*")
    )
    lists = cut(_inverted(classes, percent))

    sketched = lists.join(classes.select("node", "n", F.col("sketch").alias("hashes")), "node")
    family = cut(components(_compared(sketched, "value", percent, _by_sketch)))
    heads = family.select(F.col("root").alias("node"), "root").distinct()
    family = family.union(heads).withColumnRenamed("root", "family")

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    texts = text.join(family.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    full = full_sets(texts, size).join(family.withColumnRenamed("node", "doc_id"), "doc_id")
    # an id with several texts stands for the one whose set is its class's
    of_class = classes.select(F.col("node").alias("doc_id"), "high", "low")
    full = (
        full.join(of_class, ["doc_id", "high", "low"])
        .dropDuplicates(["doc_id"])
        .select("family", F.col("doc_id").alias("node"), F.size("full").cast("long").alias("n"), F.col("full").alias("hashes"))
    )
    roots = components(_compared(full, "family", percent, _by_set))
    found = (
        members.join(roots, "node", "left")
        .select("high", "low", F.coalesce("root", "node").alias("component_id"))
    )
    linked = known.join(found, ["high", "low"], "left")
    alone = F.col("component_id").isNull() | F.col("doc_id").isNull() | (F.col("n") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a Jaccard index of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The same in SQL: all pairs that share a shingle, and what they reach.
ORACLE_OP9 = f"""
with recursive doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
shingle as (
  select distinct doc_id, unnest(case
    when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from doc),
size as (select doc_id, count(*) as n from shingle group by doc_id),
pair as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingle a join shingle b using (s)
  where a.doc_id <> b.doc_id group by all),
link as (
  select x, y from pair join size p on p.doc_id = x join size q on q.doc_id = y
  where 100 * c >= 85 * (p.n + q.n - c)),
reach(x, y) as (select doc_id, doc_id from doc union select reach.x, link.y from reach join link on reach.y = link.x),
root as (select x, min(y) as component_id from reach group by x)
select doc.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc.doc_id = component_id as kept
from doc left join size using (doc_id) join root on x = doc.doc_id
"""
