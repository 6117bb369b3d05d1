"""A uniform shuffle of documents into shards of exact sizes.

Rows lie in blocks, the partitions as they are read. A communication matrix says how many
rows of each block go to each shard; it is drawn from the hypergeometric law that a uniform
shuffle of all rows would give it. Each block then permutes its own rows and deals them out by
the matrix, and the rows of a shard, exchanged once, are permuted again. A shard of any
size is permuted by several tasks: a random part for each row, and a random order within the part,
make a random order of the whole. No task sees more than a block or a part, and the sizes of shards are
exact whatever the keys are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.shared import cut, table

#: Rows that a part of a shard is meant to have. The number of parts, each a task, grows with
#: the rows.
ROWS_PER_PART = 8192
#: Bytes of the matrix at most, which is broadcast: beyond it, neighbouring blocks are joined.
#: The same holds for where parts begin: beyond it, that table is not broadcast.
MOST_BYTES = 64 << 20
#: Rows up to which numpy draws from the law.
NUMPY_ROWS = 10**9


def hypergeometric(draw: float, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` rows are good, at the quantile ``draw`` of the exact law.

    Weights follow from the ratio of neighbouring probabilities, so that counts beyond
    those of the usual samplers work too.
    """
    low, high = max(0, taken - bad), min(taken, good)
    if low == high:
        return low
    total = good + bad
    mode = (taken + 1) * (good + 1) // (total + 2)
    spread = np.sqrt(taken * (good / total) * (bad / total) * max(1, total - taken) / max(1, total - 1))
    reach = int(9 * spread) + 40  # what lies beyond has less than 2^-53 of the weight
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    ratio = np.log(good - k) + np.log(taken - k) - np.log(k + 1) - np.log(bad - taken + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    below = np.cumsum(np.exp(weight - weight.max()))
    return first + int(np.searchsorted(below, draw * below[-1], side="right").clip(0, last - first))


def communication_matrix(rng: np.random.Generator, rows: list[int], columns: list[int]) -> np.ndarray:
    """Counts with the given sums of rows and columns, as a uniform shuffle gives them."""
    rows, columns = np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64)
    if rows.sum() != columns.sum():
        raise ValueError("rows and columns of the matrix must have the same sum")
    if len(rows) > 1 and columns.sum() >= NUMPY_ROWS:  # the upper half of the rows, then each half by itself
        half = len(rows) // 2
        upper = _dealt(rng, columns, int(rows[:half].sum()))
        halves = ((rows[:half], upper), (rows[half:], columns - upper))
        return np.concatenate([communication_matrix(rng, r, c) for r, c in halves])
    out = np.zeros((len(rows), len(columns)), dtype=np.int64)
    for i, taken in enumerate(rows[:-1]):
        out[i] = rng.multivariate_hypergeometric(columns, taken, method="marginals")
        columns = columns - out[i]
    out[-1:] = columns  # the last row gets what is left
    return out


def _dealt(rng: np.random.Generator, columns: np.ndarray, taken: int) -> np.ndarray:
    """How many rows of each column are among ``taken`` rows, of any number."""
    out, rest = np.zeros_like(columns), int(columns.sum())
    for j, room in enumerate(columns.tolist()):
        out[j] = hypergeometric(rng.random(), room, rest - room, taken)
        rest, taken = rest - room, taken - int(out[j])
    return out


def _at(seed: int, salt: int) -> Column:
    return F.xxhash64(F.lit(seed * 1_000 + salt), F.col("_id"))


#: ``monotonically_increasing_id`` has the partition above these bits and the place in it below.
_PLACE_BITS = 33


def shuffle_shards(
    rows: DataFrame,
    shards: int = 24,
    seed: int = 7,
    rows_per_part: int = ROWS_PER_PART,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """All rows with ``shard`` and ``slot``, a uniformly random place.

    Shards differ by one row at most; slots of a shard run from 0 without gaps. Rows
    are told apart by their place in a checkpoint, so that repeated rows and null keys
    spread like all others; the same input in the same files gives the same result.
    Columns of the input that are called ``shard`` or ``slot`` are replaced. An empty
    input gives an empty result.
    """
    if shards < 1 or rows_per_part < 1:
        raise ValueError("shards and rows_per_part must be positive")
    names = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    packed = F.struct(*[rows[c] for c in names]).alias("_row")
    written = cut(rows.select(packed))
    kept, held = _blocks(written)
    most = max(1, most_bytes // (8 * shards))
    if len(held) > most:
        kept, held = _blocks(written.coalesce(most))
    total = sum(held.values())

    rng = np.random.default_rng(seed)
    larger = set(rng.permutation(shards)[: total % shards].tolist())
    of_shard = [total // shards + (s in larger) for s in range(shards)]
    blocks = sorted(held)
    matrix = communication_matrix(rng, [held[b] for b in blocks], of_shard) if total else np.zeros((0, shards), np.int64)
    # a row of ``shards`` numbers for each block: no more than ``most_bytes``
    plan = F.broadcast(_plan(rows.sparkSession, blocks, matrix))

    parts = max(1, -(-total // (shards * rows_per_part)))
    row = ["_row"] if parts == 1 else ["_row", "_part"]
    dealt = _dealt_out(kept, plan, seed, parts)
    by = ["shard", *row[1:]]
    dealt = dealt.select("_row", "_id", *by).repartition(shards * parts, *by)
    within = Window.partitionBy(*by).orderBy(_at(seed, 3), "_id")
    slot = F.row_number().over(within) - 1
    if parts > 1:
        counts = _dealt_out(kept.select("_id"), plan, seed, parts).groupBy(*by).agg(F.count("*").alias("_n"))
        before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        # three numbers for each part; more of them than may be broadcast meet in a shuffle join
        dealt = dealt.join(F.broadcast(starts) if 24 * shards * parts <= most_bytes else starts, by)
        slot = F.col("_start") + slot
    return dealt.withColumn("slot", slot.cast("long")).select(
        *[F.col("_row").getField(c).alias(c) for c in names], "shard", "slot"
    )


def _blocks(written: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The rows with an id, and the number of rows of each partition that has any."""
    kept = written.withColumn("_id", F.monotonically_increasing_id())
    counts = kept.groupBy(F.shiftright("_id", _PLACE_BITS).alias("block")).count()
    return kept, {int(b): n for b, n in counts.collect()}  # a row for each partition


def _dealt_out(kept: DataFrame, plan: DataFrame, seed: int, parts: int) -> DataFrame:
    """Every row with its shard, by its place in a random order of its block, and a random part."""
    place = F.monotonically_increasing_id()
    permuted = kept.withColumn("_draw", _at(seed, 2)).sortWithinPartitions("_draw", "_id")
    return (
        permuted.withColumn("_place", place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
        .withColumn("_block", F.shiftright("_id", _PLACE_BITS))
        .join(plan, "_block")
        .withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_place"))))
        .withColumn("_part", F.pmod(_at(seed, 1), F.lit(parts)).cast("int"))
    )


def _plan(spark: SparkSession, blocks: list[int], matrix: np.ndarray) -> DataFrame:
    """For each block, up to which place its rows go to each shard."""
    ends = np.cumsum(matrix, axis=1).tolist()
    return spark.createDataFrame(list(zip(blocks, ends)), "_block long, _ends array<long>")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a folder for each shard, its rows in the order of their slots."""
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts; a null text has 8 bytes and CRC 0."""
    placed = shuffle_shards(table(spark, sf_dir, "documents"), 24)
    text = F.coalesce(F.col("text"), F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
