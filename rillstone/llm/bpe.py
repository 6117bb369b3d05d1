"""Byte-level BPE: encoding by ranked merges, decoding by concatenating pieces.

Two forms of the same fold. ``encode_words`` folds merges over a table of distinct
words with higher-order functions and a literal rank map. ``encode`` serves whole
documents: within each task, every distinct word is folded once and its ids are kept, and
a text's ids are gathered from those of its words. Bringing the ids of distinct words of
a whole corpus back to their documents would shuffle every occurrence; the README has the
figures that decide for the second form. ``decode`` is one expression.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import batches, mix, table

#: Text that is turned into words at a time, and distinct words that a task remembers.
BATCH_BYTES, REMEMBERED = 1 << 20, 200_000
#: The rank of a pair that does not merge.
NONE = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """The pieces of a rank file (base64 and rank on each line); the driver reads it."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Merges:
    """Which pairs of pieces merge, and into what, as an open-addressed table of arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = [
            (a << 32 | b, rank)
            for piece, rank in ranks.items()
            for i in range(1, len(piece))
            if (a := ranks.get(piece[:i])) is not None and (b := ranks.get(piece[i:])) is not None
        ]
        keys = np.array([k for k, _ in pairs] or [-2], dtype=np.int64)
        into = np.array([r for _, r in pairs] or [NONE], dtype=np.int32)
        self.mask = (1 << (2 * len(keys)).bit_length()) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.into = np.full(self.mask + 1, NONE, dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.into[taken] = keys[free[first]], into[free[first]]
            rest = np.ones(len(keys), dtype=bool)
            rest[free[first]] = False
            keys, into, slot = keys[rest], into[rest], (slot[rest] + 1) & self.mask
        self.byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each merged pair, ``NONE`` where it is no piece."""
        keys = (a.astype(np.int64) << 32) | b
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.into[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1) & (a >= 0) & (b >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            found, wanted = self.keys[slot], keys[open_]
            hit = found == wanted
            out[open_[hit]] = self.into[slot[hit]]
            more = ~hit & (found != -1)
            open_, slot = open_[more], slot[more]
        return out


def fold_words(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """All words' ids, one after another, and where each word's begin (and the end).

    In each word the adjacent pair of lowest rank is merged, the first of equals, until
    none has a rank. Words of similar lengths take their steps together; a word that is
    a piece itself takes none.
    """
    length = np.array([len(w) for w in words], dtype=np.int64)
    whole = np.array([merges.ranks.get(w, -1) for w in words], dtype=np.int64)
    count = np.where(whole >= 0, 1, 0)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    low = 0
    for high in (8, 16, 32, 64):
        at = np.flatnonzero((whole < 0) & (length > low) & (length <= high))
        low = high
        for some in np.array_split(at, max(1, len(at) // 20_000)):
            if len(some):
                ids = _fold_rows([words[i] for i in some], length[some], high, merges)
                parts.append((some, ids))
                count[some] = (ids >= 0).sum(axis=1)
    long = [(i, _fold_long(words[i], merges.ranks)) for i in np.flatnonzero((whole < 0) & (length > low))]
    for i, ids in long:
        count[i] = len(ids)
    start = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(start[-1], dtype=np.int32)
    out[start[:-1][whole >= 0]] = whole[whole >= 0]
    for some, ids in parts:
        row, column = np.nonzero(ids >= 0)
        out[start[some[row]] + column] = ids[row, column]
    for i, ids in long:
        out[start[i] : start[i + 1]] = ids
    return out, start


def _fold_rows(words: list[bytes], length: np.ndarray, width: int, merges: Merges) -> np.ndarray:
    data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
    out = merges.byte[data].reshape(len(words), width)
    out[np.arange(width) >= length[:, None]] = -1
    ids, rows = out.copy(), np.arange(len(words))
    rank = merges.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width - 1)
    while len(rows):
        at = rank.argmin(axis=1)
        best = rank[np.arange(len(rows)), at]
        go = best != NONE
        if not go.all():
            out[rows[~go], : ids.shape[1]] = ids[~go]
            out[rows[~go], ids.shape[1] :] = -1
            ids, rank, rows, at, best = ids[go], rank[go], rows[go], at[go], best[go]
            if not len(rows):
                break
        n, wide = np.arange(len(rows)), ids.shape[1]
        column = np.arange(wide - 1)
        shifted = column + (column > at[:, None])  # the part after the pair's first is gone
        ids = np.take_along_axis(ids, shifted, axis=1)
        ids[n, at] = best
        rank = np.take_along_axis(rank, shifted[:, :-1], axis=1) if wide > 2 else rank[:, :0]
        if wide <= 2:
            out[rows, :1], out[rows, 1:] = ids, -1
            break
        before, after = np.flatnonzero(at > 0), np.flatnonzero(at < wide - 2)
        rank[before, at[before] - 1] = merges.of(ids[before, at[before] - 1], best[before])
        rank[after, at[after]] = merges.of(best[after], ids[after, at[after] + 1])
    return out


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for words of any length, with a heap of pairs and a linked list of parts."""
    n = len(word)
    end = list(range(1, n + 1))  # of the part that begins here
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    alive = [True] * n
    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, upto = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != upto:
            continue
        gone = end[i]
        alive[gone] = False
        end[i] = upto
        if upto < n:
            before[upto] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class _Places(dict):
    """Word -> its place; a new word gets the next one and waits in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word.encode("utf-8", "surrogatepass"))
        return at


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns and ``ids``, the text's tokens without special ones.

    Each match of the pattern is encoded by itself. Null and empty texts have no ids.
    Repeated rows give repeated results. Columns that are not kept are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # as many as the rank file has
    narrow = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("t"))
    schema = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = regex.compile(pattern).findall
        merges = Merges(shared.value)
        places: _Places | None = None
        for batch in batches(rows, "t", BATCH_BYTES):
            if places is None or len(places) > REMEMBERED:
                places = _Places()
                all_ids, start = np.zeros(0, np.int32), np.zeros(1, np.int64)
            found = [words_of(x) if x else [] for x in batch.column("t").to_pylist()]
            at = np.fromiter(
                map(places.__getitem__, chain.from_iterable(found)), np.int64, sum(map(len, found))
            )
            if places.new:
                ids, begin = fold_words(places.new, merges)
                places.new = []
                start = np.concatenate([start, start[-1] + begin[1:]])
                all_ids = np.concatenate([all_ids, ids])
            length = start[at + 1] - start[at]
            ends = np.concatenate([[0], np.cumsum(length)])
            flat = all_ids[np.repeat(start[at] - ends[:-1], length) + np.arange(ends[-1])]
            offsets = ends[np.concatenate([[0], np.cumsum([len(w) for w in found])])]
            out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, out], names=[*[f"k{i}" for i in range(len(keep))], "ids"])

    coded = narrow.mapInArrow(run, f"{schema}, ids array<int>")
    return coded.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "ids")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that the ids stand for; pieces are looked up in a literal array."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), ""))


def encode_words(words: DataFrame, ranks: dict[bytes, int], buckets: int = 8192) -> DataFrame:
    """``word`` and ``ids`` of each distinct word, by higher-order functions alone.

    Parts are byte strings in hexadecimal. A map is searched from its beginning, so that
    the literal rank map is an array of small maps, one for each checksum of the key.
    """
    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        maps[zlib.crc32(key.encode()) % buckets][key] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    def rank(key: Column) -> Column:
        return F.element_at(F.get(literal, F.pmod(F.crc32(key.cast("binary")), F.lit(buckets)).cast("int")), key)

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def merged(parts: Column) -> Column:
        of_pairs = F.transform(
            F.slice(parts, 1, F.size(parts) - 1), lambda p, i: rank(F.concat(p, F.get(parts, i + 1)))
        )

        def at_best(r: Column) -> Column:
            joined = lambda at: F.concat(
                F.slice(parts, F.lit(1), at - 1),
                F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                F.slice(parts, at + 2, F.size(parts)),
            )
            best = F.array_min(r)
            return F.when(best.isNull(), parts).otherwise(
                let(F.array_position(r, best).cast("int"), joined)
            )

        return F.when(F.size(parts) < 2, parts).otherwise(let(of_pairs, at_best))

    code = F.hex(F.col("word").cast("binary"))
    size = F.octet_length("word")
    parts = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(F.col("_hex"), i * 2 + 1, F.lit(2)))
    folded = F.aggregate(F.sequence(F.lit(1), size), F.col("_parts"), lambda p, _: merged(p))
    return (
        words.select("word").where(size > 0).distinct()
        .withColumn("_hex", code)
        .withColumn("_parts", parts)
        .withColumn("_folded", folded)
        .select("word", F.transform("_folded", rank).alias("ids"))
    )


def op8_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents encoded, and decoded again, with their digests."""
    import public_tokenizers

    ranks = read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return digests(coded, ranks)


def digests(coded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Number of tokens, and digests of the ids and of the decoded bytes."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )
