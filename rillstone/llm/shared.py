"""Helpers that several operators share: tables, checkpoints, splits, word hashes."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper and lower case of the letters A to Z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII letters to lower case, all other bytes as they are.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: The bytes that part words: space, and tab to carriage return.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared checkpoint folder; its lineage ends there.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session, whose
    tasks see one disk, gets a folder of its own where none is set.
    """
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        root = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            root = tempfile.mkdtemp(prefix="rillstone-checkpoint-")
        context.setCheckpointDir(root)
    return frame.checkpoint()


def remainder(doc_id: str | Column, parts: int) -> Column:
    """CRC-32 of an id as text, modulo ``parts``; 0 where the id is null."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(-1)).cast("string")
    crc = F.pmod(F.crc32(text.cast("binary")), F.lit(parts)).cast("int")
    return F.when(F.col(doc_id).isNull() if isinstance(doc_id, str) else doc_id.isNull(), 0).otherwise(crc)


def stretches(text: Column, key: Column, parts: int, size: int) -> Column:
    """The text, or of one longer than ``parts * size`` characters a bounded share of it.

    That is a stretch of ``size`` characters out of each of ``parts`` equal parts, at a place
    that the hash of the key picks, in their order and parted by line feeds.
    """
    part = F.floor(F.length(text) / F.lit(parts))
    room = F.greatest(part - F.lit(size) + 1, F.lit(1))
    at = [F.lit(i) * part + F.pmod(F.xxhash64(key, F.lit(i)), room) + 1 for i in range(parts)]
    pieces = [F.substring(text, a.cast("int"), F.lit(size)) for a in at]
    return F.when(F.length(text) > parts * size, F.concat_ws("\n", *pieces)).otherwise(text)


# -- vectorised words -----------------------------------------------------------------

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 to base**(n - 1), modulo 2**64."""
    out = np.full(n, np.uint64(base & (2**64 - 1)))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random 64-bit value for each byte.
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = (_powers(size, _BASE), _powers(size, _INVERSE))
    return _POWERS[size]


def text_bytes(texts: list[str | None], lower: bool = True) -> tuple[bytes, np.ndarray]:
    """All texts as one byte string, one separator after each, and where each begins.

    The last entry of the offsets is the length of the whole. Null counts as empty.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    joined = b"\n".join(parts) + b"\n" if parts else b""
    return (joined.translate(LOWER_BYTES) if lower else joined), offsets


class Words:
    """The words of several texts, as flat arrays.

    ``begin`` and ``end`` are byte positions in ``data``, ``hash`` a 64-bit hash of the
    bytes of each word, ``first`` the index of each text's first word, with the number
    of all words at its end.
    """

    def __init__(self, texts: list[str | None], separators: bytes = SPACE_BYTES, lower: bool = True):
        joined, offsets = text_bytes(texts, lower)
        self.data = np.frombuffer(joined, dtype=np.uint8)
        apart = np.zeros(256, dtype=bool)
        apart[np.frombuffer(separators, dtype=np.uint8)] = True
        apart[10] = True  # what parts the texts
        gap = apart[self.data]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(gap) and not gap[0]:
            edge = np.concatenate([[0], edge])
        # every text ends in a separator, so that edges come in pairs
        self.begin, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.begin, offsets)
        self.hash = span_hashes(self.data, self.begin, self.end)

    def __len__(self) -> int:
        return len(self.begin)

    def word(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()

    def text_of(self) -> np.ndarray:
        """The index of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def span_hashes(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, prefixes: tuple[int, ...] = ()
) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from one running sum over all bytes.

    With ``prefixes``, one row for the whole spans and one for their first bytes, for each
    of the given numbers; a shorter span is its own prefix.
    """
    out = np.empty((1 + len(prefixes), len(begin)), dtype=np.uint64)
    step = 1 << 18
    at = 0
    while at < len(begin):  # by stretches, so that the sums stay in the processor's cache
        low = int(begin[at])
        upto = max(at + 1, int(np.searchsorted(end, low + step, side="right")))
        high = int(end[upto - 1])
        power, inverse = _power_tables(high - low + 1)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data[low:high]] * power[: high - low], out=total[1:])
        b = begin[at:upto] - low
        for row, size in enumerate((None, *prefixes)):
            e = end[at:upto] - low
            e = e if size is None else np.minimum(e, b + size)
            out[row, at:upto] = mix((total[e] - total[b]) * inverse[b] + (e - b).astype(np.uint64))
        at = upto
    return out if prefixes else out[0]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words, and the index of their text.

    A text with fewer words has its whole sequence as its one run; one without words
    has none.
    """
    count = np.diff(words.first)
    runs = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    text = np.repeat(np.arange(len(count)), runs)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    start = words.first[:-1][text] + offset
    out = np.zeros(len(text), dtype=np.uint64)
    weights = _powers(size + 1, int(_MULTIPLIER))
    short = count[text] < size
    for j in range(size):
        at = np.minimum(start + j, max(0, len(words) - 1))
        value = mix(words.hash[at] + weights[j]) * weights[j] if len(words) else out
        out += np.where(short & (j >= count[text]), np.uint64(0), value)
    return mix(out + np.where(short, count[text] + 1, 0).astype(np.uint64)), text


def batches(rows: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most_bytes`` of text, one row at least."""
    for batch in rows:
        column = batch.column(text)
        length = np.zeros(batch.num_rows + 1, dtype=np.int64)
        np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False), out=length[1:])
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(length, length[at] + most_bytes, side="right")) - 1
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto
        del batch, column  # before the next comes


def runs(rows: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in the named columns, whatever batches they are in."""
    open_: list[pa.RecordBatch] = []
    last = None
    for batch in rows:
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        change = np.any([v[1:] != v[:-1] for v in values], axis=0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                now = tuple(v[low] for v in values)
                if open_ and now != last:
                    yield pa.Table.from_batches(open_)
                    open_ = []
                last = now
                open_.append(batch.slice(low, high - low))
    if open_:
        yield pa.Table.from_batches(open_)
