"""Benchmark passages in documents, found under edits.

1. Anchors: a passage within the allowed edits of an item shares a run of three words with
   it (the words that stay form few enough runs), so that windows are taken only where
   a run of three words of some item begins; nothing can be missed by that.
2. A window as long as the item is walked at random, as in the CGK embedding: at each
   step the current word is written out, and a random bit of word and step says whether
   to move on. Two sequences a few edits apart walk in step most of the time, so that
   edit distance becomes Hamming distance.
3. Locality-sensitive hashing by sampling positions of the walk: windows whose sampled words
   equal an item's are candidates. Independent walks are added until items edited as
   much as allowed are found with the target recall.
4. Candidates are verified by their exact edit distance.

Items of fewer than six words, which a run of three words under edits tells too little about, are
found where all their words stand in a row. In scripts that are written without spaces every
character is a word.

Documents pass once per block of items, whole, and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import Words, batches, mix, span_hashes, table, text_bytes

#: Share of an item's words that may be edited; words that an item has at least to be edited.
EDITED, LEAST_WORDS = 0.2, 6
#: Bytes of items in a block, whose index is broadcast; a longer item is a block by itself.
BLOCK_BYTES = 1 << 20
#: Sampled positions in a key, keys of a walk, recall at the edit bound. Walks beyond which
#: that recall counts as out of reach, which raises.
SAMPLED, KEYS, RECALL, MOST_WALKS = 3, 4, 0.95, 1024
#: Windows that are looked at together.
WINDOWS = 1 << 20
#: Steps of a walk for each word of the window.
STRETCH = 3
BATCH_BYTES = 4 << 20
GRAM = 3
#: What parts words: ASCII that is neither a letter nor a digit.
APART = bytes(b for b in range(128) if not chr(b).isalnum())
MATCH = "array<struct<item_id:bigint,first_word:int,end_word:int,distance:int>>"


class Tokens(Words):
    """Words, and each character of a script without spaces as a word."""

    def __init__(self, texts: list[str | None]):
        super().__init__(texts, APART)
        starts, size = _unspaced(self.data)
        if not len(starts):
            return
        apart = np.zeros(256, dtype=bool)
        apart[np.frombuffer(APART, dtype=np.uint8)] = True
        gap = apart[self.data]
        cuts = np.unique(np.concatenate([starts, starts + size]))
        self.begin = np.union1d(self.begin, cuts[~gap[cuts]])
        self.end = np.union1d(self.end, cuts[~gap[cuts - 1]])
        _, offsets = text_bytes(texts)
        self.first = np.searchsorted(self.begin, offsets)
        self.hash = span_hashes(self.data, self.begin, self.end)


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters begin that are written without spaces, and their bytes.

    Chinese characters and kana (U+3000 to U+9FFF, U+20000 to U+3FFFF), Thai and Lao (U+0E00
    to U+0EFF), Burmese (U+1000 to U+109F) and Khmer (U+1780 to U+17FF).
    """
    after = np.append(data[1:], 0)
    three = (data >= 0xE3) & (data <= 0xE9)
    three |= (data == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
    three |= (data == 0xE1) & ((after == 0x80) | (after == 0x81) | (after == 0x82) | (after == 0x9E) | (after == 0x9F))
    four = (data == 0xF0) & (after >= 0xA0) & (after <= 0xBF)
    starts = np.flatnonzero(three | four)
    return starts, np.where(four[starts], 4, 3)


def allowed(n: int) -> int:
    """Edits that a passage of ``n`` words may have."""
    return int(EDITED * n + 1e-9) if n >= LEAST_WORDS else 0


def grams(hashes: np.ndarray) -> np.ndarray:
    """A hash of each run of three words."""
    n = max(0, len(hashes) - GRAM + 1)
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(hashes[:n] * a + mix(hashes[1 : n + 1] * b + mix(hashes[2 : n + 2]))) if n else hashes[:0]


class Walk:
    """One random walk: its bits, and the positions that its keys sample."""

    def __init__(self, seed: int):
        self.seed = seed

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """``KEYS`` hashes of sampled words for each row of word hashes (0 behind the end)."""
        n, size = rows.shape
        rng = np.random.default_rng([self.seed, size])
        # late positions lie behind the end for most walks and tell little
        places = np.sort(rng.integers(0, 2 * size, (KEYS, SAMPLED)), axis=1)
        factor = rng.integers(0, 2**63, STRETCH * size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        padded = np.concatenate([rows, np.zeros((n, 1), np.uint64)], axis=1).ravel()
        base = np.arange(n) * (size + 1)
        at = np.zeros(n, dtype=np.int64)
        out = np.full((n, KEYS), np.uint64(self.seed + 1))
        for step in range(int(places.max()) + 1):
            word = padded[base + at]
            for key in np.flatnonzero((places == step).any(axis=1)):
                out[:, key] = mix(out[:, key] * np.uint64(0x9E3779B97F4A7C15) + word)
            at = np.minimum(at + (word * factor[step] >> np.uint64(63)).astype(np.int64), size)
        return mix(out + np.arange(KEYS, dtype=np.uint64) + np.uint64(size << 8))


@dataclass
class Index:
    """A block of items: words, runs of three, and the keys of as many walks as it takes."""

    ids: list[int]
    items: list[np.ndarray]
    grams: np.ndarray
    gram_item: np.ndarray
    gram_at: np.ndarray
    seen: np.ndarray
    walks: list[Walk]
    keys: np.ndarray
    key_item: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: hashes of short items, and their ids


def edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """The item after so many random substitutions, insertions and deletions of words."""
    out = item.tolist()
    for _ in range(edits):
        kind, at = int(rng.integers(0, 3)), int(rng.integers(0, max(1, len(out))))
        word = int(rng.integers(1, 2**62))
        if kind == 0 and out:
            out[at] = word
        elif kind == 1:
            out.insert(at, word)
        elif out:
            del out[at]
    return np.array(out, dtype=np.uint64)


def _fit(words: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([words[:size], np.zeros(max(0, size - len(words)), np.uint64)])


def enough_walks(items: list[np.ndarray], recall: float = RECALL) -> list[Walk]:
    """As many walks as find items, edited as much as allowed, with the wanted recall.

    Tried out on up to 300 of the items themselves.
    """
    rng = np.random.default_rng(3)
    chosen = [items[i] for i in rng.permutation(len(items))[:300]]
    trial: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for item in chosen:
        for _ in range(2):
            changed = edited(item, allowed(len(item)), rng)
            trial.setdefault(len(item), []).append((item, _fit(changed, len(item))))
    found = {n: np.zeros(len(pairs), bool) for n, pairs in trial.items()}
    walks: list[Walk] = []
    while True:
        if len(walks) == MOST_WALKS:
            raise RuntimeError(f"{MOST_WALKS} walks do not find edited items with a recall of {recall}")
        walks.append(Walk(len(walks)))
        for n, pairs in trial.items():
            a, b = (walks[-1].keys(np.stack(side)) for side in zip(*pairs))
            found[n] |= (a == b).any(axis=1)
        if not found or np.concatenate(list(found.values())).mean() >= recall:
            return walks


def _in_a_row(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, np.uint64(n))
    for j in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + count])
    return out


def build(rows: list[tuple[int, str]]) -> Index:
    """The index of a block of items; those without words are left out."""
    words = Tokens([t for _, t in rows])
    whole = [(int(rows[i][0]), words.hash[words.first[i] : words.first[i + 1]]) for i in range(len(rows))]
    kept = [(id_, w) for id_, w in whole if len(w) >= LEAST_WORDS]
    short = {}
    for n in range(1, LEAST_WORDS):
        few = sorted((int(_in_a_row(w, n)[0]), id_) for id_, w in whole if len(w) == n)
        if few:
            short[n] = (np.array([h for h, _ in few], dtype=np.uint64), np.array([i for _, i in few], dtype=np.int64))
    items = [w for _, w in kept]
    runs = [grams(w) for w in items]
    flat = np.concatenate([*runs, np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(items)), [len(r) for r in runs])
    at = np.concatenate([*(np.arange(len(r)) for r in runs), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    seen = np.zeros(1 << 22, dtype=bool)
    seen[(flat >> np.uint64(42)).astype(np.int64)] = True
    walks = enough_walks(items) if items else []
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(items):
        by_size.setdefault(len(w), []).append(i)
    keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for members in by_size.values():
        rows_ = np.stack([items[i] for i in members])
        for walk in walks:
            keys.append(walk.keys(rows_).ravel())
            owner.append(np.repeat(members, KEYS))
    all_keys, all_owner = np.concatenate(keys), np.concatenate(owner)
    by_key = np.argsort(all_keys, kind="stable")
    return Index(
        [i for i, _ in kept], items, flat[order], item[order], at[order], seen, walks,
        all_keys[by_key], all_owner[by_key], short,
    )


def _ranges(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an index into ``wanted`` and one into ``sorted_`` with equal values."""
    low, high = np.searchsorted(sorted_, wanted, "left"), np.searchsorted(sorted_, wanted, "right")
    size = high - low
    of = np.repeat(np.arange(len(wanted)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + low[of]


def edit_distance(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """The least edits between the item and any stretch of ``part``, and that stretch."""
    width = len(part) + 1
    cost = np.zeros(width, dtype=np.int64)
    start = np.arange(width)
    column = np.arange(width)
    for i, word in enumerate(item):
        change = np.concatenate([[1 << 30], cost[:-1] + (part != word)])
        drop = cost + 1
        from_change = change <= drop
        new = np.where(from_change, change, drop)
        origin = np.where(from_change, np.concatenate([[0], start[:-1]]), start)
        # insertions: the least of new[j] + (k - j) over j <= k
        lead = new - column
        least = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == least, column, 0))
        cost, start = least + column, origin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


def matches(texts: list[str | None], index: Index) -> list[list[dict]]:
    """Passages of items in each text: item, its words from first to end, edit distance."""
    out: list[list[dict]] = [[] for _ in texts]
    words = Tokens(texts)
    _match_short(words, index, out)
    runs = grams(words.hash)
    hit = np.flatnonzero(index.seen[(runs >> np.uint64(42)).astype(np.int64)]) if len(index.items) else np.zeros(0, np.int64)
    found: set[tuple[int, int, int]] = set()
    # a run that many items hold is looked at in parts
    pairs = np.cumsum(np.searchsorted(index.grams, runs[hit], "right") - np.searchsorted(index.grams, runs[hit], "left"))
    at = 0
    while at < len(hit):
        before = int(pairs[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(pairs, before + WINDOWS, side="right")))
        _candidates(words, index, hit[at:upto], runs, found)
        at = upto
    _verified(words, index, found, out)
    return out


def _match_short(words: Words, index: Index, out: list[list[dict]]) -> None:
    """Short items, wherever all their words stand in a row within one text."""
    for n, (hashes, ids) in index.short.items():
        of, place = _ranges(hashes, _in_a_row(words.hash, n))
        text = np.searchsorted(words.first, of, side="right") - 1
        inside = of + n <= words.first[text + 1] if len(of) else np.zeros(0, bool)
        for t, at, which in zip(text[inside].tolist(), of[inside].tolist(), place[inside].tolist()):
            first = at - int(words.first[t])
            out[t].append({"item_id": int(ids[which]), "first_word": first, "end_word": first + n, "distance": 0})


def _candidates(words: Words, index: Index, hit: np.ndarray, runs: np.ndarray, found: set[tuple[int, int, int]]) -> None:
    """Add the windows at these runs whose sampled words equal an item's."""
    of, place = _ranges(index.grams, runs[hit])
    begin = hit[of] - index.gram_at[place]
    text = np.searchsorted(words.first, hit[of], side="right") - 1
    lengths = np.array([len(w) for w in index.items])
    size = lengths[index.gram_item[place]]
    # windows, each once; a run may reach over the end of a text, which ends its window
    window = np.unique(np.stack([text, begin, size], axis=1), axis=0)
    for n in np.unique(window[:, 2]):
        some = window[window[:, 2] == n]
        for at in range(0, len(some), 50_000):
            here = some[at : at + 50_000]
            position = here[:, 1, None] + np.arange(n)
            inside = (position >= words.first[here[:, 0], None]) & (position < words.first[here[:, 0] + 1, None])
            rows = np.where(inside, words.hash[np.clip(position, 0, len(words) - 1)], np.uint64(0))
            for walk in index.walks:
                keys = walk.keys(rows)
                of_key, place = _ranges(index.keys, keys.ravel())
                for w, item in set(zip((of_key // KEYS).tolist(), index.key_item[place].tolist())):
                    found.add((int(here[w, 0]), int(here[w, 1]), item))


def _verified(words: Words, index: Index, found: set[tuple[int, int, int]], out: list[list[dict]]) -> None:
    """Add the candidates within the allowed edits, each passage once."""
    done: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for t, begin_, item in sorted(found):
        n = len(index.items[item])
        low, high = int(words.first[t]), int(words.first[t + 1])
        if any(a - n < begin_ - low < b for a, b in done.get((t, item), [])):
            continue  # a passage that has been found there already
        a, b = max(low, begin_ - allowed(n)), min(high, begin_ + n + allowed(n))
        edits, first, end = edit_distance(index.items[item], words.hash[a:b])
        if edits <= allowed(n):
            span = (a - low + first, a - low + end)
            done.setdefault((t, item), []).append(span)
            out[t].append({"item_id": index.ids[item], "first_word": span[0], "end_word": span[1], "distance": edits})


def find(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``matches``: each item's passages in the text.

    Words are runs of ASCII letters and digits or other bytes beyond ASCII, A to Z in
    lower case; characters of scripts without spaces are words of their own. A passage may
    differ from an item by a fifth of its words, and from one of fewer than six not at all.
    Null and empty texts match nothing, as do null items and those without words; an
    empty benchmark matches nothing. Repeated rows give repeated results, repeated items
    one match each. Columns that are not kept are left out.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    names = [f"k{i}" for i in range(len(keep))]
    current = docs.select(
        *[F.col(c).alias(n) for n, c in zip(names, keep)], F.col("text").alias("t"),
        F.expr(f"cast(array() as {MATCH})").alias("matches"),
    )
    schema = current.schema
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = spark.sparkContext.broadcast(build([tuple(r) for r in rows]))
        current = current.mapInArrow(_pass(index), schema)
    return current.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "matches")


def _pass(index):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "t", BATCH_BYTES):
            more = matches(batch.column("t").to_pylist(), index.value)
            if any(more):
                before = batch.column("matches")
                both = [a + b for a, b in zip(before.to_pylist(), more)]
                at = batch.schema.get_field_index("matches")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(both, before.type))
            yield batch

    return run


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.size(items).alias("n_items"),
        items.alias("item_ids"),
        F.array_min(F.transform("matches", lambda m: m["distance"])).alias("least_distance"),
    )
