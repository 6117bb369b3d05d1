"""Exact duplicates by owners in compressed radix tries.

A trie over byte strings keeps, for each text, one terminal node with the smallest
identifier that owns it. Edges hold whole stretches of bytes, so that a text costs one node
or two, and equality is the equality of all bytes; hashes only say where texts meet.

First each task folds its own rows: a text is sent on once, with the smallest identifier and
the number of its rows, however often it occurs there. When a task's trie outgrows its
memory, its heaviest subtree is spilled: its terminals go out as they are, and the same text
may go out again later. Then texts meet in partitions by length and content hash, sorted
by both, and are inserted into tries again. As they come in that order, the subtree of one
length and hash is complete when the next begins; it is spilled to the output and its
memory freed. A text that a third of all rows hold comes there once from each task.

Rows and texts part after the first step: a row remembers the reference under which its task
sent the text on, and finds the owner by it, so that no list of a group's rows is ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import batches, table
from rillstone.workspace import new_folder

#: Bytes that a task's trie may hold; a node counts as ``NODE`` besides its label.
MEMORY, NODE = 32 << 20, 400
#: Bytes of text that are worked on, and sent on, at a time.
STEP = 4 << 20
#: Bytes of text that a partition is meant to have.
PARTITION = 32 << 20
#: The bytes that are white space: space, and tab to carriage return.
SPACE = b" \t\n\x0b\x0c\r"


def normal(data: bytes | None) -> bytes:
    """The text with each run of white space as one space; null counts as empty."""
    if not data:
        return b""
    out = b" ".join(data.split())
    if data[-1] in SPACE:
        out += b" "
    return b" " + out if data[0] in SPACE and out != b" " else out


# -- the trie -------------------------------------------------------------------------


class Node:
    """The bytes that lead here, what follows by its first byte, and the owner of a text that ends here."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label, self.children, self.owner = label, None, owner


def common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` stand in ``b`` from ``at`` on."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed radix trie from byte strings to owners."""

    def __init__(self):
        self.root = Node(b"")
        self.size = 0
        self.held: dict[int, int] = {}  # bytes below each first byte

    def owner(self, key: bytes, new):
        """The owner of a text; a text that is not there yet gets the one that ``new`` makes."""
        node, at = self.root, 0
        while at < len(key):
            child = None if node.children is None else node.children.get(key[at])
            if child is None:
                leaf = Node(key[at:], new())
                if node.children is None:
                    node.children = {}
                node.children[key[at]] = leaf
                return self._grown(key, len(leaf.label), leaf)
            same = len(child.label) if key.startswith(child.label, at) else common(child.label, key, at)
            if same < len(child.label):  # part the edge where the texts differ
                upper = Node(child.label[:same])
                upper.children = {child.label[same]: child}
                child.label = child.label[same:]
                node.children[key[at]] = upper
                self._grown(key, 0, upper)
                child = upper
            node, at = child, at + same
        if node.owner is None:
            node.owner = new()
        return node.owner

    def _grown(self, key: bytes, label: int, node: Node):
        self.size += label + NODE
        self.held[key[0]] = self.held.get(key[0], 0) + label + NODE
        return node.owner

    def items(self, node: Node | None = None, above: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """Texts and their owners, below a node."""
        stack = [(node or self.root, above)]
        while stack:
            node, above = stack.pop()
            whole = above + node.label
            if node.owner is not None:
                yield whole, node.owner
            stack += [(child, whole) for child in (node.children or {}).values()]

    def spill(self) -> Iterator[tuple[bytes, object]]:
        """Take out the subtree that holds most bytes; its texts and owners."""
        first = max(self.held, key=self.held.get)
        self.size -= self.held.pop(first)
        yield from self.items(self.root.children.pop(first))


# -- tasks ----------------------------------------------------------------------------

_TEXTS = ("length", "hash", "text", "least", "least_row", "copies")


def _before(a, b) -> bool:
    """Whether (identifier, row) ``a`` comes before ``b``; null identifiers come last."""
    if (a[0] is None) != (b[0] is None):
        return b[0] is None
    return a < b if a[0] is not None else a[1] < b[1]


class _Owner:
    __slots__ = ("refs", "least", "copies")

    def __init__(self, ref, least, copies: int = 0):
        self.refs, self.least, self.copies = ref, least, copies

    def add(self, least, copies: int) -> None:
        self.copies += copies
        if _before(least, self.least):
            self.least = least


def _fold(memory: int):
    """Rows with references, and the distinct texts under them."""

    def sent(found: Iterator[tuple[bytes, _Owner]], kinds: dict) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for text, owner in found:
            code = int.from_bytes(hashlib.sha256(text).digest()[:8], "big", signed=True)
            rows.append((owner.refs, len(text), code, text, *owner.least, owner.copies))
            size += len(text)
            if size >= STEP:
                yield batch_of(rows, kinds)
                rows, size = [], 0
        if rows:
            yield batch_of(rows, kinds)

    def batch_of(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
        ref, length, code, text, least, row, copies = zip(*rows)
        columns = [
            pa.array([True] * len(rows)), pa.array(ref, pa.int64()), pa.nulls(len(rows), kinds["carried"]), pa.nulls(len(rows), pa.int64()),
            pa.array(length, pa.int64()), pa.array(code, pa.int64()), pa.array(text, pa.large_binary()).cast(pa.binary()),
            pa.array(least, kinds["id"]), pa.array(row, pa.int64()), pa.array(copies, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["owner", "ref", "carried", "row", *_TEXTS])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        trie, row, made, kinds = Trie(), base, base, {}
        for batch in batches(rows, "data", STEP):
            kinds = {c: batch.schema.field(c).type for c in ("id", "carried")}
            refs, first = [], row
            for id_, data in zip(batch.column("id").to_pylist(), batch.column("data").to_pylist()):
                least = (id_, row)
                owner = trie.owner(normal(data), lambda: _Owner(None, least))
                if owner.refs is None:
                    owner.refs, made = made, made + 1
                owner.add(least, 1)
                refs.append(owner.refs)
                row += 1
            n = len(refs)
            columns = [pa.array([False] * n), pa.array(refs, pa.int64()), batch.column("carried"), pa.array(range(first, row), pa.int64())]
            columns += [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.binary(), kinds["id"], pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["owner", "ref", "carried", "row", *_TEXTS])
            while trie.size > memory:
                yield from sent(trie.spill(), kinds)
        yield from sent(trie.items(), kinds)

    return run


def _settle():
    """For each reference to a text: the owner of all rows with that text, and their number."""

    def closed(trie: Trie, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        for text, owner in trie.items():
            n = len(owner.refs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owner.refs, pa.int64()), pa.array([owner.least[0]] * n, kind), pa.array([owner.least[1]] * n, pa.int64()),
                    pa.array([owner.copies] * n, pa.int64()), pa.array([hashlib.sha256(text).hexdigest()] * n),
                ],
                names=["ref", "keep", "keep_row", "size", "sha"],
            )

    def gathered(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in found:
            held.append(batch)
            n += batch.num_rows
            if n >= 4096:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def each(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, place, kind = Trie(), None, None
        for batch in batches(rows, "text", STEP):
            kind = batch.schema.field("least").type
            for ref, length, code, text, least, row, copies in zip(*(batch.column(c).to_pylist() for c in ("ref", *_TEXTS))):
                if place is not None and place != (length, code):
                    yield from closed(trie, kind)
                    trie = Trie()
                place = (length, code)
                owner = trie.owner(text, lambda: _Owner([], (least, row)))
                owner.refs.append(ref)
                owner.add((least, row), copies)
        yield from closed(trie, kind)

    return lambda rows: gathered(each(rows))


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), memory: int = MEMORY
) -> DataFrame:
    """For each row: who owns its text, how many rows have that text, whether this row stays.

    Texts are equal when they are identical after replacing each run of ASCII white space by
    one space; null counts as empty, and a space is not empty. Of equal texts the row with
    the smallest ``id`` stays, the first one read of rows that share it; rows without an
    id come last, and stay only where no row of the group has one. So exactly one row
    of each group stays. Texts of any length are compared whole; one must fit a task's memory.
    An empty table gives an empty result. Other columns are left out but for those in ``carry``.

    Returned: ``id``, the carried columns, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` of the normalised text.
    """
    spark = docs.sparkSession
    names = [id, *carry]
    taken = docs.select(
        docs[id].alias("id"), docs[text].cast("binary").alias("data"), F.struct(*[docs[c] for c in names]).alias("carried")
    )
    own, packed = (taken.schema[c].dataType.simpleString() for c in ("id", "carried"))
    shape = (
        f"owner boolean, ref long, carried {packed}, row long, length long, hash long, text binary, least {own}, least_row long, copies long"
    )
    path = new_folder(spark, "texts")
    taken.mapInArrow(_fold(memory), shape).write.option("compression", "zstd").parquet(path)
    folded = spark.read.schema(shape).parquet(path)

    texts = folded.where("owner").select("ref", *_TEXTS)
    total = texts.agg(F.sum("length")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION))
    met = texts.repartition(parts, "length", "hash").sortWithinPartitions("length", "hash")
    settled = met.mapInArrow(_settle(), f"ref long, keep {own}, keep_row long, size long, sha string")
    return folded.where("not owner").select("ref", "carried", "row").join(settled, "ref").select(
        *[F.col("carried").getField(c).alias(c) for c in names],
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owners of all documents' texts."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


#: The same in SQL.
ORACLE_OP13 = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as x from documents)
select doc_id, min(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size,
  row_number() over (partition by x order by doc_id nulls last) = 1 as kept, sha256(x) as text_sha256
from t
"""
