"""Removal of globally repeated passages of lines.

A line is a physical line or, within one, a sentence; every line keeps its ending, so that
the lines of a text make up the text. A rolling hash over the hashes of two lines is
taken at every line, and a chunk begins where it is smaller than at both neighbours.
Boundaries thus depend on the lines around them alone: what is inserted before a passage
does not shift those within it.

Chunks of two lines or more are seeds: a document is looked into when the first two lines
of one of its chunks stand in several places. Within those documents matches grow line by line, to
the edges of the passage: of any two lines in a row that stand in several places, the first
place stays and all others go. What goes from a document in one piece has ``LEAST_BYTES``
bytes at least. The first place of a line is never taken out, so that each line that goes
still stands somewhere.

Lines meet by 64-bit hashes. Before anything is removed, the bytes of all lines that met are
compared; where different lines meet under one hash, none of them goes.

Texts are moved once, and only those that something is found in. Bitmaps of a bounded size keep
everything else out of the shuffles; what passes by chance is turned away by exact joins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import cut, table
from rillstone.workspace import new_folder

#: Up to and including a line feed, or the end of a sentence and its space, or the end.
LINE = r"(?:[^\n.!?]++|[.!?](?! ))++(?:\n|[.!?] )?|\n|[.!?] "
#: Lines of a chunk that is a seed, and bytes of what goes in one piece, at least.
LEAST_LINES, LEAST_BYTES = 2, 40
#: Of the rolling hash: multiplier and modulus.
FACTOR, MODULUS = 31, 268_435_399
#: Bits of a bitmap, whatever it is made of: a quarter of a million words of 64.
BITS = 1 << 24


def lines(text: Column) -> Column:
    """The text's lines with their endings; none where it is null or empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LINE), F.lit(0))


def chunk_starts(of_lines: str) -> Column:
    """Indices of the lines with which the chunks begin, from the column of lines."""
    hashes = F.transform(of_lines, lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long"))

    def from_hashes(h: Column) -> Column:
        rolled = F.transform(
            h, lambda x, i: (F.coalesce(F.get(h, i - 1), F.lit(0)) * FACTOR + x) % F.lit(MODULUS)
        )
        return _let(rolled, starts)

    def starts(r: Column) -> Column:
        at = F.transform(
            r,
            lambda x, i: F.when(
                (i == 0)
                | ((x < F.get(r, i - 1)) & (x < F.coalesce(F.get(r, i + 1), F.lit(MODULUS)))),
                i,
            ),
        )
        return F.filter(at, lambda i: i.isNotNull())

    return _let(hashes, from_hashes)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _with(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is computed once, whatever is made of it or filtered by it.

    A projected expression may be copied to where it is used, into functions of each element
    too; the output of a generator never is.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _chunk(of_lines: str | Column, start: Column, stop: Column) -> Column:
    return F.array_join(F.slice(of_lines, start + 1, stop - start), "")


def _hash(line: Column) -> Column:
    return F.xxhash64(line)


def hashed(docs: DataFrame) -> DataFrame:
    """For each document, by its id and the hash of its text: the hashes of its lines, and
    the indices of the lines that its chunks of two lines or more begin with."""
    known = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("of"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("before"),
        lines(F.col("text")).alias("l"),
    ).withColumn("s", chunk_starts("l"))
    next_ = lambda k: F.coalesce(F.get("s", k + 1), F.size("l"))
    seeds = F.filter("s", lambda start, k: next_(k) - start >= LEAST_LINES)
    return known.select("id", "of", "before", F.transform("l", _hash).alias("h"), seeds.alias("seeds"))


# -- bitmaps --------------------------------------------------------------------------


def _maybe(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows whose hash may be among the hashes ``key``: all that are, and few others.

    The bitmap is broadcast as words of 64 bits; there are ``BITS`` / 64 of them at most.
    """
    bit = F.pmod(F.col("key"), F.lit(BITS))
    words = keys.select(F.shiftright(bit, 6).alias("word"), F.pmod(bit, F.lit(64)).cast("int").alias("at")).groupBy("word")
    words = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("bits"))
    marked = rows.withColumn("bit", F.pmod(key, F.lit(BITS))).withColumn("word", F.shiftright("bit", 6))
    here = F.call_function("shiftright", F.col("bits"), F.pmod("bit", F.lit(64)).cast("int"))
    return marked.join(F.broadcast(words), "word").where(here.bitwiseAND(F.lit(1)) != 0).drop("bit", "word", "bits")


def _doc_key() -> Column:
    return F.xxhash64("id", "of")


def _of_documents(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the documents that are found, with what was found."""
    near = _maybe(rows, _doc_key(), found.select(_doc_key().alias("key")))
    other = found.withColumnsRenamed({"id": "i", "of": "t"})
    return near.join(other, near["id"].eqNullSafe(other["i"]) & (near["of"] == other["t"])).drop("i", "t")


# -- matches --------------------------------------------------------------------------


def _several(rows: DataFrame) -> DataFrame:
    """Hashes ``key`` that stand in more than one row."""
    return rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")


def seeded(known: DataFrame) -> DataFrame:
    """Documents with a chunk whose first two lines stand elsewhere too: ``id``, ``of``."""
    heads = F.transform("seeds", lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1)))
    each = known.select("id", "of", F.explode(heads).alias("key"))
    several = cut(_several(each))
    near = _maybe(each, F.col("key"), several)
    return near.join(several, "key", "left_semi").select("id", "of").distinct()


def _pairs(h: str) -> Column:
    """Every two lines in a row, by hash ``key`` and the first one's index ``at``."""
    return F.transform(
        F.sequence(F.lit(0), F.size(h) - 2),
        lambda i: F.struct(F.xxhash64(F.get(h, i), F.get(h, i + 1)).alias("key"), i.alias("at")),
    )


#: Stands for a null id, which comes before all others.
_NO_ID = -(2**63)


def matched(known: DataFrame) -> DataFrame:
    """Per document, its lines that begin a pair standing in several places: ``found``, with
    the line's index, whether this place is the first, and whether that is in this document."""
    inside = cut(_of_documents(known.select("id", "of", "h"), cut(seeded(known))))
    each = inside.where(F.size("h") > 1).select("id", "of", F.explode(_pairs("h")).alias("p")).select("id", "of", "p.*")
    place = F.coalesce(F.col("id"), F.lit(_NO_ID))
    counted = each.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    several = cut(counted.where("n > 1").drop("n"))
    near = _maybe(each, F.col("key"), several.select("key"))
    found = (
        near.join(several, "key")
        .withColumn("own", place == F.col("first"))
        .groupBy("id", "of")
        .agg(F.array_sort(F.collect_set(F.struct("key", "at", "own"))).alias("found"))
    )  # a document's own lines only
    # in order of keys and places, the first of a key is its first place in the document
    marked = F.transform("once", lambda p, k: F.struct(
        p["at"].alias("at"), p["own"].alias("own"),
        (p["own"] & F.coalesce(F.get("once", k - 1)["key"] != p["key"], F.lit(True))).alias("stays")))
    return _with(found, "once", F.col("found")).select("id", "of", marked.alias("found"))


def _met(found: Column) -> Column:
    """Indices of the lines in these pairs, in order, each once."""
    both = F.concat(F.transform(found, lambda p: p["at"]), F.transform(found, lambda p: p["at"] + 1))
    return F.array_sort(F.array_distinct(both))


def _clashing(touched: DataFrame) -> DataFrame:
    """Hashes of lines and of pairs under which different ones meet; there are hardly ever any."""
    spelled = F.transform(_met(F.col("found")), lambda i: F.struct(
        _hash(F.get("l", i)).alias("key"), F.get("l", i).alias("bytes")))
    one = _several(touched.select(F.explode(spelled).alias("c")).select("c.*").distinct())
    both = touched.select(F.explode(_spelled_pairs()).alias("c")).select("c.key", "c.a", "c.b").distinct()
    return one.union(_several(both))


def _spelled_pairs() -> Column:
    """The pairs that were found, with the hash of each and of its lines."""
    spelled = lambda p, a, b: F.struct(p.alias("p"), a.alias("a"), b.alias("b"), F.xxhash64(a, b).alias("key"))
    return F.transform("found", lambda p: spelled(p, _hash(F.get("l", p["at"])), _hash(F.get("l", p["at"] + 1))))


def _without(touched: DataFrame, clashing: DataFrame) -> DataFrame:
    """The same, where what meets under a clashing hash is no match."""
    each = touched.select("id", "of", F.explode(_spelled_pairs()).alias("x")).select("id", "of", "x.*")
    for side in ("a", "b", "key"):
        each = each.join(clashing.withColumnRenamed("key", side), side, "left_anti")
    found = each.groupBy("id", "of").agg(F.collect_set("p").alias("found"))
    mine = touched.drop("found").withColumnsRenamed({"id": "i", "of": "t"})
    return mine.join(found, mine["i"].eqNullSafe(found["id"]) & (mine["t"] == found["of"])).select("id", "of", "l", "found")


def _pieces(at: str, of_lines: str) -> Column:
    """Runs of consecutive indices as ``start`` and ``stop``, but for those of few bytes."""
    u = F.col(at)
    starts = F.filter(u, lambda x, i: (i == 0) | (F.get(u, i - 1) != x - 1))
    ends = F.filter(u, lambda x, i: (i == F.size(u) - 1) | (F.get(u, i + 1) != x + 1))
    spans = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop")))
    return F.filter(spans, lambda c: F.octet_length(_chunk(of_lines, c["start"], c["stop"])) >= LEAST_BYTES)


def clean(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents' lines, and those documents that have repeated ones, cleaned.

    First: ``id``, ``of`` (a hash of the text), ``before`` (its MD5), ``h`` (hashes of its lines),
    ``seeds``. Second: ``id``, ``of``, ``cleaned``, ``n_removed`` lines and the bytes that are
    ``copied`` from documents before it, once for each id and text. Places are ordered by id, then line; a null id comes first. Rows that
    repeat an id and a text are one document, so that repeating a row removes nothing.
    Null and empty texts have no lines; texts of any length are taken whole. Pieces of fewer
    than 40 bytes stay. Other columns are not looked at. An empty table gives empty ones.
    """
    known = cut(hashed(docs))
    path = new_folder(docs.sparkSession, f"lines-{uuid.uuid4().hex[:8]}")
    distinct = known.select("id", "of", "h", "seeds")
    repeats = not distinct.groupBy("id", "of").count().where("count > 1").isEmpty()
    once = lambda rows: rows.dropDuplicates(["id", "of"]) if repeats else rows
    mine = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("of"), "text")
    fetched = once(_of_documents(mine, cut(matched(once(distinct)))))
    fetched.select("id", "of", lines(F.col("text")).alias("l"), "found").write.option("compression", "zstd").parquet(path)
    touched = docs.sparkSession.read.parquet(path)
    clashing = cut(_clashing(touched))
    if not clashing.isEmpty():
        touched = _without(touched, clashing)
    gone = _met(F.filter("found", lambda p: ~p["stays"]))
    elsewhere = _met(F.filter("found", lambda p: ~p["own"]))
    held = _with(touched.select("id", "of", "l", "found"), "met", F.struct(gone.alias("at"), elsewhere.alias("elsewhere")))
    held = held.select("id", "of", "l", "met.*")
    held = _with(held, "gone", _pieces("at", "l"))
    # lines between the pieces that go: from the end of one to the start of the next
    bounds = F.concat(
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("stop"))), F.col("gone"),
        F.array(F.struct(F.size("l").alias("start"), F.size("l").alias("stop"))),
    )
    kept = _let(bounds, lambda found: F.transform(
        F.sequence(F.lit(1), F.size(found) - 1),
        lambda i: _chunk("l", F.get(found, i - 1)["stop"], F.get(found, i)["start"]),
    ))
    removed = F.aggregate("gone", F.lit(0), lambda n, c: n + c["stop"] - c["start"])
    copied = F.aggregate("elsewhere", F.lit(0).cast("long"), lambda n, i: n + F.octet_length(F.get("l", i)))
    return known, held.select(
        "id", "of", F.array_join(kept, "").alias("cleaned"), removed.cast("long").alias("n_removed"), copied.alias("copied")
    )


def cleaned_documents(docs: DataFrame, most_copied: float = 1.0) -> DataFrame:
    """All documents with the same columns, their texts cleaned and ``n_chars`` counted anew.

    Documents that nothing is left of are dropped, and those of which more than a share of
    ``most_copied`` of their bytes stands in documents before them. Null and empty ones stay.
    """
    _, cleaned = clean(docs)
    # input columns travel in one, so that no name of theirs meets one of these
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    row = packed["row"]
    cleaned = cleaned.where("n_removed > 0")
    same = row["doc_id"].eqNullSafe(cleaned["id"]) & (F.xxhash64(row["text"]) == cleaned["of"])
    few = F.col("copied") <= F.octet_length(row["text"]) * most_copied
    left = F.col("cleaned").isNull() | (F.col("cleaned") != "") & few
    joined = packed.join(cleaned, same, "left").where(left)
    new = {
        "text": F.coalesce("cleaned", row["text"]),
        "n_chars": F.when(F.col("cleaned").isNull(), row["n_chars"]).otherwise(F.length("cleaned")),
    }
    return joined.select(*[(new[c] if c in new else row[c]).alias(c) for c in docs.columns])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the cleaned text's MD5 of all documents."""
    known, cleaned = clean(table(spark, sf_dir, "documents"))
    after = cleaned.select(
        F.col("id").alias("i"), F.col("of").alias("t"), "n_removed", F.md5("cleaned").alias("after")
    )
    rows = known.select("id", "of", "before", F.size("h").cast("long").alias("n_lines"))
    same = rows["id"].eqNullSafe(after["i"]) & (rows["of"] == after["t"])
    return rows.join(after, same, "left").select(
        F.col("id").alias("doc_id"),
        "n_lines",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("after", "before").alias("cleaned_md5"),
    )


#: The same in SQL.
ORACLE_OP6 = f"""
with doc as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*?(?:\\n|[.!?] )|[^\\n]+') as l from documents),
hashed as (
  select *, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 7))::bigint) as h from doc),
rolled as (
  select *, list_transform(range(1, len(l) + 1),
    lambda i: (coalesce(h[i - 1], 0) * {FACTOR} + h[i]) % {MODULUS}) as v from hashed),
started as (
  select *, list_filter(range(1, len(l) + 1),
    lambda i: i = 1 or (v[i] < v[i - 1] and v[i] < coalesce(v[i + 1], {MODULUS}))) as s from rolled),
seed as (
  select r, l[s[k]] as a, l[s[k] + 1] as b
  from (select r, l, s, unnest(range(1, len(s) + 1)) as k from started)
  where coalesce(s[k + 1], len(l) + 1) - s[k] >= {LEAST_LINES}),
seeded as (select distinct r from (select r, count(*) over (partition by a, b) as n from seed) where n > 1),
pair as (
  select r, doc_id, i, l[i] as a, l[i + 1] as b
  from (select r, doc_id, l, unnest(range(1, len(l))) as i from doc where r in (select r from seeded))),
ranked as (select *, row_number() over (partition by a, b order by doc_id nulls first, i) as place from pair),
met as (select distinct r, unnest([i, i + 1]) as i from ranked where place > 1),
line as (select r, i, l[i] as x from (select r, l, unnest(range(1, len(l) + 1)) as i from doc)),
run as (
  select r, i, x, i - row_number() over (partition by r order by i) as g from met join line using (r, i)),
gone as (
  select r, i from (select r, i, sum(strlen(x)) over (partition by r, g) as bytes from run) where bytes >= {LEAST_BYTES}),
kept as (select r, string_agg(x, '' order by i) as text from line anti join gone using (r, i) group by r),
removed as (select r, count(*) as n from gone group by r)
select doc_id, len(l)::bigint as n_lines, coalesce(n, 0)::bigint as n_removed, md5(coalesce(kept.text, '')) as cleaned_md5
from doc left join removed using (r) left join kept using (r)
"""
