"""What messages really hold, against what is declared.

Every message is parsed once without a schema, to its shape: the fields and types it has, at
any depth. Messages of one shape are counted before anything is shuffled; shapes are then
taken apart into fields, so that work after the parse goes with the number of shapes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import names
from rillstone.workspace import new_folder

# Steps of a path: into the elements of an array, and into the values of a map.
ELEMENT, ENTRY = "[]", "{}"

# Kinds of what was observed.
AS_DECLARED, UNDECLARED, OTHER_TYPE, UNSEEN, UNREADABLE = (
    "as_declared", "undeclared", "other_type", "unseen", "unreadable",
)

# Type names of shapes, and of null.
_NULL, _MIXED = "VOID", "VARIANT"
_WHOLE_NUMBERS, _NUMBERS = {"BIGINT"}, {"BIGINT", "DECIMAL", "DOUBLE"}

_FIELDS = "path string, found string, n long"


def parse_shape(shape: str) -> tuple:
    """A shape as ``(type, parts)``: fields of an object by name, the element of an array."""
    parsed, end = _parse(shape, 0)
    if end != len(shape):
        raise ValueError(f"not a shape: {shape!r}")
    return parsed


def _parse(text: str, at: int) -> tuple[tuple, int]:
    end = at
    while end < len(text) and (text[end].isalnum() or text[end] == "_"):
        end += 1
    kind = text[at:end]
    if kind == "OBJECT":
        fields, at = {}, end + 1  # behind <
        while text[at] != ">":
            name, at = _name(text, at)
            fields[name], at = _parse(text, at + 2)  # behind ": "
            if text.startswith(", ", at):
                at += 2
        return (kind, fields), at + 1
    if kind == "ARRAY":
        element, at = _parse(text, end + 1)
        return (kind, element), at + 1
    if text.startswith("(", end):  # precision and scale
        end = text.index(")", end) + 1
    return (kind, None), end


def _name(text: str, at: int) -> tuple[str, int]:
    if text[at] != "`":
        end = text.index(":", at)
        return text[at:end], end
    end = at + 1
    while text[end] != "`" or text.startswith("``", end):
        end += 2 if text[end] == "`" else 1
    return text[at + 1 : end].replace("``", "`"), end + 1


def fields_of(shape: tuple, declared: T.DataType | None, path: str = "") -> Iterator[tuple[str, str]]:
    """Paths and types within a shape. Keys of a declared map are not fields of their own."""
    kind, parts = shape
    yield path, kind
    if kind == "OBJECT" and isinstance(declared, T.MapType):
        inner = {entry for part in parts.values() for entry in fields_of(part, declared.valueType, path + ENTRY)}
        yield from sorted(inner)
    elif kind == "OBJECT":
        known = {f.name: f.dataType for f in declared.fields} if isinstance(declared, T.StructType) else {}
        for name, part in parts.items():
            yield from fields_of(part, known.get(name), f"{path}.{name}" if path else name)
    elif kind == "ARRAY" and parts[0] != _NULL:
        element = declared.elementType if isinstance(declared, T.ArrayType) else None
        yield from fields_of(parts, element, path + ELEMENT)


def declared_fields(declared: T.DataType, path: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Every declared path below the root, with its type."""
    if path:
        yield path, declared
    if isinstance(declared, T.StructType):
        for f in declared.fields:
            yield from declared_fields(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(declared, T.ArrayType):
        yield from declared_fields(declared.elementType, path + ELEMENT)
    elif isinstance(declared, T.MapType):
        yield from declared_fields(declared.valueType, path + ENTRY)


def fits(found: str, declared: T.DataType) -> bool:
    """Whether values of a found type are of the declared one; text holds anything, and
    null is of every type. Whether a text is a date or a number fits is left to the parse."""
    if found == _NULL or isinstance(declared, (T.StringType, T.VariantType)):
        return True
    if isinstance(declared, (T.StructType, T.MapType)):
        return found == "OBJECT"
    if isinstance(declared, T.ArrayType):
        return found == "ARRAY"
    if isinstance(declared, T.IntegralType):
        return found in _WHOLE_NUMBERS
    if isinstance(declared, T.NumericType):
        return found in _NUMBERS
    return found == ("BOOLEAN" if isinstance(declared, T.BooleanType) else "STRING")


def observed_fields(texts: DataFrame, declared: T.StructType) -> DataFrame:
    """Fields of the messages in ``value``, with their types, and how many messages have them.

    A row for each path and type found, and for each declared path that no message has:
    ``path`` (``a.b``, ``a[]`` for elements, ``a{}`` for values of a declared map), ``kind``
    (as declared, undeclared, of another type, unseen), ``declared_type``, ``observed_type``
    (NULL where unseen), ``types`` (how many types but null the path has), ``messages`` and
    their ``share`` of all that are not blank. Messages that are no JSON count under the empty
    path as unreadable. Elements of an array that differ in type are of type ``VARIANT``.
    """
    spark = texts.sparkSession
    text = F.col(names.VALUE)
    shape = F.schema_of_variant(F.try_parse_json(text)).alias("shape")
    counted = texts.where(F.trim(text) != "").select(shape).groupBy("shape").agg(F.count("*").alias("n"))
    folder = new_folder(spark, "shapes")
    counted.write.parquet(folder)
    shapes = spark.read.schema("shape string, n long").parquet(folder)
    total = shapes.agg(F.sum("n")).first()[0] or 0

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for one, n in zip(*(column.to_pylist() for column in batch.columns)):
                entries = [("", UNREADABLE)] if one is None else set(fields_of(parse_shape(one), declared))
                for entry in entries:
                    found[entry] = found.get(entry, 0) + n
            paths, kinds = zip(*found) if found else ((), ())
            columns = [pa.array(paths, pa.string()), pa.array(kinds, pa.string()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "found", "n"])

    fields = shapes.mapInArrow(take_apart, _FIELDS).groupBy("path", "found").agg(F.sum("n").alias("n"))
    # what was declared, as a table of as many rows: a schema lives on the driver anyway
    known = spark.createDataFrame(
        [(path, kind.simpleString(), [f for f in _FOUND if fits(f, kind)]) for path, kind in declared_fields(declared)],
        "declared_path string, declared_type string, fitting array<string>",
    )
    met = fields.where("path <> '' or found <> 'OBJECT'").join(known, F.col("path") == F.col("declared_path"), "full_outer")
    kind = (
        F.when(F.col("found") == UNREADABLE, UNREADABLE)
        .when(F.col("found").isNull(), UNSEEN)
        .when(F.col("path") == "", OTHER_TYPE)
        .when(F.col("declared_path").isNull(), UNDECLARED)
        .when(F.array_contains("fitting", F.col("found")), AS_DECLARED)
        .otherwise(OTHER_TYPE)
    )
    at_path = Window.partitionBy("path")
    messages = F.coalesce("n", F.lit(0))
    return met.select(
        F.coalesce("path", "declared_path").alias("path"), kind.alias("kind"), "declared_type",
        F.when(F.col("found") != UNREADABLE, F.col("found")).alias("observed_type"), messages.alias("messages"),
        (messages / F.lit(max(total, 1))).alias("share"),
    ).select(
        "path", "kind", "declared_type", "observed_type",
        F.count(F.when(F.col("observed_type") != _NULL, 1)).over(at_path).alias("types"),
        "messages", "share",
    )


# The types that shapes have.
_FOUND = ("OBJECT", "ARRAY", "STRING", "BIGINT", "DECIMAL", "DOUBLE", "BOOLEAN", _NULL, _MIXED)
