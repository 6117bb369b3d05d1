"""Declared schemas: loading, checking, extending, comparing, evolving."""

from __future__ import annotations

import base64
import copy
import datetime
import decimal
import json
import re
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import names

# The placeholder forms of declared reference types.
REF_PATTERN = r"REF_\w+"
REF_PREFIX = "REF_"
REF_NAME = "REF_NAME"

# Steps into arrays and maps.
ELEMENT, KEY, VALUE = "element", "key", "value"


def from_document(document: dict[str, Any]) -> T.StructType:
    """Schema from Spark's JSON form; refuses reserved names and names that Spark,
    which ignores case, could not tell apart."""
    schema = T.StructType.fromJson(document)
    taken = sorted(name for name in schema.names if name.lower() in names.RESERVED)
    if taken:
        raise ValueError(f"payload fields use reserved names: {', '.join(taken)}")
    if len({name.lower() for name in schema.names}) < len(schema.names):
        raise ValueError(f"payload fields differ in case only: {', '.join(schema.names)}")
    return schema


def extend_target(schema: T.StructType) -> T.StructType:
    """The formatted table's schema: target fields, record time, current flag."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField(names.TIMESTAMP, T.TimestampType(), True),
            T.StructField(names.CURRENT, T.StringType(), True),
        ]
    )


# ---------------------------------------------------------------- differences


class Change(NamedTuple):
    """A difference; ``steps`` lead to it through fields, ``element``, ``key``, ``value``."""

    steps: tuple[str, ...]
    kind: str
    old_type: str | None
    new_type: str | None

    @property
    def path(self) -> str:
        return ".".join(self.steps) or "*"


CHANGE_SCHEMA = "path string, kind string, old_type string, new_type string"


def by_name(schema: T.StructType) -> dict[str, T.StructField]:
    """Fields by name as Spark tells them apart, which ignores case."""
    return {field.name.lower(): field for field in schema.fields}


def diff(old: T.StructType, new: T.StructType) -> list[Change]:
    """Every difference between two declared schemas, in field order.

    Names are compared as Spark does, without case. Kinds: ``added``, ``removed``,
    ``type_changed``, ``renamed`` (in case only), ``nullability``, ``order``.
    """
    return _diff_struct(old, new, ())


def _diff_struct(old: T.StructType, new: T.StructType, at: tuple[str, ...]) -> list[Change]:
    changes: list[Change] = []
    before_of, after_of = by_name(old), by_name(new)
    for name, before in before_of.items():
        steps = (*at, before.name)
        if name not in after_of:
            changes.append(Change(steps, "removed", before.dataType.simpleString(), None))
            continue
        after = after_of[name]
        if after.name != before.name:
            changes.append(Change(steps, "renamed", before.name, after.name))
        changes += _diff_type(before.dataType, after.dataType, steps)
        changes += _diff_null(before.nullable, after.nullable, steps)
    for name, after in after_of.items():
        if name not in before_of:
            changes.append(Change((*at, after.name), "added", None, after.dataType.simpleString()))
    kept_old = [name for name in before_of if name in after_of]
    kept_new = [name for name in after_of if name in before_of]
    if kept_old != kept_new:
        order = [",".join(of[name].name for name in kept) for of, kept in ((before_of, kept_old), (after_of, kept_new))]
        changes.append(Change(at, "order", *order))
    return changes


def _diff_type(old: T.DataType, new: T.DataType, at: tuple[str, ...]) -> list[Change]:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _diff_struct(old, new, at)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = (*at, ELEMENT)
        return _diff_type(old.elementType, new.elementType, inner) + _diff_null(
            old.containsNull, new.containsNull, inner
        )
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        inner = (*at, VALUE)
        return (
            _diff_type(old.keyType, new.keyType, (*at, KEY))
            + _diff_type(old.valueType, new.valueType, inner)
            + _diff_null(old.valueContainsNull, new.valueContainsNull, inner)
        )
    if old != new:
        return [Change(at, "type_changed", old.simpleString(), new.simpleString())]
    return []


def _diff_null(old: bool, new: bool, at: tuple[str, ...]) -> list[Change]:
    if old == new:
        return []
    text = {True: "nullable", False: "required"}
    return [Change(at, "nullability", text[old], text[new])]


def diff_frame(spark: SparkSession, changes: list[Change]) -> DataFrame:
    """The difference report as a DataFrame."""
    return spark.createDataFrame([(c.path, *c[1:]) for c in changes], CHANGE_SCHEMA)


class IncompatibleSchema(ValueError):
    """A declared change that existing rows cannot follow."""


def require_compatible(changes: list[Change]) -> None:
    bad = [change for change in changes if change.kind in ("type_changed", "renamed")]
    if bad:
        detail = "; ".join(f"{c.path}: {c.old_type} -> {c.new_type}" for c in bad)
        raise IncompatibleSchema(f"changed types and names need a new table: {detail}")


def merge(old: T.StructType, new: T.StructType) -> T.StructType:
    """Table schema after an evolution: old columns stay, new ones are appended."""
    before_of, after_of = by_name(old), by_name(new)
    fields = [
        _merge_field(before, after_of[name]) if name in after_of else before
        for name, before in before_of.items()
    ]
    added = [after for name, after in after_of.items() if name not in before_of]
    return T.StructType(fields + added)


def _merge_field(old: T.StructField, new: T.StructField) -> T.StructField:
    merged = _merge_type(old.dataType, new.dataType)
    return T.StructField(old.name, merged, old.nullable or new.nullable, new.metadata)


def _merge_type(old: T.DataType, new: T.DataType) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(
            _merge_type(old.elementType, new.elementType), old.containsNull or new.containsNull
        )
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(
            old.keyType,
            _merge_type(old.valueType, new.valueType),
            old.valueContainsNull or new.valueContainsNull,
        )
    return old


# ------------------------------------------------------------------ conversion


def same_shape(have: T.DataType, want: T.DataType) -> bool:
    """Equal but for what may be null."""
    return have.simpleString() == want.simpleString()


def shaped(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in another type: fields meet by name, absent ones are NULL, surplus ones go.

    A leaf that cannot be converted becomes NULL; ``loses`` tells where.
    """
    if same_shape(have, want):
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = by_name(have)
        fields = [
            shaped(value.getField(known[f.name.lower()].name), known[f.name.lower()].dataType, f.dataType)
            if f.name.lower() in known
            else F.lit(None).cast(f.dataType)
            for f in want.fields
        ]
        whole = F.struct(*[part.alias(f.name) for part, f in zip(fields, want.fields)])
        return F.when(value.isNotNull(), whole)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: shaped(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):

        def entry(e: Column) -> Column:
            return F.struct(
                shaped(e["key"], have.keyType, want.keyType).alias("key"),
                shaped(e["value"], have.valueType, want.valueType).alias("value"),
            )

        return F.map_from_entries(F.transform(F.map_entries(value), entry))
    _require_leaves(have, want)
    return value.try_cast(want)


def _require_leaves(have: T.DataType, want: T.DataType) -> None:
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(want, nested) or (isinstance(have, nested) and not isinstance(want, T.StringType)):
        raise IncompatibleSchema(f"{have.simpleString()} cannot become {want.simpleString()}")


def loses(value: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """True where a value that is there has no counterpart in the other type.

    None where that cannot be.
    """
    if same_shape(have, want):
        return None
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = by_name(have)
        found = None
        for f in want.fields:
            if f.name.lower() in known:
                own = known[f.name.lower()]
                lost = loses(value.getField(own.name), own.dataType, f.dataType)
                if lost is not None:
                    found = lost if found is None else found | lost
        return found
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return _some(value, have.elementType, want.elementType)
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        parts = [
            _some(F.map_keys(value), have.keyType, want.keyType),
            _some(F.map_values(value), have.valueType, want.valueType),
        ]
        parts = [part for part in parts if part is not None]
        return None if not parts else parts[0] if len(parts) == 1 else parts[0] | parts[1]
    _require_leaves(have, want)
    return value.isNotNull() & value.try_cast(want).isNull()


def _some(items: Column, have: T.DataType, want: T.DataType) -> Column | None:
    if loses(F.lit(None), have, want) is None:
        return None
    return F.coalesce(F.exists(items, lambda x: loses(x, have, want)), F.lit(False))


# ------------------------------------------------------------ Avro declarations


def expand_refs(schema: Any, template: Any) -> Any:
    """Replace each placeholder string of an Avro schema by the named template.

    Only whole strings are placeholders, and the template's own content is not
    expanded again.
    """
    if isinstance(schema, dict):
        return {name: expand_refs(part, template) for name, part in schema.items()}
    if isinstance(schema, list):
        return [expand_refs(part, template) for part in schema]
    if isinstance(schema, str) and re.fullmatch(REF_PATTERN, schema):
        return _named(template, schema.removeprefix(REF_PREFIX))
    return copy.deepcopy(schema)


def _named(template: Any, name: str) -> Any:
    if isinstance(template, dict):
        return {key: _named(part, name) for key, part in template.items()}
    if isinstance(template, list):
        return [_named(part, name) for part in template]
    return template.replace(REF_NAME, name) if isinstance(template, str) else template


# Unions of these members still have one JSON form; Spark widens them.
_WIDENED_UNIONS = ({"int", "long"}, {"float", "double"})


def _refuse_tagged_unions(schema: Any) -> None:
    if isinstance(schema, dict):
        for name in ("type", "items", "values"):
            _refuse_tagged_unions(schema.get(name))
        for part in schema.get("fields", []):
            _refuse_tagged_unions(part)
    elif isinstance(schema, list):
        members = [part for part in schema if part != "null"]
        plain = {part for part in members if isinstance(part, str)}
        if len(members) > 1 and not (len(plain) == len(members) and plain in _WIDENED_UNIONS):
            raise ValueError(f"union has several JSON forms: {json.dumps(schema)}")
        for part in members:
            _refuse_tagged_unions(part)


def from_avro(spark: SparkSession, schema: dict[str, Any]) -> T.StructType:
    """Spark schema of an Avro record declaration, by Spark's own converter."""
    _refuse_tagged_unions(schema)
    jvm = spark._jvm
    avro = jvm.org.apache.avro.Schema.Parser().parse(json.dumps(schema))
    converted = jvm.org.apache.spark.sql.avro.SchemaConverters.toSqlType(avro).dataType()
    return from_document(json.loads(_annotated(converted, schema)))


# Field metadata: names under which writers knew a field, and its default as JSON.
ALIASES, DEFAULT = "avro.aliases", "avro.default"


def _annotated(converted: Any, schema: dict[str, Any]) -> str:
    """The converted type as JSON, with the aliases and defaults of the declaration."""
    found = json.loads(converted.json())
    _annotate(found, schema, {})
    return json.dumps(found)


def _annotate(found: Any, schema: Any, named: dict[str, Any]) -> None:
    schema = _one_type(schema, named)
    if not isinstance(schema, dict):
        return
    if schema.get("name"):
        named[schema["name"]] = schema
    if schema["type"] == "record":
        for field, declared in zip(found["fields"], schema["fields"]):
            # a record that contains itself has been refused by the converter
            _annotate(field["type"], declared["type"], named)
            if declared.get("aliases"):
                field["metadata"][ALIASES] = list(declared["aliases"])
            if declared.get("default") is not None:
                field["metadata"][DEFAULT] = json.dumps(_as_message(declared["default"], declared["type"], named))
    elif schema["type"] == "array":
        _annotate(found["elementType"], schema["items"], named)
    elif schema["type"] == "map":
        _annotate(found["valueType"], schema["values"], named)
    elif isinstance(schema["type"], (dict, list)):
        _annotate(found, schema["type"], named)


def _one_type(schema: Any, named: dict[str, Any]) -> Any:
    """The type itself: of a union the member that is not null, of a name what it stands for."""
    if isinstance(schema, list):
        members = [part for part in schema if part != "null"]
        return _one_type(members[0], named) if members else "null"
    return named.get(schema, schema) if isinstance(schema, str) else schema


def _as_message(default: Any, schema: Any, named: dict[str, Any]) -> Any:
    """A default in the form that messages have: Avro gives times as numbers and bytes as text."""
    kind = _one_type(schema, named)
    logical = kind.get("logicalType") if isinstance(kind, dict) else None
    base = kind["type"] if isinstance(kind, dict) else kind
    if logical == "date":
        return (datetime.date(1970, 1, 1) + datetime.timedelta(days=default)).isoformat()
    if logical and "timestamp" in logical:
        unit = 1000 if logical.endswith("millis") else 1
        moment = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=default * unit)
        return moment.isoformat(timespec="microseconds") + ("" if logical.startswith("local") else "Z")
    if logical == "decimal":
        unscaled = int.from_bytes(default.encode("latin-1"), "big", signed=True)
        return str(decimal.Decimal(unscaled).scaleb(-kind.get("scale", 0)))
    if base in ("bytes", "fixed"):
        return base64.b64encode(default.encode("latin-1")).decode()
    if base == "record":
        parts = {f["name"]: f for f in kind["fields"]}
        return {name: _as_message(part, parts[name]["type"], named) for name, part in default.items() if name in parts}
    if base == "array":
        return [_as_message(part, kind["items"], named) for part in default]
    if base == "map":
        return {name: _as_message(part, kind["values"], named) for name, part in default.items()}
    return default


# ---------------------------------------------------- from a writer to the reader


def _has_rules(kind: T.DataType) -> bool:
    """Whether a field at some depth has aliases or a default."""
    if isinstance(kind, T.StructType):
        return any({ALIASES, DEFAULT} & {*(f.metadata or {})} or _has_rules(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_rules(kind.elementType)
    return isinstance(kind, T.MapType) and _has_rules(kind.valueType)


def written(kind: T.DataType) -> T.DataType:
    """The declared type with a field for each name that a writer may have used."""
    if isinstance(kind, T.StructType):
        taken, fields = {*by_name(kind)}, []
        for f in kind.fields:
            own = written(f.dataType)
            fields.append(T.StructField(f.name, own, f.nullable))
            for alias in (f.metadata or {}).get(ALIASES, []):
                if alias.lower() not in taken:
                    taken.add(alias.lower())
                    fields.append(T.StructField(alias, own))
        return T.StructType(fields)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(written(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, written(kind.valueType), kind.valueContainsNull)
    return kind


def resolved(value: Column, kind: T.DataType) -> Column:
    """A value as written, as the reader declares it.

    A field has the value found under its own name, or else under the first of its aliases
    that has one, or else its default; at any depth, where the record around it is there. A
    message does not tell a null from an absent field: both get the default. Numbers were
    parsed in the reader's type, which widens those of a narrower writer.
    """
    if not _has_rules(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: resolved(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: resolved(x, kind.valueType))
    present, parts = by_name(written(kind)), []
    declared = {*by_name(kind)}
    for f in kind.fields:
        rules = f.metadata or {}
        names = [f.name] + [a for a in rules.get(ALIASES, []) if a.lower() not in declared]
        found = [resolved(value.getField(present[name.lower()].name), f.dataType) for name in names]
        if DEFAULT in rules:
            wrapped = F.lit(f'{{"d":{rules[DEFAULT]}}}')
            # the default, too, is as some writer would have written it
            given = F.from_json(wrapped, T.StructType([T.StructField("d", written(f.dataType))])).getField("d")
            found.append(resolved(given, f.dataType))
        parts.append((F.coalesce(*found) if len(found) > 1 else found[0]).alias(f.name))
    return F.when(value.isNotNull(), F.struct(*parts))
