"""Sorting messages into accepted rows and rejects with a reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import names, schemas
from rillstone.functions.keys import KeyColumn, field, lift
from rillstone.operators.parse import as_only_element, closes_nothing, once, position_columns

_SEEN, _ONLY, _BROKEN = "__seen", "__only", "__broken"
# What counts as blank: no character above the space.
_BLANK = r"^[\x00-\x20]*$"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": names.CORRUPT}


def lacks_required(value: Column, declared: T.DataType) -> Column | None:
    """True where a field declared non-null is NULL or absent.

    A field inside a nullable parent counts only when the parent is there.
    None when the type declares nothing as required.
    """
    if isinstance(declared, T.StructType):
        checks = []
        for part_of in declared.fields:
            part = value.getField(part_of.name)
            if not part_of.nullable:
                checks.append(part.isNull())
            inner = lacks_required(part, part_of.dataType)
            if inner is not None:
                checks.append(part.isNotNull() & inner)
        return _any(checks)
    if isinstance(declared, T.ArrayType):
        return _any_element(value, declared.elementType, declared.containsNull)
    if isinstance(declared, T.MapType):
        return _any_element(
            F.map_values(value), declared.valueType, declared.valueContainsNull
        )
    return None


def _any(checks: list[Column]) -> Column | None:
    if not checks:
        return None
    found = checks[0]
    for check in checks[1:]:
        found = found | check
    return found


def _any_element(items: Column, declared: T.DataType, nullable: bool) -> Column | None:
    if nullable and lacks_required(F.lit(None), declared) is None:
        return None

    def fails(item: Column) -> Column:
        inner = lacks_required(item, declared)
        checks = [] if nullable else [item.isNull()]
        if inner is not None:
            checks.append(item.isNotNull() & inner)
        return _any(checks)

    return F.coalesce(F.exists(items, fails), F.lit(False))


def seen(text: Column, schema: T.StructType) -> Column:
    """A message as parsed, with whatever follows it; for ``value_of`` and ``outcome_of``."""
    only = T.StructField(_ONLY, T.ArrayType(schemas.written(schema)))
    reading = T.StructType([only, T.StructField(names.CORRUPT, T.StringType())])
    return F.from_json(as_only_element(text, _ONLY), reading, _OPTIONS)


def value_of(parsed: Column, schema: T.StructType) -> Column:
    """The message as declared; NULL where it is none."""
    return schemas.resolved(F.get(parsed.getField(_ONLY), F.lit(0)), schema)


def is_broken(parsed: Column) -> Column:
    return parsed.getField(names.CORRUPT).isNotNull() | (F.size(parsed.getField(_ONLY)) != 1)


def outcome_of(
    value: str,
    broken: Column,
    text: Column,
    schema: T.StructType,
    keys: list[KeyColumn],
    target: T.StructType | None,
) -> Column:
    """The outcome of a message whose value is the named column; the first that holds counts."""
    parsed = F.col(f"`{value}`")
    blank = text.isNull() | parsed.isNull() & text.rlike(_BLANK)
    broken = broken | parsed.isNull() | F.contains(text, F.lit("]")) & ~closes_nothing(text)
    outcome = F.when(blank, names.NULL_VALUE).when(broken, names.MALFORMED)
    missing = lacks_required(parsed, schema)
    if missing is not None:
        outcome = outcome.when(missing, names.MISSING_REQUIRED)
    for key in keys:
        outcome = outcome.when(field(key.path, value).isNull(), names.MISSING_KEY)
    if target is not None:
        lost = schemas.loses(parsed, schema, target)
        if lost is not None:
            outcome = outcome.when(lost, names.NOT_CASTABLE)
    return outcome.otherwise(names.ACCEPTED)


def classify(
    texts: DataFrame,
    schema: T.StructType,
    keys: list[KeyColumn],
    target: T.StructType | None = None,
) -> DataFrame:
    """Parse every message and give it an outcome; no row is lost.

    ``null_value``: NULL or blank message. ``malformed``: not JSON of the declared
    types, or more than one JSON value. ``missing_required``: a non-null field is absent.
    ``missing_key``: a key is NULL, so that the row would be a version of nothing.
    ``not_castable``: a value has no counterpart in the ``target``'s type. Else
    ``accepted``. The first that holds counts.
    """
    position = position_columns(texts)
    read = texts.select(
        names.TIMESTAMP,
        F.col(names.VALUE).alias(names.VALUE_RAW),
        *position,
        once(seen(F.col(names.VALUE), schema)).alias(_SEEN),
    )
    parsed = read.select(
        names.TIMESTAMP,
        value_of(F.col(_SEEN), schema).alias(names.VALUE),
        names.VALUE_RAW,
        *position,
        is_broken(F.col(_SEEN)).alias(_BROKEN),
    )
    text = F.col(names.VALUE_RAW)
    outcome = outcome_of(names.VALUE, F.col(_BROKEN), text, schema, keys, target)
    return parsed.select(
        names.TIMESTAMP, names.VALUE, names.VALUE_RAW, *lift(keys), *position, outcome.alias(names.OUTCOME)
    )


class Topic(NamedTuple):
    """How the messages of one topic are declared, and the column that they become."""

    name: str
    column: str
    schema: T.StructType
    keys: list[KeyColumn]
    target: T.StructType | None


def classify_topics(texts: DataFrame, topics: list[Topic]) -> DataFrame:
    """``classify`` for records of several topics, told by the column ``topic``.

    Each message is parsed once, by its own topic's declaration, into the topic's column; the
    others are NULL. Messages of a topic that is not declared are ``undeclared_topic``.
    """
    position, topic = position_columns(texts), F.col(names.TOPIC)
    parses = [F.when(topic == t.name, seen(F.col(names.VALUE), t.schema)).alias(t.column) for t in topics]
    carried = [names.TIMESTAMP, names.TOPIC, *position]
    read = texts.select(
        *carried, F.col(names.VALUE).alias(names.VALUE_RAW), once(F.struct(*parses)).alias(_SEEN)
    )
    broken, values = F.lit(None).cast("boolean"), []
    for t in topics:
        parsed = F.col(_SEEN).getField(t.column)
        values.append(F.when(topic == t.name, value_of(parsed, t.schema)).alias(t.column))
        broken = F.when(topic == t.name, is_broken(parsed)).otherwise(broken)
    apart = read.select(*carried, names.VALUE_RAW, *values, broken.alias(_BROKEN))
    outcome = F.lit(names.UNDECLARED_TOPIC)
    for t in topics:
        own = outcome_of(t.column, F.col(_BROKEN), F.col(names.VALUE_RAW), t.schema, t.keys, t.target)
        outcome = F.when(topic == t.name, own).otherwise(outcome)
    columns = [F.col(f"`{t.column}`") for t in topics]
    return apart.select(*carried, names.VALUE_RAW, *columns, outcome.alias(names.OUTCOME))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(names.OUTCOME) == names.ACCEPTED).drop(names.OUTCOME)


def rejects(classified: DataFrame) -> DataFrame:
    """Dead letters: record time, original text, reason (and position)."""
    return classified.where(F.col(names.OUTCOME) != names.ACCEPTED).select(
        names.TIMESTAMP,
        names.VALUE_RAW,
        F.col(names.OUTCOME).alias("reason"),
        *position_columns(classified),
    )
