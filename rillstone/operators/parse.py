"""Records to structured rows: narrow projections only, one JSON parse per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import names, schemas
from rillstone.functions.keys import KeyColumn, key_names, lift


def reduce_records(records: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """Record time and message text, with the record's position when it has one, and the
    ``kept`` columns."""
    position = [
        F.col(source).alias(target)
        for source, target in zip(("partition", "offset"), names.POSITION)
        if source in records.columns
    ]
    return records.select(
        names.TIMESTAMP, F.col(names.VALUE).cast("string").alias(names.VALUE), *position, *kept
    )


def once(value: Column) -> Column:
    """An expression as a one-element ``explode``.

    Catalyst copies a projected expression into any filter above it, and would
    parse every message twice. A generator's output is never copied, so the
    parse runs once whatever is selected or filtered later.
    """
    return F.explode(F.array(value))


def as_only_element(text: Column, name: str) -> Column:
    """The text as the one element of an array, so that the parse sees what stands behind it.

    ``from_json`` stops behind the first value. Here, text that follows breaks the array, or makes
    a second element of it; but for a closing bracket, behind which the rest may be
    anything: see ``closes_nothing``.
    """
    return F.concat(F.lit(f'{{"{name}":['), text, F.lit("]}"))


def closes_nothing(text: Column) -> Column:
    """Whether a text that begins with a JSON value does not go on with a closing bracket.

    As the value of a field, the text may be followed by a closing brace or a further field,
    but not by a bracket. Only tokens are read, and only texts with a bracket need this.
    """
    return F.json_object_keys(F.concat(F.lit('{"":'), text, F.lit("}"))).isNotNull()


def position_columns(df: DataFrame) -> list[str]:
    return [name for name in names.POSITION if name in df.columns]


def structured(texts: DataFrame, schema: T.StructType, keys: list[KeyColumn]) -> DataFrame:
    """Parse against the declared schema, failing on the first bad message.

    Columns: record time, parsed value, original text, key columns, position.
    """
    position = position_columns(texts)
    parsed = texts.select(
        names.TIMESTAMP,
        F.col(names.VALUE).alias(names.VALUE_RAW),
        *position,
        once(F.from_json(F.col(names.VALUE), schemas.written(schema), {"mode": "FAILFAST"})).alias(names.VALUE),
    )
    value = schemas.resolved(F.col(names.VALUE), schema).alias(names.VALUE)
    resolved = parsed.select(names.TIMESTAMP, value, names.VALUE_RAW, *position)
    return resolved.select(
        names.TIMESTAMP, names.VALUE, names.VALUE_RAW, *lift(keys), *position
    )


def raw_rows(rows: DataFrame, keys: list[KeyColumn]) -> DataFrame:
    """Raw archive shape: record time, keys as strings, original text."""
    return rows.select(
        names.TIMESTAMP,
        *[F.col(name).cast("string").alias(name) for name in key_names(keys)],
        names.VALUE_RAW,
    )


def flatten(rows: DataFrame) -> DataFrame:
    """One column per message field, beside record time, keys and position.

    The payload may itself have a field called ``value``; it replaces the struct.
    """
    fields = rows.schema[names.VALUE].dataType.names
    payload = [F.col(f"{names.VALUE}.`{name}`").alias(name) for name in fields]
    carried = [
        name
        for name in rows.columns
        if name not in (names.VALUE, names.VALUE_RAW) and name not in fields
    ]
    return rows.select(*payload, *carried)
