"""Schema drift seen in the messages themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import names, schemas
from rillstone.operators.parse import once


def drift_report(texts: DataFrame, old: T.StructType, new: T.StructType) -> DataFrame:
    """Each difference of two declared schemas, with the messages that carry it.

    ``messages`` counts messages with a value at the changed path, in arrays and maps
    those with one in some element. One parse and one aggregation for all differences;
    only counters are shuffled.
    """
    changes = schemas.diff(old, new)
    both = schemas.merge(old, new)
    parsed = texts.select(
        once(F.from_json(F.col(names.VALUE), both, {"mode": "PERMISSIVE"})).alias(names.VALUE)
    )
    if not changes:
        return schemas.diff_frame(texts.sparkSession, []).withColumn(
            "messages", F.lit(0).cast("bigint")
        )
    counts = [
        F.count_if(_present(F.col(names.VALUE), both, change.steps)).alias(f"c{number}")
        for number, change in enumerate(changes)
    ]
    entries = [
        F.struct(
            F.lit(change.path).alias("path"),
            F.lit(change.kind).alias("kind"),
            F.lit(change.old_type).cast("string").alias("old_type"),
            F.lit(change.new_type).cast("string").alias("new_type"),
            F.col(f"c{number}").alias("messages"),
        )
        for number, change in enumerate(changes)
    ]
    return parsed.agg(*counts).select(F.inline(F.array(*entries)))


def _present(value: Column, kind: T.DataType, steps: tuple[str, ...]) -> Column:
    """Whether a message has a value at the path: in arrays and maps, in some element."""
    if not steps:
        return value.isNotNull()
    step, rest = steps[0], steps[1:]
    if isinstance(kind, T.StructType):
        field = schemas.by_name(kind)[step.lower()]
        return _present(value.getField(field.name), field.dataType, rest)
    if isinstance(kind, T.ArrayType):
        return F.exists(value, lambda x: _present(x, kind.elementType, rest))
    if step == schemas.KEY:
        return F.exists(F.map_keys(value), lambda x: _present(x, kind.keyType, rest))
    return F.exists(F.map_values(value), lambda x: _present(x, kind.valueType, rest))
