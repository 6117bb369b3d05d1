"""Primary keys: declaration, naming and lifting out of the parsed value."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import names


class KeyColumn(NamedTuple):
    """A key field: its path inside the message and the column it becomes."""

    path: str
    name: str


def split_keys(declared: str) -> list[KeyColumn]:
    """Split a comma-separated key declaration.

    Blanks around a key are dropped. A nested path ``a.b`` becomes the column
    ``a_b`` in every table, so the formatted and the raw table always agree.
    """
    paths = [part.strip() for part in declared.split(",")]
    if not all(paths):
        raise ValueError(f"empty primary key in {declared!r}")
    keys = [KeyColumn(path, path.replace(".", "_")) for path in paths]
    column_names = [key.name.lower() for key in keys]
    if len(set(column_names)) != len(column_names):
        raise ValueError(f"primary keys collide: {declared!r}")
    for key in keys:
        if key.name.lower() in {*names.RESERVED, names.VALUE}:
            raise ValueError(f"{key.name!r} is reserved and cannot be a primary key")
    return keys


def key_type(schema: T.StructType, path: str) -> T.DataType:
    """The declared type of a key path; refuses unknown and non-atomic fields."""
    current: T.DataType = schema
    for step in path.split("."):
        if not isinstance(current, T.StructType) or step not in current.names:
            raise ValueError(f"primary key {path!r} is not in the declared schema")
        current = current[step].dataType
    if isinstance(current, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        raise ValueError(f"primary key {path!r} has no atomic type: {current.simpleString()}")
    return current


def check_keys(keys: list[KeyColumn], schema: T.StructType) -> None:
    """Refuse keys that do not exist or whose column would hide a payload field."""
    for key in keys:
        key_type(schema, key.path)
        if key.name != key.path and key.name.lower() in {n.lower() for n in schema.names}:
            raise ValueError(f"key column {key.name!r} collides with a payload field")


def field(path: str, parent: str = names.VALUE) -> Column:
    """Reference to ``path`` below ``parent``, safe for unusual field names."""
    steps = [parent, *path.split(".")]
    return F.col(".".join(f"`{step}`" for step in steps))


def lift(keys: list[KeyColumn]) -> list[Column]:
    """The key columns, typed as declared."""
    return [field(key.path).alias(key.name) for key in keys]


def key_names(keys: list[KeyColumn]) -> list[str]:
    return [key.name for key in keys]
