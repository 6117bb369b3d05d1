"""Fields seen in messages, and offsets stored."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.operators import observed, offsets

DECLARED = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("s", T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DateType())])),
        T.StructField("l", T.ArrayType(T.StructType([T.StructField("k", T.BooleanType())]))),
        T.StructField("m", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
        T.StructField("v", T.VariantType()),
    ]
)


def seen(spark, *messages):
    texts = spark.createDataFrame([(x if x is None or isinstance(x, str) else json.dumps(x),) for x in messages], "value string")
    return {
        (r.path, r.observed_type): (r.kind, r.messages, r.types, r.declared_type)
        for r in observed.observed_fields(texts, DECLARED).collect()
    }


def test_kinds(spark):
    got = seen(
        spark,
        {"a": 1, "s": {"x": 1, "y": "2024-01-01"}, "l": [{"k": True}], "m": {"p": [1], "q": [2]}, "v": {"w": 1}},
        {"a": "1", "s": {"x": 1.5, "z": None}, "l": [{"k": 1, "j": 2}, {}], "m": {"r": ["t"]}},
        {"a": None, "s": 5, "l": {}, "other": {"deep": [[{"x": 1}]]}},
        "no json", None, "  ", "[1]",
    )
    assert got["a", "BIGINT"][:3] == ("as_declared", 1, 2) and got["a", "STRING"][:3] == ("other_type", 1, 2)
    assert got["a", "VOID"][:3] == ("as_declared", 1, 2)
    assert got["s.x", "BIGINT"][0] == got["s.x", "DECIMAL"][0] == "as_declared"
    assert got["s.y", "STRING"] == ("as_declared", 1, 1, "date") and got["s.z", "VOID"][:2] == ("undeclared", 1)
    assert got["s", "BIGINT"][0] == got["l", "OBJECT"][0] == "other_type"
    assert got["l[].k", "BOOLEAN"][0] == "as_declared" and got["l[].k", "BIGINT"][0] == "other_type"
    assert got["l[].j", "BIGINT"][0] == "undeclared"
    # keys of a map are no fields
    assert got["m{}", "ARRAY"][:2] == ("as_declared", 2) and not any(p.startswith("m.") for p, _ in got)
    assert got["m{}[]", "BIGINT"][0] == "as_declared" and got["m{}[]", "STRING"][0] == "other_type"
    assert got["v", "OBJECT"][0] == "as_declared" and got["v.w", "BIGINT"][0] == "undeclared"
    assert got["other.deep[][].x", "BIGINT"][:2] == ("undeclared", 1)
    assert got["", None][:2] == ("unreadable", 1) and got["", "ARRAY"][:2] == ("other_type", 1)


def test_nothing_seen(spark):
    got = seen(spark)
    assert {kind for kind, *_ in got.values()} == {"unseen"} and ("s.y", None) in got


name = st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), min_size=1, max_size=5)
values = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text("ab", max_size=2),
    lambda inner: st.dictionaries(name, inner, max_size=3) | st.lists(inner, max_size=1),
    max_leaves=8,
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(name, values, max_size=4))
def test_shapes_of_any_names(spark, value):
    """Paths of a message are those of its value, whatever characters names have."""
    text = spark.createDataFrame([(json.dumps(value),)], "value string")
    shape = text.select(F.schema_of_variant(F.try_parse_json("value"))).first()[0]

    def paths(x, path=""):
        yield path
        if isinstance(x, dict):
            for key, part in x.items():
                yield from paths(part, f"{path}.{key}" if path else key)
        if isinstance(x, list) and x and x[0] is not None:
            yield from paths(x[0], path + "[]")

    assert {p for p, _ in observed.fields_of(observed.parse_shape(shape), None)} == set(paths(value))


# --------------------------------------------------------------------- offsets


def positions(spark, held):
    return spark.createDataFrame(held, "record_partition int, record_offset long")


def report(spark, held, block):
    found = offsets.offset_report(positions(spark, held), block).collect()
    return sorted((r.record_partition, r.kind, r.first_offset, r.last_offset, r.rows) for r in found)


def plain_report(held):
    out = []
    for part in {p for p, o in held if p is not None and o is not None}:
        mine = [o for p, o in held if p == part and o is not None]
        have = sorted(set(mine))
        out += [(part, "lost", a + 1, b - 1, 0) for a, b in zip(have, have[1:]) if b > a + 1]
        run = []
        for o in [*[o for o in have if mine.count(o) > 1], None]:
            if run and (o is None or o != run[-1] + 1):
                out.append((part, "repeated", run[0], run[-1], sum(mine.count(x) - 1 for x in run)))
                run = []
            run.append(o)
    return sorted(out)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from([0, 1, None]), st.integers(0, 40) | st.none()), max_size=60),
    st.sampled_from([1, 2, 5, 4096]),
)
def test_report_of_any_offsets(spark, held, block):
    assert report(spark, held, block) == plain_report(held)


def test_large_offsets(spark):
    base = 2**60
    held = [(0, base + i) for i in (0, 1, 2, 5, 6, 6, 6, 9)]
    assert report(spark, held, 4) == [
        (0, "lost", base + 3, base + 4, 0), (0, "lost", base + 7, base + 8, 0), (0, "repeated", base + 6, base + 6, 2),
    ]


def test_windows_see_ranges(spark):
    rows = spark.range(0, 100_000).selectExpr("int(id % 2) as record_partition", "id div 2 as record_offset")
    ranges = offsets.stored_ranges(rows, 100)
    assert sorted(map(tuple, ranges.collect())) == [(0, 0, 49_999), (1, 0, 49_999)]


def test_next_offsets(spark):
    found = offsets.next_offsets(positions(spark, [(0, 3), (0, 9), (1, 0), (1, None)])).collect()
    assert sorted(map(tuple, found)) == [(0, 10), (1, 1)]
