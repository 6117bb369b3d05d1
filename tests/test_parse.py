"""What becomes of each kind of message, with and without dead letters."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions.keys import split_keys
from rillstone.operators.parse import flatten, raw_rows, reduce_records, structured
from rillstone.operators.quality import accepted, classify, rejects
from rillstone.sources.records import MICROSECONDS

KEYS = split_keys("id")
FAILURE = (Py4JJavaError, PySparkException)
EPOCH = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("n", T.StringType(), True),
        T.StructField("a", T.StructType([T.StructField("b", T.IntegerType())]), True),
    ]
)

# message, outcome, (id, n, a.b) when parsed
CASES = {
    "valid": ('{"id":1,"n":"x","a":{"b":2}}', "accepted", (1, "x", 2)),
    "missing optional": ('{"id":1}', "accepted", (1, None, None)),
    "missing required": ('{"n":"x"}', "missing_required", (None, "x", None)),
    "null required": ('{"id":null,"n":"x"}', "missing_required", (None, "x", None)),
    "empty object": ("{}", "missing_required", (None, None, None)),
    "extra field": ('{"id":1,"n":"x","zz":1}', "accepted", (1, "x", None)),
    "coerced": ('{"id":1,"n":5}', "accepted", (1, "5", None)),
    "wrong type": ('{"id":"q","n":"x"}', "malformed", None),
    "wrong nested type": ('{"id":1,"n":"x","a":{"b":"bad"}}', "malformed", None),
    "float for bigint": ('{"id":1.5}', "malformed", None),
    "overflow": ('{"id":99999999999999999999}', "malformed", None),
    "truncated": ('{"id":1', "malformed", None),
    "array root": ('[{"id":1},{"id":2}]', "malformed", None),
    "scalar root": ("5", "malformed", None),
    "literal null": ("null", "malformed", None),
    "byte-order mark": ('﻿{"id":1}', "malformed", None),
    "empty": ("", "null_value", (None, None, None)),
    "blanks": ("  ", "null_value", (None, None, None)),
    "newline": ("\n", "null_value", (None, None, None)),
    "tab": ("\t", "null_value", (None, None, None)),
    "tombstone": (None, "null_value", (None, None, None)),
    "other case": ('{"ID":1,"n":"x"}', "missing_required", (None, "x", None)),
    "duplicate key": ('{"id":1,"id":2,"n":"x"}', "accepted", (2, "x", None)),
    # Spark's parser stops behind the first value.
    "trailing text": ('{"id":1} trailing', "malformed", (1, None, None)),
    "two objects": ('{"id":1}{"id":2}', "malformed", (1, None, None)),
    "two objects in a list": ('{"id":1},{"id":2}', "malformed", (1, None, None)),
    "trailing comma": ('{"id":1},', "malformed", (1, None, None)),
    "closing bracket": ('{"id":1}]', "malformed", (1, None, None)),
    "closing bracket and more": ('{"id":1}] , [2', "malformed", (1, None, None)),
    "closing brace": ('{"id":1}}x', "malformed", (1, None, None)),
    "brace, bracket": ('{"id":1}}]', "malformed", (1, None, None)),
    "comment": ('{"id":1}//x', "malformed", (1, None, None)),
    "brackets within": ('{"id":1,"n":"]}x","z":[[1],[]]}', "accepted", (1, "]}x", None)),
    "blanks around": (' \n{"id":1}\t ', "accepted", (1, None, None)),
    "single quotes": ("{'id':1}", "accepted", (1, None, None)),
    "own corrupt field": ('{"id":1,"_corrupt_record":"x"}', "accepted", (1, None, None)),
}


# Text that is often close to a message.
messages_like = st.lists(
    st.sampled_from(
        ['{"id":', "1", "null", ',"n":', '"x"', "}", "{", "[", " ", "1.5", '"a":{"b":2}']
    ),
    max_size=8,
).map("".join)


def texts(spark, *messages):
    rows = [(EPOCH, message) for message in messages]
    return spark.createDataFrame(rows, "timestamp timestamp, value string")


@pytest.mark.parametrize("case", CASES)
def test_classify(spark, case):
    message, outcome, fields = CASES[case]
    row = classify(texts(spark, message), SCHEMA, KEYS).first()
    assert row.outcome == outcome
    assert row.value_raw == message
    if outcome == "accepted":
        assert (row.value.id, row.value.n, row.value.a and row.value.a.b) == fields
        assert row.id == row.value.id


@pytest.mark.parametrize("case", CASES)
def test_failfast(spark, case):
    message, outcome, fields = CASES[case]
    rows = structured(texts(spark, message), SCHEMA, KEYS)
    if fields is None:
        with pytest.raises(FAILURE, match="MALFORMED_RECORD_IN_PARSING"):
            rows.collect()
    else:
        row = rows.first()
        value = row.value
        found = (value.id, value.n, value.a and value.a.b) if value else (None, None, None)
        assert found == fields
        assert (row.timestamp, row.value_raw, row.id) == (EPOCH, message, fields[0])


def test_failfast_is_not_pruned_away(spark):
    with pytest.raises(FAILURE, match="MALFORMED_RECORD_IN_PARSING"):
        structured(texts(spark, '{"id":"q"}'), SCHEMA, KEYS).count()


def test_accepted_and_rejects_cover_everything(spark):
    messages = [message for message, _, _ in CASES.values()]
    sorted_out = classify(texts(spark, *messages), SCHEMA, KEYS)
    good = [row.value_raw for row in accepted(sorted_out).collect()]
    bad = rejects(sorted_out).collect()
    assert sorted(map(str, good + [row.value_raw for row in bad])) == sorted(map(str, messages))
    reasons = {row.value_raw: row.reason for row in bad}
    assert reasons == {m: o for m, o, _ in CASES.values() if o != "accepted"}
    assert "_corrupt_record" not in sorted_out.schema["value"].dataType.names


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(), messages_like), min_size=1, max_size=60))
def test_every_message_has_one_outcome(spark, drawn):
    sorted_out = classify(texts(spark, *drawn), SCHEMA, KEYS)
    good = [row.value_raw for row in accepted(sorted_out).collect()]
    bad = [row.value_raw for row in rejects(sorted_out).collect()]
    assert sorted(map(repr, good + bad)) == sorted(map(repr, drawn))


def test_invalid_utf8_is_replaced(spark):
    records = spark.createDataFrame(
        [(EPOCH, bytearray(b'{"id":1,"n":"\xffA"}'))], "timestamp timestamp, value binary"
    )
    row = structured(reduce_records(records), SCHEMA, KEYS).first()
    assert row.value.n == "�A"


TYPES = {
    "boolean": ("true", True),
    "tinyint": ("7", 7),
    "smallint": ("300", 300),
    "int": ("70000", 70000),
    "bigint": ("5000000000", 5000000000),
    "float": ("0.5", 0.5),
    "double": ("0.1", 0.1),
    "decimal(10,3)": ("12.345", Decimal("12.345")),
    "string": ('"s"', "s"),
    "binary": ('"AQI="', bytearray(b"\x01\x02")),
    "date": ('"2024-01-02"', dt.date(2024, 1, 2)),
    "timestamp": ('"2024-01-02T03:04:05.678901Z"', EPOCH),
    "timestamp_ntz": ('"2024-01-02T03:04:05.678901"', EPOCH),
    "array<int>": ("[1,2]", [1, 2]),
    "map<string,int>": ('{"k":1}', {"k": 1}),
    "struct<b:array<struct<c:int>>>": ('{"b":[{"c":1}]}', ([(1,)],)),
    "interval day to second": ("\"INTERVAL '1 02:03:04' DAY TO SECOND\"", dt.timedelta(1, 7384)),
}


@pytest.mark.parametrize("name", TYPES)
def test_types(spark, name):
    literal, expected = TYPES[name]
    schema = T.StructType.fromDDL(f"id bigint, f {name}")
    message = f'{{"id":1,"f":{literal}}}'
    row = structured(texts(spark, message), schema, KEYS).first()
    assert row.value.f == expected
    assert classify(texts(spark, message), schema, KEYS).first().outcome == "accepted"


@pytest.mark.parametrize("name", ["interval year to month", "variant"])
def test_types_without_python_form(spark, name):
    literal = "\"INTERVAL '1-2' YEAR TO MONTH\"" if "interval" in name else '{"k":1}'
    schema = T.StructType.fromDDL(f"id bigint, f {name}")
    rows = structured(texts(spark, f'{{"id":1,"f":{literal}}}'), schema, KEYS)
    assert rows.select(F.col("value.f").isNotNull()).first()[0]


def test_times_survive_the_envelope_to_the_microsecond(spark):
    schema = T.StructType.fromDDL("id bigint, l timestamp, n timestamp_ntz")
    rows = spark.createDataFrame([(1, EPOCH, EPOCH)], schema)
    message = rows.select(
        F.lit(EPOCH).alias("timestamp"),
        F.to_json(F.struct("*"), MICROSECONDS).alias("value"),
    )
    value = structured(message, schema, KEYS).first().value
    assert (value.l, value.n) == (EPOCH, EPOCH)


REQUIRED = {
    "nested, parent absent": ({"s": ("struct", False)}, '{"id":1}', "accepted"),
    "nested, parent there": ({"s": ("struct", False)}, '{"id":1,"s":{}}', "missing_required"),
    "element": ({"s": ("array", False)}, '{"id":1,"s":[1,null]}', "missing_required"),
    "elements there": ({"s": ("array", False)}, '{"id":1,"s":[1,2]}', "accepted"),
    "no array": ({"s": ("array", False)}, '{"id":1}', "accepted"),
    "field of element": ({"s": ("rows", False)}, '{"id":1,"s":[{"b":1},{}]}', "missing_required"),
    "null element allowed": ({"s": ("rows", False)}, '{"id":1,"s":[{"b":1},null]}', "accepted"),
    "map value": ({"s": ("map", False)}, '{"id":1,"s":{"k":null}}', "missing_required"),
}


@pytest.mark.parametrize("case", REQUIRED)
def test_required_inside_nested_types(spark, case):
    (declared,), message, outcome = REQUIRED[case][0].values(), *REQUIRED[case][1:]
    inner = T.StructType([T.StructField("b", T.IntegerType(), False)])
    kind = {
        "struct": inner,
        "array": T.ArrayType(T.IntegerType(), False),
        "rows": T.ArrayType(inner, True),
        "map": T.MapType(T.StringType(), T.IntegerType(), False),
    }[declared[0]]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", kind)])
    assert classify(texts(spark, message), schema, KEYS).first().outcome == outcome


def test_raw_rows_hold_keys_as_text(spark):
    schema = T.StructType.fromDDL("meta struct<id: bigint>, day date")
    keys = split_keys("meta.id, day")
    message = '{"meta":{"id":7},"day":"2024-01-02"}'
    raw = raw_rows(structured(texts(spark, message), schema, keys), keys)
    assert raw.dtypes == [
        ("timestamp", "timestamp"),
        ("meta_id", "string"),
        ("day", "string"),
        ("value_raw", "string"),
    ]
    assert tuple(raw.first()) == (EPOCH, "7", "2024-01-02", message)


def test_flatten_lets_a_payload_field_replace_the_struct(spark):
    schema = T.StructType.fromDDL("id bigint, value double, `odd.name` int")
    message = '{"id":1,"value":0.5,"odd.name":3}'
    flat = flatten(structured(texts(spark, message), schema, KEYS))
    assert flat.columns == ["id", "value", "odd.name", "timestamp"]
    assert tuple(flat.first()) == (1, 0.5, 3, EPOCH)
