"""Latest rows and history against plain Python, and under skew."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rillstone.operators.versions import _bounds, _by_instant, _slice_of, history, latest, merge_latest

START = dt.datetime(2024, 3, 9, 23, 59, 58)
SCHEMA = "k string, timestamp timestamp, record_partition int, record_offset bigint, x int"
ORDER = ["timestamp", "record_partition", "record_offset"]

TIMES = [0, 0, 1, 2, 3, 59, 60, 61, 3600, 7200, 10**6, -(10**9)]
KEYS = st.sampled_from(["a", "b", None])
# key, seconds after START, partition; the offset is the row number
rows = st.lists(st.tuples(KEYS, st.sampled_from(TIMES), st.sampled_from([0, 1])), max_size=25)
# the same with no time, and offsets that repeat
repeated = st.lists(
    st.tuples(KEYS, st.sampled_from([*TIMES, None]), st.sampled_from([0, 1]), st.sampled_from([0, 1, 2])),
    max_size=25,
)
few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def table(spark, drawn, first=0):
    built = [
        (k, START + dt.timedelta(seconds=s), p, first + n, n) for n, (k, s, p) in enumerate(drawn)
    ]
    return spark.createDataFrame(built, SCHEMA), built


def expected_history(built):
    """Each row ends at the next later position of its key; no time comes first."""

    def position(row):
        return (row[1] is not None, row[1] or START, *row[2:4])

    result = []
    for row in built:
        later = [r for r in built if r[0] == row[0] and position(r) > position(row)]
        after = min(later, key=position, default=None)
        result.append((*row, after and after[1], "N" if after else "Y"))
    return sorted(result, key=str)


@few
@given(drawn=repeated, slices=st.sampled_from([1, 2, 5, 1024]), hot_rows=st.sampled_from([1, 5, 10**6]))
def test_history(spark, drawn, slices, hot_rows):
    """The same whether all, some or no keys count as hot, repeated positions included."""
    built = [
        (k, None if s is None else START + dt.timedelta(seconds=s), p, o, n)
        for n, (k, s, p, o) in enumerate(drawn)
    ]
    frame = spark.createDataFrame(built, SCHEMA)
    found = history(frame, ["k"], slices=slices, hot_rows=hot_rows).collect()
    assert sorted(map(tuple, found), key=str) == expected_history(built)


@few
@given(drawn=rows, cut=st.integers(0, 25))
def test_latest_in_any_order_of_arrival(spark, drawn, cut):
    frame, built = table(spark, drawn)
    newest = {}
    for row in sorted(built, key=lambda r: r[1:4]):
        newest[row[0]] = row
    expected = sorted(newest.values(), key=str)
    early, late = frame.where(F.col("x") < cut), frame.where(F.col("x") >= cut)
    for first, then in ((early, late), (late, early)):
        state = merge_latest(latest(first, ["k"], ORDER), then, ["k"], ORDER)
        assert sorted(map(tuple, state.collect()), key=str) == expected


def test_merge_latest_across_an_added_column(spark):
    narrow = "k string, t timestamp, x int"
    state = spark.createDataFrame([("a", START, 1), ("b", START, 1)], narrow)
    later = START + dt.timedelta(seconds=1)
    changes = spark.createDataFrame([("a", later, 2, "new")], narrow + ", y string")
    found = merge_latest(state, changes, ["k"], ["t"]).collect()
    assert sorted(map(tuple, found)) == [("a", later, 2, "new"), ("b", START, 1, None)]


def test_history_needs_an_absolute_time(spark):
    frame, _ = table(spark, [("a", 0, 0)])
    local = frame.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    with pytest.raises(TypeError):
        history(local, ["k"])


def skewed(spark):
    """A third of the rows are one key, half of those at one instant."""
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        F.timestamp_seconds(
            F.when(F.col("id") % 6 == 0, F.lit(1000)).otherwise(F.col("id") * 7)
        ).alias("timestamp"),
        F.lit(0).alias("record_partition"),
        F.col("id").alias("record_offset"),
        F.sha2(F.col("id").cast("string"), 512).alias("x"),
    )


def test_history_under_skew(spark, tmp_path):
    """Right, and the hot instant is split over tasks once it is large."""
    skewed(spark).write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    settings_for_small_data = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {name: spark.conf.get(name) for name in settings_for_small_data}
    try:
        for name, value in settings_for_small_data.items():
            spark.conf.set(name, value)
        found = history(frame, ["k"], hot_rows=1000)
        rows_found = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in plan
    w = Window.partitionBy("k").orderBy("timestamp", "record_offset")
    plain = frame.withColumn("valid_to", F.lead("timestamp").over(w)).withColumn(
        "current", F.when(F.col("valid_to").isNull(), "Y").otherwise("N")
    )
    assert set(map(tuple, rows_found)) == set(map(tuple, plain.collect()))
    assert len(rows_found) == 60_000


def test_full_rows_of_hot_keys_never_meet_a_window(spark):
    bounds = _bounds(skewed(spark), ["k"], "timestamp", 16)
    frame = _by_instant(skewed(spark), bounds, ["k"], ["record_offset"], "timestamp")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # The payload column is computed on the rows' side of the join, and there only.
    rows_side = plan[: plan.index("Window")]
    assert rows_side.count("sha2(") == plan.count("sha2(") == 1


def test_history_without_hot_keys_is_one_window(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "rows"))
    found = history(spark.read.parquet(str(tmp_path / "rows")), ["k"])
    assert found.count() == 60_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_slices_hold_their_share_however_dense_the_instants(spark):
    """A topic read in one go: all instants of a hot key within one hour."""
    rows = spark.range(40_000).select(
        F.lit("a").alias("k"), F.timestamp_micros(F.col("id") * 90_000).alias("timestamp")
    )
    cuts = _bounds(rows, ["k"], "timestamp", 100)
    sliced = rows.join(cuts, "k").groupBy(_slice_of("timestamp").alias("s")).count()
    sizes = [r["count"] for r in sliced.collect()]
    assert len(sizes) >= 95 and max(sizes) <= 2 * 40_000 / 100


def test_slices_of_many_cuts(spark):
    rows = spark.range(5000).select(
        F.lit("a").alias("k"), F.timestamp_seconds((F.col("id") * F.col("id")) % 9973).alias("timestamp")
    )
    joined = rows.join(_bounds(rows, ["k"], "timestamp", 500), "k")
    plain = F.size(F.filter("__cuts", lambda cut: cut <= F.col("timestamp")))
    assert joined.where(_slice_of("timestamp") != plain).isEmpty()


def test_latest_aggregates_before_the_shuffle(spark):
    frame, _ = table(spark, [("a", 0, 0)])
    plan = latest(frame, ["k"], ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert plan.count("Exchange hashpartitioning") == 1
