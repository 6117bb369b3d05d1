import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rillstone.llm import sharding


def test_matrix_has_its_sums():
    rng = np.random.default_rng(1)
    rows, columns = [5, 0, 17, 100, 3], [25, 50, 0, 50]
    made = sharding.communication_matrix(rng, rows, columns)
    assert made.sum(axis=1).tolist() == rows and made.sum(axis=0).tolist() == columns
    assert (made >= 0).all()


def test_sums_must_agree():
    with pytest.raises(ValueError):
        sharding.communication_matrix(np.random.default_rng(1), [3], [2])


@pytest.mark.parametrize("good,bad,taken", [(10, 20, 8), (3, 3, 5), (500, 200, 300), (1, 10**9, 10)])
def test_draws_follow_the_hypergeometric_law(good, bad, taken):
    rng = np.random.default_rng(2)
    ours = np.array([sharding.hypergeometric(rng.random(), good, bad, taken) for _ in range(4000)])
    mean = taken * good / (good + bad)
    var = mean * bad / (good + bad) * (good + bad - taken) / max(1, good + bad - 1)
    assert abs(ours.mean() - mean) < 5 * np.sqrt(var / 4000) + 1e-6
    assert abs(ours.var() - var) < 0.15 * var + 1e-3
    assert ours.min() >= max(0, taken - bad) and ours.max() <= min(taken, good)


@pytest.mark.parametrize("per_part", [8192, 7])
def test_shards_are_exact_and_slots_have_no_gaps(spark, per_part):
    rows = spark.range(1003).selectExpr("id % 5 as id", "'x' as shard")
    got = sharding.shuffle_shards(rows, 6, rows_per_part=per_part).collect()
    assert Counter(r.id for r in got) == Counter(i % 5 for i in range(1003))
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(map(len, by.values())) == [167, 167, 167, 167, 167, 168]
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_places_are_uniform(spark):
    """Over many seeds, each row is in each shard equally often, and so are pairs of rows."""
    together = Counter()
    where = Counter()
    for seed in range(40):
        got = {r.id: r.shard for r in sharding.shuffle_shards(spark.range(12), 3, seed=seed, rows_per_part=4).collect()}
        where.update((i, s) for i, s in got.items())
        together[got[0] == got[1]] += 1
    assert max(where.values()) <= 28 and min(where[i, s] for i in range(12) for s in range(3)) >= 2
    assert 2 <= together[True] <= 25  # expected 40 * 3 / 11


def test_same_input_same_result(spark):
    once = {tuple(r) for r in sharding.shuffle_shards(spark.range(100), 4).collect()}
    assert once == {tuple(r) for r in sharding.shuffle_shards(spark.range(100), 4).collect()}


def test_many_blocks_and_parts(spark):
    """Blocks are joined, and starts of parts are not broadcast, where they would exceed the bound."""
    rows = spark.range(0, 500, 1, 40).selectExpr("id % 3 as id")
    got = sharding.shuffle_shards(rows, 3, rows_per_part=10, most_bytes=8 * 3 * 5).collect()
    assert Counter(r.id for r in got) == Counter(i % 3 for i in range(500))
    for s, n in ((0, 167), (1, 167), (2, 167)):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - n) <= 1


def test_documents_are_exchanged_once(spark):
    placed = sharding.shuffle_shards(spark.range(1000), 4, rows_per_part=50)
    placed.collect()
    plan = placed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    whole = [line for line in plan.split("\n") if "Exchange" in line and "_row" in line]
    assert len(re.findall("Exchange hashpartitioning[(]shard", plan)) <= 3 and "SortMergeJoin" not in plan
    assert len(whole) <= 1 and plan.count("+- *") >= 0 and "Sort [_draw" in plan


@pytest.mark.parametrize("blocks,each", [(5000, 20_000), (300, 10_000_000)])
def test_matrices_of_many_blocks(blocks, each):
    columns = [blocks * each // 24] * 24
    columns[0] += blocks * each - sum(columns)
    made = sharding.communication_matrix(np.random.default_rng(5), [each] * blocks, columns)
    assert (made.sum(axis=1) == each).all() and made.sum(axis=0).tolist() == columns
    share = made / each
    spread = np.sqrt((1 / 24) * (23 / 24) / each)
    assert abs(share.std() / spread - 1) < 0.05


def test_empty(spark, no_docs):
    assert sharding.shuffle_shards(no_docs, 3).count() == 0


def test_odd_rows(spark, odd_docs):
    got = sharding.shuffle_shards(odd_docs, 5)
    assert got.count() == odd_docs.count() and got.columns.count("shard") == 1


def test_written_shards(spark, tmp_path):
    placed = sharding.shuffle_shards(spark.range(50), 4)
    sharding.write_shards(placed, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = sharding.op10_sharding(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert r["size"] == len(data) + 8 and r.text_crc32 == zlib.crc32(data)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 24


def test_plan_is_native(spark):
    plan = sharding.op10_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_shards_whole_documents(spark, monkeypatch):
    taken = []
    shuffle = sharding.shuffle_shards
    monkeypatch.setattr(sharding, "shuffle_shards", lambda rows, *a, **k: taken.append(rows) or shuffle(rows, *a, **k))
    sf = "/root/testdata/sf0.001"
    sharding.op10_sharding(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert taken[0].columns == docs.columns and taken[0].exceptAll(docs).isEmpty()
