"""Every registered query against its SQL on DuckDB, whole tables at sf0.01."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from rillstone.oracles import ORACLES
from rillstone.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    rows = Counter(tuple(row) for row in result.select(*columns).collect())
    assert rows == Counter(expected.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 1000
