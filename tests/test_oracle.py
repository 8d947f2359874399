"""Every query with SQL gives the rows that DuckDB gives on the smallest tables."""

import math
import os

import duckdb
import pytest

from babelmill.plans.catalogue import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        con.sql(f"create view {file.split('.')[0]} as select * from '{DATA}/{file}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return x


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    rows = [tuple(plain(r[c]) for c in order) for r in df.collect()]
    at = [want.columns.index(c) for c in order]
    assert sorted(rows, key=str) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
