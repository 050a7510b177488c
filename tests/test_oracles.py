"""Every registered query against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

from tierline.plans.oracles import ORACLES
from tierline.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def _sortable(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def _clean(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(_clean(r[c]) for c in columns) for r in df.collect()]
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in result.fetchall()]
    assert len(got) == len(want)
    assert got, "the query must not be empty on the test data"
    assert sorted(got, key=_sortable) == sorted(want, key=_sortable)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
