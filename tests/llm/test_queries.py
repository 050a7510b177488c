"""Every registered query of the subpackage against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

from tierline.llm.oracles import ORACLES
from tierline.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return tuple(map(_plain, value)) if isinstance(value, list) else value


def _sortable(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(_plain(r[names.index(c)]) for c in columns) for r in result.fetchall()]
    assert got
    assert sorted(got, key=_sortable) == sorted(want, key=_sortable)
