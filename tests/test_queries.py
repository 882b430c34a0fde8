"""Every query of the engine against its DuckDB SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from weft import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((repr([plain(r[i]) for i in order]) for r in data))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in queries.ORACLE_SQL:
        assert got
        return
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, want.fetchall())
