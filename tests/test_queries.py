"""Every registered query runs on sf0.001 and keeps a stable schema; a
selection is compared with its DuckDB oracle (the full comparison is
tools/check_oracle.py at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tabforge.sources.tables import TABLES
from tests.conftest import SF001

FAST = [n for n in E.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "o_orderkey" in df.columns


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())
