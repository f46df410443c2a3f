"""Every registered query against its DuckDB oracle SQL (row count, columns, values)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tontine.plans import registry

NAMES = sorted(registry.queries())


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", v + 0.0)
    if isinstance(v, int):
        return ("f", float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("d", v.isoformat()[:10])
    return ("s", str(v))


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "customer", "lineitem"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(registry.oracle_sql()) == set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    orows = res.fetchall()
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(list(res.columns), orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_bel" in df.columns
