"""Every registered query against its DuckDB twin on sf0.001 (the driver runs
the same comparison at sf0.01)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

from testdata_paths import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(rel.fetchall(), rel.columns)


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        assert fn(spark, SF_SMALL).columns, name


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["_key", "type", "expireAt_ms"] and df.count() > 0
