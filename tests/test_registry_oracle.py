"""Every registered query against its DuckDB oracle on the sf0.001 tables (the
driver's check runs the same comparison at sf0.01)."""

import datetime as dt
import decimal
import os

import pytest

from conftest import SMALL_SF

import __spark_entry__ as E
from switchboard.plans import catalog

QUERIES = E.queries()
CATALOG = catalog.QUERIES  # the queries outside the llm subpackage, which has its own tests
ORACLE = E.oracle_sql()
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


def test_inventory_complete():
    assert len(CATALOG) == 81 and set(CATALOG) <= set(QUERIES)
    assert set(catalog.ORACLE) <= set(CATALOG)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "agent_sk" and df.columns[-1] == "event_date"
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SMALL_SF), reason="test tables missing")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL_SF)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[name])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
