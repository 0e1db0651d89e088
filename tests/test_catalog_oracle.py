"""Every catalogue query against its DuckDB oracle on the smallest scale factor."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from candela.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
QUERIES = E.queries()

_TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
    "boolean": "BOOLEAN",
}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (decimal.Decimal, bool)):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _stype(t):
    s = t.simpleString()
    return s.upper().replace(" ", "") if s.startswith("decimal") else _TYPES.get(s, s.upper())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    from candela.plans.registry import all_queries

    assert set(all_queries()) <= set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "rsi_14" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]).replace(" ", "") for d in cur.description}
    assert {f.name: _stype(f.dataType) for f in df.schema.fields} == otypes
    idx = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oidx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    got = sorted(tuple(_norm(r[i]) for i in idx) for r in rows)
    want = sorted(tuple(_norm(r[i]) for i in oidx) for r in orows)
    assert len(got) == len(want)
    assert got == want
