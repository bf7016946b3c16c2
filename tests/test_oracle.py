"""Every registered query equals its DuckDB oracle (row count, columns, multiset of rows)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from dexflow.plans import catalog, derived

NAMES = sorted(catalog.QUERIES | derived.QUERIES)

TABLES = ["events", "region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) and set(derived.QUERIES) == set(derived.ORACLE)
    assert not set(catalog.QUERIES) & set(derived.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert s_types == d_types
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["protocol", "event_type", "event_count", "unique_pools", "unique_transactions",
                          "first_event", "last_event"]
    assert df.count() > 0
