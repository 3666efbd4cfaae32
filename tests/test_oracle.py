"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__
from tillstar.plans import oracle, registry

duckdb = pytest.importorskip("duckdb")

DATA = Path("/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    expected = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    assert got == canonical(expected.fetchall(), expected.columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
