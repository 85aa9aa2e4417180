"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from tallystock import catalog
from tallystock.catalog.inputs import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, type(v).__name__, v if v is not None else 0) for v in r])


def test_every_query_has_a_check():
    assert set(catalog.queries()) == set(catalog.oracles())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = _sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = duck.execute(f"SELECT * FROM ({catalog.oracles()[name]}) q")
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == _sorted(tuple(r[i] for i in order) for r in cursor.fetchall())
