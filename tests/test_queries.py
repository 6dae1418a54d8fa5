"""Every registered query against its SQL on the smallest supplied tables."""

import os
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
import __spark_entry__ as driver
from portloom import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    return float(v) if isinstance(v, (int, Decimal)) and not isinstance(v, bool) else v


def table_of(columns, found):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in at) for r in found]
    return [columns[i] for i in at], sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLES[name])
    assert table_of(df.columns, df.collect()) == table_of(want.columns, want.fetchall())


def test_entry(spark):
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert driver.entry(spark).count() > 0
