"""Every catalog query against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as contract
from abstractmill.plans import catalog, oracle
from tools.compare import TABLES, rows_of

SF_DIR = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle()) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    rel = duck.execute(oracle.oracle()[name])
    theirs = rows_of([d[0] for d in rel.description], rel.fetchall())
    assert rows_of(df.columns, df.collect()) == theirs
