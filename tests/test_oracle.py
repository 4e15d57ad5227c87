"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison on sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from gridcat.plans import queries
from gridcat.plans.views import BASE_TABLES
from tools.oracle_check import digest

from conftest import SF_SMALL

QUERIES = queries.queries()
ORACLES = queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "collection_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    hs, ls = digest(df.columns, srows)
    hd, ld = digest(rel.columns, drows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])
