"""Every registered query against its DuckDB oracle on the smallest tables (the driver's check, locally)."""

import duckdb
import pytest

import __spark_entry__ as entry
from pulsegrid.plans.catalog import QUERIES
from scripts.check_oracle import digest, normalise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = normalise(entry.queries()[name](spark, SF).toPandas())
    want = normalise(con.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "dedup_key" in df.columns
