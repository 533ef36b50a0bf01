"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry
from scripts.oracle_check import digest, norm
from tidewater.plans import catalog

TABLES = "orders events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert digest(norm(got)) == digest(norm(exp))


def test_every_query_has_oracle_or_simulation_test():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["dt", "hr", "topic", "partition", "records", "min_offset", "max_offset"]
