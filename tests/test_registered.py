"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.run import compare

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    """But for those of the optional package that SQL cannot express; these have tests of their own."""
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert not {name for name in without if not name.startswith(("op", "pipeline"))}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    problems, rows = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert problems == []
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 50
