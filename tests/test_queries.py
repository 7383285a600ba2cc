"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from compare import TABLES, compare

import __spark_entry__ as entry
from gaitmill.plans import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(REGISTRY.queries))
def test_query(spark, con, name):
    text, good = compare(spark, con, SF, name)
    assert good, text


def test_every_query_is_offered():
    assert set(REGISTRY.queries) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
