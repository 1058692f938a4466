"""Every query that has SQL against it at the smallest scale.

The corpus queries without SQL are held against brute force in ``tests/llm``.
"""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, compare
from slotcast.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_query_of_the_catalog_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, connection, name):
    text, _, ok = compare(spark, connection, SF, name)
    assert ok, text
