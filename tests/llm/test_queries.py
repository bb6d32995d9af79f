"""Every query of the package against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from sluice.llm import queries
from tests.test_registry import comparable

TABLES = "documents benchmark embeddings pages labels conversations".split()


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_sql_belongs_to_queries():
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, tables, name):
    found = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    rows = comparable(found.collect(), columns)
    assert rows
    if name in queries.ORACLES:
        cursor = tables.execute(queries.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        assert rows == comparable((dict(zip(names, r)) for r in cursor.fetchall()), columns)
