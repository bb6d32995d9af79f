"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registry


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in (row[c] for c in columns)) for row in rows), key=repr
    )


def test_sql_belongs_to_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.reference_queries()))
def test_query(spark, sf_dir, tables, name):
    found = registry.reference_queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    rows = comparable(found.collect(), columns)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = tables.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert rows == comparable((dict(zip(names, r)) for r in cursor.fetchall()), columns)


def test_entry(spark):
    rows = registry.entry(spark)
    assert rows.columns == ["source", "split", "samples", "tokens"] and rows.count() > 0
