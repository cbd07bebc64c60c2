"""Registered queries that SQL can express give the rows of their SQL statement."""

from __future__ import annotations

import os

import duckdb
import pytest

from seismark.llm import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as sql:
        for table in ("documents", "embeddings", "benchmark"):
            sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        stated = sql.execute(queries.ORACLE[name])
        columns = [c[0] for c in stated.description]
        expected = stated.fetchall()
    found = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(expected)
