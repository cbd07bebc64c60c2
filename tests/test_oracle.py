"""Every registered query against its SQL statement on the whole tables, value by value."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from seismark.workload import ORACLE, QUERIES

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema}
    declared = duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert found == {row[0]: row[1] for row in declared}
    expected = duck.execute(ORACLE[name])
    order = sorted(columns)
    want = Counter(
        tuple(row[columns.index(c)] for c in order) for row in expected.fetchall()
    )
    got = Counter(tuple(row[c] for c in order) for row in result.collect())
    assert sum(want.values()) > 0
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
