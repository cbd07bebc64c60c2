"""Columnar scans, catalog tables, queries and small in-memory inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parquet_glob(spark: SparkSession, prefix: str, pattern: str = "*.parquet") -> DataFrame:
    """Every file below a prefix whose name matches the pattern."""
    return spark.read.options(pathGlobFilter=pattern, recursiveFileLookup=True).parquet(prefix)


def read_table(
    spark: SparkSession, name: str | None = None, fmt: str | None = None, **options: str
) -> DataFrame:
    """A catalog table by name, or any installed connector by format and options."""
    if fmt is None:
        return spark.read.table(name)
    return spark.read.format(fmt).options(**options).load(name)


def read_query(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """The result of a SQL query; ``{name}`` in the text stands for a frame passed by name."""
    return spark.sql(query, **frames)


def rows_with_schema(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """Small in-memory rows with a declared schema; bulk data comes through the file readers."""
    return spark.createDataFrame(rows, schema)


def single_seed_element(spark: SparkSession) -> DataFrame:
    """One row to start a job from."""
    return spark.range(1)


def read_json_strings_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Text with one JSON row per line, read with a schema inferred from every row."""
    return spark.read.json(path)
