"""Catalog table loads."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.schema import CORRUPT
from seismark.session import remove_folder, work_folder
from seismark.sinks.files import rebalanced
from seismark.sinks.gates import (
    BadRecordBudgetExceeded,
    require_rows,
    require_values,
    split_bad_records,
)
from seismark.sources.documents import read_landing_text


class LoadResult(NamedTuple):
    """Rows loaded, and what was not on the way: features that did not convert, documents that did
    not parse or end too early, and the folder where these are."""

    table: str
    rows: int
    failed: int = 0
    broken: int = 0
    unfinished: int = 0
    folder: str | None = None


def literal(text: str) -> str:
    """The text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def with_row_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and its row count once it has been written: ``observation.get["rows"]``.

    Counted while the rows pass to the writer, without a second scan. The counting node sits right
    under the write, where Spark counts each finished partition once even if a task is repeated.
    """
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def load_table(
    df: DataFrame,
    table: str,
    disposition: str = "append",
    location: str | None = None,
    required: Sequence[str] = (),
    refuse_empty: bool = True,
    rebalance: bool = False,
) -> LoadResult:
    """Load a frame into a catalog table, creating the table when it is missing. ``rebalance`` costs a
    shuffle and writes few files of the advisory size instead of one per task.

    ``append`` adds the rows as they are: no key, no removal of repeats. ``truncate`` writes a new
    folder and then points the table at it, so readers see the old content or the new, and a job
    that dies changes nothing; the old folder stays until the table's owner removes it.

    ``required`` names columns that must not hold nulls. They are checked before anything is
    written, by a scan of those columns only: pass a frame that reads files, such as the curated
    Parquet layer, rather than one that would compute the rows twice.
    """
    if disposition not in ("append", "truncate"):
        raise ValueError(f"unknown disposition: {disposition}")
    spark = df.sparkSession
    if required:
        require_values(df, required)
    if rebalance:
        df = rebalanced(df)
    exists = spark.catalog.tableExists(table)
    if disposition == "append" and exists:
        columns = spark.table(table).columns
        if set(columns) != set(df.columns):
            raise ValueError(f"columns differ from {table}: {sorted(set(columns) ^ set(df.columns))}")
        counted, observation = with_row_count(df.select(*columns))
        counted.write.format("parquet").mode("append").saveAsTable(table)
        return LoadResult(table, observation.get["rows"])
    if disposition == "truncate" and refuse_empty:
        require_rows(df)
    folder = f"{location or _default_location(spark, table)}/load-{uuid.uuid4().hex}"
    counted, observation = with_row_count(df)
    counted.write.parquet(folder)
    _point_table_at(spark, table, folder, exists)
    return LoadResult(table, observation.get["rows"])


def _default_location(spark: SparkSession, table: str) -> str:
    *namespace, name = table.split(".")
    database = ".".join(namespace) or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


def _point_table_at(spark: SparkSession, table: str, folder: str, exists: bool) -> None:
    if exists:
        old = [(f.name, f.dataType) for f in spark.table(table).schema]
        new = [(f.name, f.dataType) for f in spark.read.parquet(folder).schema]
        if old == new:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(folder)}")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=folder, source="parquet")


def load_ndjson(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    table: str,
    max_bad_records: int = 50,
    disposition: str = "truncate",
    location: str | None = None,
    quarantine: str | None = None,
    required: Sequence[str] = (),
) -> LoadResult:
    """Load newline-delimited JSON, accepting up to ``max_bad_records`` unreadable lines.

    The text is parsed once, into a written table in the shared work folder. The bad lines are
    counted on that table, where the count reads one column and stays right when executors are
    lost and tasks repeat; only then are the good rows put into the table.
    """
    flagged = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    staged_at = work_folder(spark, "ndjson")
    try:
        read_landing_text(spark, path, flagged).write.parquet(staged_at)
        good, bad = split_bad_records(spark.read.parquet(staged_at))
        n_bad = bad.count()
        if quarantine is not None:
            bad.write.mode("overwrite").parquet(quarantine)
        if n_bad > max_bad_records:
            raise BadRecordBudgetExceeded(f"{n_bad} bad records, {max_bad_records} allowed")
        return load_table(good, table, disposition, location, required)
    finally:
        remove_folder(spark, staged_at)


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first rows and the schema; runs a job, so no transform calls it."""
    df.show(n, truncate=False)
    df.printSchema()
