"""Write once, look at what was written, then publish.

A load writes all its rows, good and lost, into a folder that no table names yet, one partition per
outcome. They are counted on the way to the writer. Only when the counts pass the gates does a table
get to know the folder, and then no row is written again: the folder becomes a partition of the
table. A load that is refused leaves its folder behind, lost records included.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.operators.project import JSON_TIMES
from seismark.plans.curate import BROKEN, EARLY_END, GOOD, LOST_ROW, MARKS, RECORD, OUTCOME
from seismark.sinks.files import LOAD_ID
from seismark.sinks.gates import EmptyInput, LossesExceeded, MissingRequiredValues
from seismark.sinks.tables import literal

_NULLS = "nulls in "


class Staged(NamedTuple):
    """A written load that is not published: its folder, columns and counts."""

    folder: str
    schema: T.StructType
    rows: int
    failed: int
    broken: int
    unfinished: int
    nulls: dict[str, int]

    def side(self, spark: SparkSession, outcome: str, fmt: str = "parquet") -> DataFrame:
        """The rows of one outcome, read from their own partition."""
        return staged_rows(spark, self.folder, self.schema, fmt).where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def staged_rows(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    options = JSON_TIMES if fmt == "json" else {}
    return spark.read.format(fmt).schema(schema).options(**options).load(folder)


def lost_records(spark: SparkSession, folder: str, *more: str, fmt: str = "parquet") -> DataFrame:
    """(outcome, record) of what a load could not use, and other text columns of it."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (RECORD, *more, OUTCOME)])
    return staged_rows(spark, folder, schema, fmt).where(F.col(OUTCOME) != GOOD).select(OUTCOME, RECORD, *more)


def stage(flagged: DataFrame, folder: str, required: Sequence[str] = (), fmt: str = "parquet") -> Staged:
    """Write rows of ``curate_flagged`` by outcome; the only pass over what they are made from."""
    seen, good = Observation(), F.col(OUTCOME) == GOOD
    counted = flagged.observe(
        seen,
        *[F.count_if(F.col(OUTCOME) == s).alias(s) for s in (GOOD, LOST_ROW, BROKEN, EARLY_END)],
        *[F.count_if(good & F.col(c).isNull()).alias(_NULLS + c) for c in required],
    )
    options = JSON_TIMES if fmt == "json" else {}
    counted.write.partitionBy(OUTCOME).format(fmt).options(**options).save(folder)
    found = seen.get
    nulls = {c: found[_NULLS + c] for c in required if found[_NULLS + c]}
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in flagged.schema])
    return Staged(folder, schema, found[GOOD], found[LOST_ROW], found[BROKEN], found[EARLY_END], nulls)


def check(staged: Staged, max_lost: int = 0, refuse_empty: bool = True, hold: bool = False) -> None:
    """Raise unless the load may be published. With ``hold`` an unfinished document is no loss."""
    broken = staged.broken + (0 if hold else staged.unfinished)
    if broken + staged.failed > max_lost:
        raise LossesExceeded(
            f"{broken} documents did not parse and {staged.failed} features did not convert, "
            f"{max_lost} allowed; they are in {staged.folder}"
        )
    if staged.nulls:
        raise MissingRequiredValues(f"nulls in required columns: {staged.nulls}")
    if refuse_empty and not staged.rows:
        raise EmptyInput("refusing to overwrite with an empty input")


def publish(spark: SparkSession, staged: Staged, table: str, load_id: str, root: str, replace_all: bool = False) -> None:
    """Make the staged rows the partition ``load_id`` of a table.

    The partition is pointed at the folder in one step, so a repeated load takes the place of its
    own rows. With ``replace_all`` the partitions of all other loads are then dropped from the
    table; their files stay.
    """
    columns = [f for f in staged.schema if f.name not in MARKS]
    _ensure_table(spark, table, columns, root)
    own = f"PARTITION ({LOAD_ID} = {literal(load_id)})"
    if staged.rows:
        place = literal(f"{staged.folder}/{OUTCOME}={GOOD}")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {own} LOCATION {place}")
        spark.sql(f"ALTER TABLE {table} {own} SET LOCATION {place}")
    else:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {own}")
    if replace_all:
        others = [x for x in loads_of(spark, table) if x != load_id]
        if others:
            listed = ", ".join(f"PARTITION ({LOAD_ID} = {literal(x)})" for x in others)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
    spark.catalog.refreshTable(table)


def loads_of(spark: SparkSession, table: str) -> list[str]:
    """The loads a table holds: names of partitions, no data."""
    return [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _ensure_table(spark: SparkSession, table: str, columns: list[T.StructField], root: str) -> None:
    if not spark.catalog.tableExists(table):
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        place = literal(f"{root.rstrip('/')}/_{table}")
        spark.sql(f"CREATE TABLE {table} ({listed}, {LOAD_ID} STRING) USING parquet PARTITIONED BY ({LOAD_ID}) LOCATION {place}")
        return
    known = [(f.name, f.dataType) for f in spark.table(table).schema]
    if known != [*((f.name, f.dataType) for f in columns), (LOAD_ID, T.StringType())]:
        raise ValueError(f"columns differ from {table}: {sorted({n for n, _ in known} ^ {f.name for f in columns})}")
