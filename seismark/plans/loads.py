"""The scheduled loads: landed documents, through a Parquet layer, into a table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from seismark.plans.curate import GOOD, MARKS, OUTCOME, curate_flagged
from seismark.schema import REQUIRED_COLUMNS, REQUIRED_COLUMNS_SCHEDULED
from seismark.sinks.audit import AuditLog
from seismark.sinks.staging import Staged, check, publish, stage
from seismark.sinks.tables import LoadResult, load_ndjson
from seismark.sources.documents import read_landing_geojson

Reader = Callable[[SparkSession, str], DataFrame]


def _step(audit: AuditLog | None, name: str, info: str) -> AbstractContextManager:
    return nullcontext() if audit is None else audit.step(name, info)


def load_folder(layer: str, load_id: str) -> str:
    """A fresh folder for the rows of one attempt of a load."""
    return f"{layer.rstrip('/')}/load-{load_id}-{uuid.uuid4().hex[:12]}"


def day_stamp(day: dt.date | str) -> str:
    return day if isinstance(day, str) else day.strftime("%Y%m%d")


def load_documents(
    documents: DataFrame,
    layer: str,
    table: str,
    load_id: str,
    replace_all: bool = False,
    required: Sequence[str] = (),
    max_lost: int = 0,
    refuse_empty: bool = False,
    hold: bool = False,
    ingested_at: dt.datetime | Column | None = None,
    area: str = "split",
    time_format: str = "timestamp",
    audit: AuditLog | None = None,
) -> LoadResult:
    """Curate documents and put them into ``table`` as the load ``load_id``.

    The documents are read and the rows written once, into a folder of ``layer``; losses and nulls
    are counted on the way. The table is pointed at the folder only if nothing required is null and
    no more than ``max_lost`` documents and features were lost; ``hold`` tells that unfinished
    documents will be looked at again and are not lost.
    """
    spark = documents.sparkSession
    with _step(audit, "curate_to_parquet", load_id) as step:
        flagged = curate_flagged(documents, area, time_format, ingested_at)
        staged = stage(flagged, load_folder(layer, load_id), required)
        if step is not None:
            step.info = (
                f"{load_id}: {staged.rows} rows, {staged.failed} failed, "
                f"{staged.broken + staged.unfinished} broken documents"
            )
        check(staged, max_lost, refuse_empty, hold)
    with _step(audit, "load_table", table) as step:
        publish(spark, staged, table, load_id, layer, replace_all)
        if step is not None:
            step.info = f"{table} {staged.rows} rows"
    return result_of(staged, table)


def result_of(staged: Staged, table: str) -> LoadResult:
    return LoadResult(table, *staged[2:6], staged.folder)


def historical_load(
    spark: SparkSession, landing: str, silver: str, table: str, day: dt.date | str, reader: Reader = read_landing_geojson, **options
) -> LoadResult:
    """Replace the table with the landed history; ``options`` as in ``load_documents``."""
    options = {"required": REQUIRED_COLUMNS, "refuse_empty": True, **options}
    return load_documents(reader(spark, landing), silver, table, day_stamp(day), replace_all=True, **options)


def daily_load(
    spark: SparkSession, landing: str, silver: str, table: str, day: dt.date | str, reader: Reader = read_landing_geojson, **options
) -> LoadResult:
    """Add the landed day to the table; a repeated day takes the place of its own rows."""
    options = {"required": REQUIRED_COLUMNS_SCHEDULED, **options}
    return load_documents(reader(spark, landing), silver, table, day_stamp(day), **options)


def json_route_load(
    spark: SparkSession,
    landing: str,
    ndjson: str,
    table: str,
    reader: Reader = read_landing_geojson,
    max_bad_records: int = 50,
    max_lost: int = 0,
    ingested_at: dt.datetime | Column | None = None,
    location: str | None = None,
    area: str = "split",
    time_format: str = "timestamp",
) -> LoadResult:
    """Replace the table by way of newline-delimited JSON, with a budget of unreadable lines.

    The lines go to ``outcome=good`` below ``ndjson``, lost records to the partitions beside it, and
    accepted lines that do not parse to ``_unreadable``.
    """
    staged = stage(curate_flagged(reader(spark, landing), area, time_format, ingested_at), ndjson, REQUIRED_COLUMNS, "json")
    check(staged, max_lost)
    nullable = T.StructType([f for f in staged.schema if f.name not in MARKS])
    loaded = load_ndjson(
        spark, f"{ndjson}/{OUTCOME}={GOOD}", nullable, table, max_bad_records, "truncate", location,
        quarantine=f"{ndjson}/_unreadable", required=REQUIRED_COLUMNS,
    )
    return result_of(staged, table)._replace(rows=loaded.rows)
