"""Writers, table loads, gates, audit and incremental ingestion on the driver tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.operators import aggregates as agg
from seismark.plans.curate import GOOD, RECORD, OUTCOME, curate
from seismark.plans.loads import daily_load, historical_load, json_route_load
from seismark.schema import CORRUPT
from seismark.session import work_folder
from seismark.sinks.audit import AuditLog
from seismark.sinks.files import (
    append_load,
    write_json_rows,
    write_landing_json,
    write_ndjson,
    write_parquet_overwrite,
    write_parquet_typed,
)
from seismark.sinks.gates import MissingRequiredValues, required_null_report, split_bad_records, split_required
from seismark.sinks.staging import check, lost_records, publish, stage
from seismark.sinks.tables import ensure_namespace, load_table
from seismark.sources.documents import read_landing_text
from seismark.sources.tables import (
    read_json_strings_inferred,
    read_parquet,
    read_parquet_glob,
    read_table,
)
from seismark.streaming import incremental_append, incremental_load
from seismark.workload.feed import curated_sql, feed_documents, mistyped_documents
from seismark.workload.registry import query, table

NAMESPACE = "seismark_checks"


def _fresh_table(spark) -> str:
    """A table name no other run uses, in a namespace whose files lie in the shared folder."""
    ensure_namespace(spark, NAMESPACE, work_folder(spark, "warehouse"))
    return f"{NAMESPACE}.t_{uuid.uuid4().hex}"


# --- files ------------------------------------------------------------------------------------


@query("SELECT * FROM events")
def parquet_roundtrip(spark, sf):
    """Two days are written and the second one twice: a day is replaced, not added to."""
    events = table(spark, sf, "events")
    path = work_folder(spark, "silver")
    early = F.col("value") < 10
    write_parquet_overwrite(events.filter(early), path, "20240101")
    write_parquet_overwrite(events, path, "20240102")
    write_parquet_overwrite(events.filter(~early), path, dt.date(2024, 1, 2))
    return read_parquet(spark, path).drop("ingest_date")


@query("SELECT * FROM events")
def parquet_glob_roundtrip(spark, sf):
    path = work_folder(spark, "silver")
    write_parquet_overwrite(table(spark, sf, "events"), f"{path}/deep/er")
    return read_parquet_glob(spark, path)


@query(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, ts, "
    "CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM events"
)
def parquet_typed_roundtrip(spark, sf):
    """A declared schema with 32-bit floats; the width they lose shows in the result."""
    schema = T.StructType(
        [
            T.StructField("event_id", T.StringType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("value", T.FloatType()),
        ]
    )
    path = work_folder(spark, "typed")
    write_parquet_typed(table(spark, sf, "events"), path, schema)
    return read_parquet(spark, path).withColumn("value", F.col("value").cast("double"))


@query("SELECT * FROM events")
def ndjson_roundtrip(spark, sf):
    events = table(spark, sf, "events")
    path = work_folder(spark, "ndjson")
    write_ndjson(events, path)
    return spark.read.schema(events.schema).json(path)


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate, "
    "o_orderpriority FROM orders"
)
def json_strings_inferred(spark, sf):
    """JSON rows read back with no declared schema; a time comes back as its text."""
    path = work_folder(spark, "rows")
    write_json_rows(table(spark, sf, "orders"), path)
    return read_json_strings_inferred(spark, path)


# --- tables -----------------------------------------------------------------------------------


@query("SELECT * FROM events UNION ALL SELECT * FROM events")
def append_twice(spark, sf):
    name, events = _fresh_table(spark), table(spark, sf, "events")
    for _ in range(2):
        load_table(events, name, "append")
    return read_table(spark, name)


@query("SELECT o_orderstatus, count(*) AS n, 2::BIGINT AS files FROM orders GROUP BY o_orderstatus")
def append_rebalanced(spark, sf):
    """Loads of many small tasks with the default disposition, an append, make one file each."""
    name, orders = _fresh_table(spark), table(spark, sf, "orders").repartition(40)
    first = F.col("o_orderkey") % 2 == 0
    load_table(orders.filter(first), name, rebalance=True)
    load_table(orders.filter(~first), name, rebalance=True)
    loaded = read_table(spark, name)
    files = loaded.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).scalar()
    return loaded.groupBy("o_orderstatus").agg(agg.row_tally().alias("n"), F.first(files).alias("files"))


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def overwrite_table(spark, sf):
    name, orders = _fresh_table(spark), table(spark, sf, "orders")
    load_table(orders, name, "truncate", required=["o_orderkey"])
    load_table(orders.filter(F.col("o_orderstatus") == "F"), name, "truncate")
    return read_table(spark, name)


@query("SELECT count(*) AS loaded, count(*) AS stored FROM lineitem")
def loaded_row_count(spark, sf):
    """The count taken while writing, beside the count of the table."""
    name = _fresh_table(spark)
    loaded = load_table(table(spark, sf, "lineitem"), name, "truncate").rows
    stored = agg.row_count(read_table(spark, name), "stored")
    return stored.select(F.lit(loaded).cast("bigint").alias("loaded"), "stored")


@query(curated_sql(keep_nulls=False))
def json_route_table(spark, sf):
    """Landed lines, newline-delimited JSON, then the table."""
    landing = work_folder(spark, "landing")
    write_landing_json(feed_documents(table(spark, sf, "events")), landing)
    name = _fresh_table(spark)
    json_route_load(
        spark, landing, work_folder(spark, "ndjson"), name, reader=read_landing_text
    )
    return read_table(spark, name).drop("ingestion_dt")


@query(f"{curated_sql(keep_nulls=False)} UNION ALL {curated_sql(keep_nulls=False)}")
def history_then_daily_table(spark, sf):
    """The history replaces the table, the day is appended: its events occur twice."""
    landing = work_folder(spark, "landing")
    write_landing_json(feed_documents(table(spark, sf, "events")), landing)
    name, silver = _fresh_table(spark), work_folder(spark, "silver")
    historical_load(spark, landing, silver, name, "20240101", reader=read_landing_text)
    daily_load(spark, landing, silver, name, "20240102", reader=read_landing_text)
    return read_table(spark, name).drop("ingestion_dt", "load_id")


@query(
    "SELECT l.load_id, count(*) AS n, count(DISTINCT event_id) AS events FROM events "
    "CROSS JOIN (VALUES ('20240101'), ('20240102')) l(load_id) GROUP BY l.load_id"
)
def daily_load_repeated(spark, sf):
    """A day that is loaded three times is in the table once."""
    landing = work_folder(spark, "landing")
    write_landing_json(feed_documents(table(spark, sf, "events")), landing)
    name, silver = _fresh_table(spark), work_folder(spark, "silver")
    historical_load(spark, landing, silver, name, "20240101", reader=read_landing_text)
    for _ in range(3):
        daily_load(spark, landing, silver, name, "20240102", reader=read_landing_text)
    return read_table(spark, name).groupBy("load_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ids").alias("events")
    )


@query(
    "SELECT ',' || event_id::VARCHAR || ',' AS ids, 'history' AS part FROM events WHERE ts < TIMESTAMP '2024-01-15' "
    "UNION ALL SELECT ',' || event_id::VARCHAR || ',', 'stream' FROM events WHERE ts >= TIMESTAMP '2024-01-15'"
)
def incremental_into_table(spark, sf):
    """The stream adds its batches to the table that the history load made."""
    events, middle = table(spark, sf, "events"), F.lit("2024-01-15").cast("timestamp_ntz")
    history, landing = work_folder(spark, "landing"), work_folder(spark, "landing")
    name, silver, seen = _fresh_table(spark), work_folder(spark, "silver"), work_folder(spark, "progress")
    write_landing_json(feed_documents(events.filter(F.col("ts") < middle)), history)
    historical_load(spark, history, silver, name, "history", reader=read_landing_text)
    write_landing_json(feed_documents(events.filter(F.col("ts") >= middle)), landing)
    for _ in range(2):
        incremental_load(spark, landing, silver, name, seen, reader=read_landing_text)
    part = F.when(F.col("load_id") == "history", F.col("load_id")).otherwise("stream")
    return read_table(spark, name).select("ids", part.alias("part"))


@query(
    "SELECT 'good' AS outcome, count(*) AS n FROM events WHERE event_id % 3 <> 2 UNION ALL "
    "SELECT 'failed', count(*) FROM events WHERE event_id % 3 = 2 UNION ALL "
    "SELECT 'broken', count(*) FROM events WHERE event_id % 7 = 0"
)
def load_loss_counts(spark, sf):
    """A load that names its tolerance; every outcome is counted in the one pass that writes it."""
    landing, silver = work_folder(spark, "landing"), work_folder(spark, "silver")
    events = table(spark, sf, "events")
    broken = events.filter(F.col("event_id") % 7 == 0).select(F.lit('{"features": [').alias("document"))
    write_landing_json(mistyped_documents(events).unionAll(broken), landing)
    found = historical_load(
        spark, landing, silver, _fresh_table(spark), "20240101", reader=read_landing_text, required=(), max_lost=10**9
    )
    written = lost_records(spark, found.folder).groupBy("outcome").agg(agg.row_tally().alias("n"))
    good = read_table(spark, found.table).agg(agg.row_tally().alias("n")).select(F.lit("good").alias("outcome"), "n")
    return written.unionByName(good)


@query(
    "SELECT 'failed' AS outcome, event_id::VARCHAR AS ids FROM events WHERE event_id % 3 = 2 UNION ALL "
    "SELECT 'good', event_id::VARCHAR FROM events WHERE event_id % 3 <> 2"
)
def json_route_quarantine(spark, sf):
    """Features that did not convert lie beside the lines of the others, as JSON."""
    landing, lines = work_folder(spark, "landing"), work_folder(spark, "ndjson")
    write_landing_json(mistyped_documents(table(spark, sf, "events")), landing)
    found = json_route_load(spark, landing, lines, _fresh_table(spark), reader=read_landing_text, max_lost=10**9)
    lost = lost_records(spark, found.folder, fmt="json")
    ids = F.get_json_object("record", "$.properties.ids").alias("ids")
    return lost.select("outcome", ids).unionAll(read_table(spark, found.table).select(F.lit("good"), "ids"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def truncate_refused(spark, sf):
    """A load with nulls in a required column is written, counted and refused; the table stays."""
    name, silver = _fresh_table(spark), work_folder(spark, "silver")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    marks = [F.lit(GOOD).alias(OUTCOME), F.lit(None).cast("string").alias(RECORD)]
    kept = orders.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")
    holes = orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).drop("o_orderstatus")
    for load, rows in (("first", kept), ("second", holes)):
        staged = stage(rows.select("*", *marks), f"{silver}/{load}", ["o_totalprice"])
        try:
            check(staged)
        except MissingRequiredValues:
            continue
        publish(spark, staged, name, load, silver, replace_all=True)
    return read_table(spark, name).drop("load_id")


# --- gates ------------------------------------------------------------------------------------


@query(
    "SELECT CASE WHEN value > 100 THEN NULL "
    "ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, "
    "CASE WHEN value > 100 THEN replace(props, '}', '') END AS record FROM events"
)
def bad_record_split(spark, sf):
    """Lines without their closing brace go to the side output, the others parse."""
    broken = F.replace(F.col("props"), F.lit("}"), F.lit(""))
    path = work_folder(spark, "lines")
    (
        table(spark, sf, "events")
        .select(F.when(F.col("value") > 100, broken).otherwise(F.col("props")).alias("value"))
        .write.text(path)
    )
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField(CORRUPT, T.StringType())]
    )
    good, bad = split_bad_records(read_landing_text(spark, path, schema))
    return good.select("k", F.lit(None).cast("string").alias("record")).unionAll(
        bad.select(F.lit(None).cast("bigint").alias("k"), "record")
    )


def _holes(spark, sf):
    return table(spark, sf, "events").withColumns(
        {
            "value": F.when(F.col("value") >= 5, F.col("value")),
            "event_type": F.nullif(F.col("event_type"), F.lit("view")),
        }
    )


@query(
    "SELECT count(*) FILTER (value < 5) AS value, count(*) FILTER (event_type = 'view') "
    "AS event_type, 0::BIGINT AS ts FROM events"
)
def required_null_counts(spark, sf):
    return required_null_report(_holes(spark, sf), ["value", "event_type", "ts"])


@query(
    "SELECT event_id, NOT (value < 5 OR event_type = 'view') AS complete FROM events"
)
def required_split(spark, sf):
    complete, rejected = split_required(_holes(spark, sf), ["value", "event_type", "ts"])
    return complete.select("event_id", F.lit(True).alias("complete")).unionAll(
        rejected.select("event_id", F.lit(False).alias("complete"))
    )


# --- audit and increments ---------------------------------------------------------------------


@query(
    "SELECT step_name, status, error_message, additional_info FROM (VALUES "
    "('load', 'STARTED', '', ''), ('check', 'STARTED', '', ''), "
    "('check', 'FAILURE', 'no negative values expected', '')) "
    "t(step_name, status, error_message, additional_info) "
    "UNION ALL SELECT 'load', 'SUCCESS', '', count(*)::VARCHAR FROM events"
)
def audit_log(spark, sf):
    events = table(spark, sf, "events")
    log = AuditLog(spark, work_folder(spark, "audit"), "events-check")
    with log.step("load") as step:
        step.info = str(load_table(events, _fresh_table(spark), "truncate").rows)
    try:
        with log.step("check"):
            if events.filter(F.col("value") < 0).isEmpty():
                raise ValueError("no negative values expected")
    except ValueError:
        pass
    return log.read().select("step_name", "status", "error_message", "additional_info")


@query(curated_sql(keep_nulls=False))
def incremental_append_feed(spark, sf):
    """Half the history is a batch load, the rest lands in two instalments and is streamed in;
    a last run finds nothing new."""
    events = table(spark, sf, "events")
    landing, target = work_folder(spark, "landing"), work_folder(spark, "curated")
    checkpoint = work_folder(spark, "progress")
    middle, late = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-15", "2024-01-22"))
    history = work_folder(spark, "landing")
    write_landing_json(feed_documents(events.filter(F.col("ts") < middle)), history)
    append_load(curate(read_landing_text(spark, history)), target, "history")
    for part in ((F.col("ts") >= middle) & (F.col("ts") < late), F.col("ts") >= late, None):
        if part is not None:
            write_landing_json(feed_documents(events.filter(part)), landing, mode="append")
        incremental_append(spark, landing, target, checkpoint, reader=read_landing_text)
    return read_parquet(spark, target).drop("ingestion_dt", "load_id")
