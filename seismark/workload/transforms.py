"""Row transforms on texts and times, and the curation of landed documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.functions import (
    area_regex,
    area_split,
    date_stamp,
    epoch_ms_pair,
    epoch_ms_to_string,
    epoch_ms_to_timestamp,
    event_date,
    month_day,
    state_suffix,
)
from seismark.functions.text import WHITESPACE
from seismark.operators.project import extract_properties, to_json_rows
from seismark.plans.curate import curate, flatten, with_ingestion_time
from seismark.schema import VARIANT_DOCUMENT
from seismark.session import work_folder
from seismark.sinks.files import write_landing_json
from seismark.sources.documents import (
    explode_features,
    parse_documents,
    read_landing_geojson,
    read_landing_text,
    split_documents,
)
from seismark.sources.split import read_landing_split
from seismark.workload.feed import curated_sql, cut_documents, feed_documents, mistyped_documents
from seismark.workload.registry import query, table

_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


@query(
    "SELECT doc_id, CASE WHEN contains(text, ' of ') "
    r"THEN regexp_extract(text, ' of\s*(.*)', 1) ELSE text END AS area FROM documents"
)
def area_regex_texts(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", area_regex(F.col("text")).alias("area"))


@query(
    "SELECT doc_id, CASE WHEN contains(text, ' of ') "
    f"THEN trim(substr(text, instr(text, ' of ') + 4), {_BLANKS}) ELSE text END AS area "
    "FROM documents"
)
def area_split_texts(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", area_split(F.col("text")).alias("area"))


@query(
    "SELECT doc_id, CASE WHEN contains(text, ',') THEN array_to_string(string_split(text, ',')[2:], ',') "
    "ELSE text END AS state FROM documents"
)
def suffix_after_comma(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", state_suffix(F.col("text")).alias("state"))


def _with_millis(spark, sf):
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return table(spark, sf, "events").withColumn(
        "ms", F.timestamp_diff("MILLISECOND", epoch, F.col("ts"))
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events")
def epoch_ms_to_string_events(spark, sf):
    events = _with_millis(spark, sf)
    return events.select("event_id", epoch_ms_to_string(F.col("ms")).alias("time"))


@query("SELECT event_id, date_trunc('millisecond', ts) AS time FROM events")
def epoch_ms_to_timestamp_events(spark, sf):
    events = _with_millis(spark, sf)
    return events.select("event_id", epoch_ms_to_timestamp(F.col("ms")).alias("time"))


@query(
    "SELECT event_id, CASE WHEN value >= 5 THEN date_trunc('millisecond', ts) END AS time, "
    "CASE WHEN value >= 5 THEN date_trunc('millisecond', ts) + INTERVAL 1 SECOND END AS updated "
    "FROM events"
)
def epoch_ms_pair_events(spark, sf):
    """The second time is zero for small values, which leaves both unconverted."""
    second = F.when(F.col("value") >= 5, F.col("ms") + 1000).otherwise(F.lit(0))
    time, updated = epoch_ms_pair(F.col("ms"), second)
    return _with_millis(spark, sf).select(
        "event_id", time.alias("time"), updated.alias("updated")
    )


@query(
    "SELECT o_orderkey, strftime(o_orderdate, '%m-%d') AS day, CAST(o_orderdate AS DATE) AS date, "
    "strftime(o_orderdate, '%Y%m%d') AS stamp FROM orders"
)
def day_keys(spark, sf):
    date = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", month_day(date).alias("day"), event_date(date).alias("date"),
        date_stamp(date).alias("stamp"),
    )


@query(
    "SELECT '{\"event_id\":' || event_id || ',\"ts\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '\",\"user_id\":' || user_id "
    "|| ',\"event_type\":\"' || event_type || '\",\"value\":' || value || ',\"props\":' || to_json(props) || '}' AS value "
    "FROM events"
)
def json_rows(spark, sf):
    return to_json_rows(table(spark, sf, "events"))


_FAR = "(CASE WHEN event_id % 2 = 0 THEN -62167219200000 ELSE 253402300800000 END + event_id * 1000)"


@query(f"SELECT event_id, ({_FAR} // 1000)::BIGINT AS seconds, CASE WHEN event_id % 2 = 0 THEN 0 ELSE 10000 END::INTEGER AS year FROM events")
def epoch_ms_far_years(spark, sf):
    """Times in the years 0 and 10000."""
    far = F.when(F.col("event_id") % 2 == 0, F.lit(-62167219200000)).otherwise(F.lit(253402300800000)) + F.col("event_id") * 1000
    time = epoch_ms_to_timestamp(far)
    since = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time)
    return table(spark, sf, "events").select("event_id", since.alias("seconds"), F.year(time).alias("year"))


# --- landed documents -------------------------------------------------------------------------


def _landed(spark, sf, one_per_file):
    path = work_folder(spark, "landing")
    write_landing_json(
        feed_documents(table(spark, sf, "events")), path, one_per_file=one_per_file
    )
    return path


@query(curated_sql(keep_nulls=False))
def geojson_flatten_default(spark, sf):
    """One document per file."""
    landed = _landed(spark, sf, one_per_file=True)
    return curate(read_landing_geojson(spark, landed)).drop("ingestion_dt")


@query(curated_sql(keep_nulls=True))
def geojson_flatten_preserve(spark, sf):
    """One document per file; explicit nulls stay."""
    landed = _landed(spark, sf, one_per_file=True)
    return curate(read_landing_geojson(spark, landed, VARIANT_DOCUMENT)).drop("ingestion_dt")


@query(curated_sql(keep_nulls=False))
def geojson_lines_curated(spark, sf):
    """One document per line."""
    landed = _landed(spark, sf, one_per_file=False)
    return curate(read_landing_text(spark, landed)).drop("ingestion_dt")


@query(curated_sql(keep_nulls=False))
def geojson_split_curated(spark, sf):
    """Documents cut inside, between their features."""
    landed = _landed(spark, sf, one_per_file=True)
    return curate(read_landing_split(spark, landed)).drop("ingestion_dt")


@query(curated_sql(keep_nulls=False))
def geojson_split_minified(spark, sf):
    """The same without a blank between tokens, on one line."""
    path = work_folder(spark, "landing")
    write_landing_json(feed_documents(table(spark, sf, "events"), blank=""), path, one_per_file=True)
    return curate(read_landing_split(spark, path)).drop("ingestion_dt")


@query(
    "SELECT ',' || event_id::VARCHAR || ',' AS ids, false AS broken FROM events WHERE (event_id // 500) % 3 <> 1 "
    "UNION ALL SELECT NULL, true FROM (SELECT DISTINCT event_id // 500 AS chunk FROM events) WHERE chunk % 3 = 1"
)
def geojson_split_truncated(spark, sf):
    """Every third document is cut off somewhere: it gives no row and is reported once."""
    path = work_folder(spark, "landing")
    write_landing_json(cut_documents(table(spark, sf, "events")), path, one_per_file=True)
    documents = read_landing_split(spark, path)
    rows = curate(documents).select("ids", F.lit(False).alias("broken"))
    return rows.unionAll(split_documents(documents)[1].select(F.lit(None).cast("string").alias("ids"), F.lit(True).alias("broken")))


@query(
    "SELECT value::DOUBLE AS mag, date_trunc('millisecond', ts) AS \"time\", 1::INTEGER AS tsunami, "
    "7::INTEGER AS felt, event_id::VARCHAR AS ids, value::DOUBLE AS longitude, 3.5::DOUBLE AS depth "
    "FROM events WHERE event_id % 3 <> 2"
)
def geojson_mistyped_default(spark, sf):
    """Values of other JSON types than their columns convert; none turns into a default."""
    documents = parse_documents(mistyped_documents(table(spark, sf, "events")), "document")
    return curate(documents).select("mag", "time", "tsunami", "felt", "ids", "longitude", "depth")


@query("SELECT event_id::VARCHAR AS ids FROM events WHERE event_id % 3 = 2")
def geojson_mistyped_failed(spark, sf):
    """Values that do not convert fail their row."""
    documents = parse_documents(mistyped_documents(table(spark, sf, "events")), "document")
    return flatten(documents)[1].select("ids")


@query("SELECT ',' || event_id::VARCHAR || ',' AS ids FROM events WHERE value >= 5 AND value < 6")
def geojson_failed_features(spark, sf):
    """The features the null-preserving flatten leaves out."""
    documents = parse_documents(
        feed_documents(table(spark, sf, "events")), "document", VARIANT_DOCUMENT
    )
    return flatten(documents)[1].select("ids")


@query("SELECT doc_id, text FROM documents")
def landing_text_roundtrip(spark, sf):
    """Whole texts through the landing layer, one JSON document per line."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    path = work_folder(spark, "landing")
    write_landing_json(to_json_rows(documents, "document"), path)
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    )
    return read_landing_text(spark, path, schema)


@query(
    "SELECT event_id::VARCHAR AS ids, value::DOUBLE AS longitude, 3.5::DOUBLE AS depth, "
    "TIMESTAMP '2024-02-03 04:05:06' AS loaded FROM events"
)
def strict_features_loaded_at(spark, sf):
    """Strict extraction of features that all have their coordinates, with a given load time."""
    documents = parse_documents(mistyped_documents(table(spark, sf, "events")), "document")
    strict = extract_properties(explode_features(documents), missing="fail")
    stamped = with_ingestion_time(strict, F.lit("2024-02-03 04:05:06").cast("timestamp_ntz"))
    return stamped.select(
        "ids", F.col("longitude").cast("double"), F.col("depth").cast("double"), F.col("ingestion_dt").cast("timestamp_ntz").alias("loaded")
    )
