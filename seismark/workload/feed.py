"""Feed documents derived from ``events``: every event becomes one feature.

Ranges of ``value`` decide which defects a feature carries, so that missing keys, explicit nulls
and absent geometries all occur:

* value below 5: ``mag`` is an explicit null; value of 200 and more: the key is missing
* value in [5, 6): the geometry is null
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENTS_PER_DOCUMENT = 500


def feature_texts(events: DataFrame, blank: str = " ") -> DataFrame:
    """(event_id, ts, feature JSON) per event, with ``blank`` behind the tokens of its outer level."""
    value, kind = F.col("value"), F.col("event_type")
    key_number = F.get_json_object("props", "$.k").cast("int")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    millis = F.timestamp_diff("MILLISECOND", epoch, F.col("ts"))
    place = F.when(kind == "view", F.concat(kind, F.lit(" region"))).otherwise(
        F.concat(
            F.col("user_id").cast("string"), F.lit(" km N of "), kind, F.lit(", K"), key_number
        )
    )
    shared = [
        place.alias("place"),
        millis.alias("time"),
        (millis + 1500).alias("updated"),
        F.lit(None).cast("int").alias("tz"),
        (value / 2).alias("felt"),
        F.lit(None).cast("string").alias("alert"),
        F.lit("reviewed").alias("status"),
        F.when(key_number >= 50, 1).otherwise(0).alias("tsunami"),
        key_number.alias("sig"),
        F.concat(F.lit(","), F.col("event_id").cast("string"), F.lit(",")).alias("ids"),
        F.lit("ml").alias("magType"),
        kind.alias("type"),
        F.concat(F.lit('He said "M", '), place).alias("title"),
    ]
    keep_nulls = {"ignoreNullFields": "false"}
    mag = F.when(value >= 5, value).alias("mag")
    properties = F.when(
        value >= 200, F.to_json(F.struct(*shared), keep_nulls)
    ).otherwise(F.to_json(F.struct(mag, *shared), keep_nulls))
    coordinates = F.array(value, F.col("user_id").cast("double"), F.lit(10.0))
    geometry = F.when((value >= 5) & (value < 6), F.lit("null")).otherwise(
        F.to_json(F.struct(F.lit("Point").alias("type"), coordinates.alias("coordinates")))
    )
    feature = F.concat(
        F.lit(f'{{"type":{blank}"Feature",{blank}"properties":{blank}'), properties,
        F.lit(f',{blank}"geometry":{blank}'), geometry,
        F.lit(f',{blank}"id":{blank}"'), F.col("event_id").cast("string"), F.lit('"}'),
    )
    return events.select("event_id", "ts", feature.alias("feature"))


def feed_documents(events: DataFrame, blank: str = " ") -> DataFrame:
    """Documents of at most 500 features: event_id is unique, so no group can grow beyond that."""
    return (
        feature_texts(events, blank)
        .groupBy(F.floor(F.col("event_id") / EVENTS_PER_DOCUMENT).alias("chunk"))
        .agg(F.collect_list("feature").alias("features"))
        .select(
            F.concat(
                F.lit(f'{{"type":{blank}"FeatureCollection",{blank}"metadata":{blank}{{"count":{blank}'),
                F.size("features").cast("string"),
                F.lit(f'}},{blank}"features":{blank}['),
                F.array_join("features", f",{blank}"),
                F.lit("]}"),
            ).alias("document"),
            "chunk",
        )
    )


def cut_documents(events: DataFrame) -> DataFrame:
    """The documents, every third one cut off at a place of its own: inside a value, behind a
    feature's comma, behind the last feature, at an opening brace."""
    text, cut = F.col("document"), F.col("chunk") % 3 == 1
    behind = lambda mark: F.left(text, F.length(text) - F.instr(F.reverse(text), F.lit(mark)) + F.lit(1))
    places = [F.left(text, F.floor(F.length(text) / 2).cast("int")), behind(","), F.left(text, F.length(text) - 2), behind("{")]
    which = F.pmod(F.floor(F.col("chunk") / 3), F.lit(len(places)))
    found = text
    for i, place in enumerate(places):
        found = F.when(cut & (which == i), place).otherwise(found)
    return feed_documents(events).select(found.alias("document"))


def mistyped_documents(events: DataFrame) -> DataFrame:
    """One document per event whose values come as other JSON types; of three magnitudes one is a
    number, one is text that holds a number, and one does not convert."""
    value, kind = F.col("value").cast("string"), F.col("event_id") % 3
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    millis = F.timestamp_diff("MILLISECOND", epoch, F.col("ts")).cast("string")
    mag = F.when(kind == 0, value).when(kind == 1, F.concat(F.lit('"'), value, F.lit('"'))).otherwise('"unknown"')
    time = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), millis, F.lit('"'))).otherwise(F.concat(millis, F.lit(".0")))
    number = F.col("event_id").cast("string")
    return events.select(
        F.concat(
            F.lit('{"features": [{"type": "Feature", "properties": {"mag": '), mag, F.lit(', "time": '), time,
            F.lit(', "tsunami": true, "felt": "7", "ids": "'), number,
            F.lit('"}, "geometry": {"coordinates": ["'), value, F.lit('", 2, 3.5]}}]}'),
        ).alias("document")
    )


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_PLACE = (
    "CASE WHEN event_type = 'view' THEN 'view region' "
    f"ELSE user_id::VARCHAR || ' km N of ' || event_type || ', K' || ({_K})::VARCHAR END"
)
_GEOMETRY_LOST = "(value >= 5 AND value < 6)"


def curated_sql(keep_nulls: bool) -> str:
    """The curated rows the documents stand for, without ``ingestion_dt``."""
    mag = (
        "CASE WHEN value >= 200 THEN 0.0 WHEN value >= 5 THEN value "
        f"ELSE {'NULL' if keep_nulls else '0.0'} END"
    )
    null_text = "CAST(NULL AS VARCHAR)" if keep_nulls else "''"

    def coordinate(text: str) -> str:
        return f"CASE WHEN {_GEOMETRY_LOST} THEN 0.0::DOUBLE ELSE {text} END"

    area = (
        f"CASE WHEN event_type = 'view' THEN 'view region' "
        f"ELSE event_type || ', K' || ({_K})::VARCHAR END"
    )
    dropped = f"WHERE NOT {_GEOMETRY_LOST}" if keep_nulls else ""
    return f"""
    SELECT CAST({mag} AS DOUBLE) AS mag, {_PLACE} AS place,
           date_trunc('millisecond', ts) AS "time",
           date_trunc('millisecond', ts) + INTERVAL 1500 MILLISECOND AS updated,
           {null_text} AS tz, '' AS url, '' AS detail,
           CAST(trunc(value / 2) AS INTEGER) AS felt, 0.0::DOUBLE AS cdi, 0.0::DOUBLE AS mmi,
           {null_text} AS alert, 'reviewed' AS status, CASE WHEN {_K} >= 50 THEN 1 ELSE 0 END AS tsunami, {_K} AS sig,
           '' AS net, '' AS code, ',' || event_id::VARCHAR || ',' AS ids, '' AS sources,
           '' AS types, 0::INTEGER AS nst, 0.0::DOUBLE AS dmin, 0.0::DOUBLE AS rms,
           0.0::DOUBLE AS gap, 'ml' AS "magType", event_type AS "type",
           'He said "M", ' || {_PLACE} AS title,
           {coordinate('value')} AS longitude, {coordinate('user_id::DOUBLE')} AS latitude,
           {coordinate('10.0::DOUBLE')} AS depth, {area} AS area
    FROM events {dropped}
    """
