"""Landed documents to the curated event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismark.functions.text import area_regex, area_split
from seismark.functions.times import epoch_ms_to_string, epoch_ms_to_timestamp
from seismark.operators.project import (
    FAILED,
    extract_properties,
    flatten_coerce_default,
    flatten_missing_only,
    not_convertible,
    split_convertible,
    split_failed,
)
from seismark.schema import CURATED_COLUMNS, SOURCE, UNFINISHED, VARIANT_FEATURE
from seismark.sources.documents import explode_entries, explode_features

#: What became of a row of a load, and the text of one that was lost.
OUTCOME, RECORD = "outcome", "record"
GOOD, LOST_ROW, BROKEN, EARLY_END = "good", "failed", "broken", "unfinished"
#: Columns of ``curate_flagged`` that are no part of a curated row.
MARKS = [OUTCOME, RECORD, SOURCE]

AREA_RULES = {"split": area_split, "regex": area_regex}
TIME_RULES = {"timestamp": epoch_ms_to_timestamp, "string": epoch_ms_to_string}


def with_event_times(flat: DataFrame, time_format: str = "timestamp") -> DataFrame:
    convert = TIME_RULES[time_format]
    return flat.withColumns({name: convert(F.col(name)) for name in ("time", "updated")})


def with_area(flat: DataFrame, rule: str = "split", place: str = "place") -> DataFrame:
    return flat.withColumn("area", AREA_RULES[rule](F.col(place)))


def with_ingestion_time(flat: DataFrame, at: dt.datetime | Column | None = None) -> DataFrame:
    """The load time: one value for the whole run, or the one given."""
    stamp = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    return flat.withColumn("ingestion_dt", stamp.cast("timestamp"))


def flatten(documents: DataFrame, missing: str = "null") -> tuple[DataFrame, DataFrame]:
    """(flat rows, failed rows) of parsed documents.

    The null policy follows the feature type: ``RAW_FEATURE`` takes the default for missing and
    null values alike; ``VARIANT_FEATURE`` keeps an explicit null.
    """
    features = explode_features(documents)
    if features.schema["feature"].dataType == VARIANT_FEATURE:
        return split_failed(flatten_missing_only(features))
    convertible, failed = split_convertible(extract_properties(features, missing=missing))
    return flatten_coerce_default(convertible), failed


def curate(
    documents: DataFrame,
    area: str = "split",
    time_format: str = "timestamp",
    ingested_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Documents, as any of the landing readers gives them, to the 31 curated columns.

    Only narrow steps: rows never leave the task that parsed them. Rows that do not convert are
    left out; ``curate_flagged`` keeps them.
    """
    flat, _ = flatten(documents)
    return (
        with_ingestion_time(with_area(with_event_times(flat, time_format), area), ingested_at)
    ).select(*CURATED_COLUMNS)


def curate_flagged(
    documents: DataFrame,
    area: str = "split",
    time_format: str = "timestamp",
    ingested_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """What ``curate`` gives and what it leaves out, in one pass: ``outcome`` tells ``good`` rows,
    ``failed`` features that do not convert, ``broken`` documents, and ``unfinished`` ones where the
    reader can tell; ``record`` holds the text of what is not good, whose other columns mean nothing."""
    entries = explode_entries(documents)
    kept = [c for c in entries.columns if c in ("feature", RECORD, SOURCE, UNFINISHED)]
    if entries.schema["feature"].dataType == VARIANT_FEATURE:
        flat = flatten_missing_only(entries, keep=kept)
    else:
        properties = extract_properties(entries, keep=kept)
        flagged = properties.withColumn(FAILED, not_convertible(properties))
        flat = flatten_coerce_default(flagged, keep=[*kept, FAILED])
    broken, failed = F.col(RECORD).isNotNull(), F.col(FAILED)
    early = F.col(UNFINISHED) if UNFINISHED in kept else F.lit(False)
    status = F.when(broken & early, EARLY_END).when(broken, BROKEN).when(failed, LOST_ROW).otherwise(GOOD)
    record = F.when(broken, F.col(RECORD)).when(failed, F.to_json("feature"))
    timed = with_ingestion_time(with_area(with_event_times(flat, time_format), area), ingested_at)
    source = F.col(SOURCE) if SOURCE in kept else F.lit(None).cast("string")
    return timed.select(*CURATED_COLUMNS, status.alias(OUTCOME), record.alias(RECORD), F.when(broken, source).alias(SOURCE))
