"""The nine analysis questions, ordered as their SQL form orders them.

Where the SQL, DataFrame and combiner forms of a question ask for different things, each reading
has its own function. ``exact_scale`` is explained at ``operators.aggregates.mean``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.operators import aggregates as agg
from seismark.operators.filters import (
    AsOf,
    last_days_calendar,
    last_days_rolling,
    peak_rows,
    value_gt,
)
from seismark.operators.sorting import sort_by


class EventColumns(NamedTuple):
    """Names of the region, magnitude and time columns."""

    region: str = "area"
    value: str = "mag"
    time: str = "time"


CURATED = EventColumns()


# 1. How many events per region?
def events_by_region(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return sort_by(agg.count_by_region(df, c.region), "n", ties=(c.region,))


def events_by_state(df: DataFrame, c: EventColumns = CURATED, separator: str = ",") -> DataFrame:
    counts = agg.count_by_state(df, c.region, separator)
    return sort_by(counts, "n", descending=True, ties=("state",))


# 2. What is the average magnitude per region?
def average_by_region(
    df: DataFrame, c: EventColumns = CURATED, exact_scale: int | None = None
) -> DataFrame:
    means = agg.avg_by_region(df, c.region, c.value, exact_scale=exact_scale)
    return sort_by(means, "avg_value", ties=(c.region,))


def average_by_state(
    df: DataFrame, c: EventColumns = CURATED, separator: str = ",", exact_scale: int | None = None
) -> DataFrame:
    means = agg.avg_by_state(df, c.region, c.value, separator, exact_scale=exact_scale)
    return sort_by(means, "avg_value", descending=True, ties=("state",))


# 3. How many events on the same day?
def events_by_month_day(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return sort_by(agg.count_by_month_day(df, c.time), "n", descending=True, ties=("day",))


def events_by_date(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return agg.count_by_date(df, c.time)


# 4. How many events on the same day in the same region?
def events_by_region_month_day(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    counts = agg.count_by_region_month_day(df, c.region, c.time)
    return sort_by(counts, "n", descending=True, ties=(c.region, "day"))


def events_by_state_month_day(
    df: DataFrame, c: EventColumns = CURATED, separator: str = ","
) -> DataFrame:
    counts = agg.count_by_state_month_day(df, c.region, c.time, separator)
    return sort_by(counts, "n", descending=True, ties=("state", "day"))


def events_by_date_region(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return agg.count_by_date_region(df, c.region, c.time)


# 5. What is the average on the same day?
def average_by_month_day(
    df: DataFrame, c: EventColumns = CURATED, exact_scale: int | None = None
) -> DataFrame:
    means = agg.avg_by_month_day(df, c.value, c.time, exact_scale=exact_scale)
    return sort_by(means, "day", descending=True)


def average_events_per_day(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return agg.avg_events_per_day(df, c.time)


# 6. What is the average on the same day in the same region?
def average_by_region_month_day(
    df: DataFrame, c: EventColumns = CURATED, exact_scale: int | None = None
) -> DataFrame:
    means = agg.avg_by_region_month_day(df, c.region, c.value, c.time, exact_scale=exact_scale)
    return sort_by(means, "day", descending=True, ties=(c.region,))


def average_by_state_month_day(
    df: DataFrame, c: EventColumns = CURATED, separator: str = ",", exact_scale: int | None = None
) -> DataFrame:
    means = agg.avg_by_state_month_day(
        df, c.region, c.value, c.time, separator, exact_scale=exact_scale
    )
    return sort_by(means, "day", descending=True, ties=("state",))


# 7. Which region had the strongest event of the last week?
def strongest_ever(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return peak_rows(df.select(c.region, c.time, c.value), c.value).select(c.region, c.time)


def strongest_last_days(
    df: DataFrame, c: EventColumns = CURATED, days: int = 7, as_of: AsOf = None
) -> DataFrame:
    recent = last_days_rolling(df.select(c.region, c.time, c.value), c.time, days, as_of)
    return peak_rows(recent, c.value)


def strongest_last_days_sql(
    df: DataFrame, c: EventColumns = CURATED, days: int = 7, since_sql: str | None = None
) -> DataFrame:
    """The same answer in SQL. ``since_sql`` states the start of the period and may be a scalar
    subquery over ``{events}``; without it the period ends now."""
    if since_sql is None:
        kind = df.schema[c.time].dataType.simpleString()
        since_sql = f"CAST(current_timestamp() AS {kind}) - INTERVAL '{days}' DAY"
    return df.sparkSession.sql(
        f"""
        WITH recent AS (
            SELECT {c.region}, {c.time}, {c.value} FROM {{events}} WHERE {c.time} >= {since_sql}
        )
        SELECT {c.region}, {c.time}, {c.value} FROM recent
        WHERE {c.value} = (SELECT max({c.value}) FROM recent)
        """,
        events=df,
    )


def highest_value_last_dates(
    df: DataFrame, c: EventColumns = CURATED, days: int = 7, as_of: AsOf = None
) -> DataFrame:
    """Only the value, over whole calendar dates."""
    return agg.max_global(last_days_calendar(df, c.time, days, as_of), c.value)


def strongest_region_last_days(
    df: DataFrame, c: EventColumns = CURATED, days: int = 7, as_of: AsOf = None
) -> DataFrame:
    """Only the one region; among equals the smallest name."""
    return agg.argmax_intensity(last_days_rolling(df, c.time, days, as_of), c.region, c.value)


# 8. Which regions have magnitudes above five?
def events_above(df: DataFrame, c: EventColumns = CURATED, threshold: float = 5) -> DataFrame:
    return value_gt(df, c.value, threshold).select(c.region, c.value)


def regions_above(df: DataFrame, c: EventColumns = CURATED, threshold: float = 5) -> DataFrame:
    return agg.distinct_regions(df, c.region, c.value, threshold)


# 9. Which regions have the highest frequency and intensity?
def frequency_and_peak(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    pairs = agg.frequency_and_max(df, c.region, c.value)
    return sort_by(pairs, "frequency", "max_intensity", descending=True, ties=(c.region,))


def frequency_and_average(
    df: DataFrame, c: EventColumns = CURATED, exact_scale: int | None = None
) -> DataFrame:
    pairs = agg.frequency_and_avg(df, c.region, c.value, exact_scale)
    return sort_by(pairs, "frequency", "avg_intensity", descending=True, ties=(c.region,))


def most_frequent_region(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return agg.argmax_frequency(df, c.region)


def most_intense_region(df: DataFrame, c: EventColumns = CURATED) -> DataFrame:
    return agg.argmax_intensity(df, c.region, c.value)


def latest(df: DataFrame, time: str) -> DataFrame:
    """The newest time of a frame as one row, to anchor the week on stored data."""
    return df.agg(F.max(time).alias("latest"))
