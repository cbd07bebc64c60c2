"""Row filters. Each one is a plain predicate, so Catalyst pushes it to the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A moment, or a one-row frame that yields it, such as ``events.agg(F.max("time"))``.
AsOf = Column | DataFrame | dt.datetime | dt.date | None


def value_gt(df: DataFrame, value: str = "mag", threshold: float = 5) -> DataFrame:
    """Strictly above the threshold; null is dropped."""
    return df.filter(F.col(value) > threshold)


def _start(as_of: AsOf, now: Column, shift: Callable[[Column], Column]) -> Column:
    """The shifted moment. For a frame the shift is part of the scalar subquery: the filter then
    compares a column with a bare scalar, which is a form the scan can use."""
    if isinstance(as_of, DataFrame):
        return as_of.select(shift(F.col(as_of.columns[0]))).scalar()
    if as_of is None:
        return shift(now)
    return shift(as_of if isinstance(as_of, Column) else F.lit(as_of))


def last_days_rolling(
    df: DataFrame, time: str = "time", days: int = 7, as_of: AsOf = None
) -> DataFrame:
    """At or after ``days`` times 24 hours before ``as_of`` (default: now)."""
    kind, span = df.schema[time].dataType, F.make_dt_interval(F.lit(days))
    start = _start(as_of, F.current_timestamp(), lambda moment: moment.cast(kind) - span)
    return df.filter(F.col(time) >= start)


def last_days_clustered(
    df: DataFrame, time: str = "time", day: str = "event_date", days: int = 7, as_of: AsOf = None
) -> DataFrame:
    """``last_days_rolling`` on a layer with a folder per day: the days before are not listed."""
    kind, span = df.schema[time].dataType, F.make_dt_interval(F.lit(days))
    first = _start(as_of, F.current_timestamp(), lambda moment: (moment.cast(kind) - span).cast("date"))
    return last_days_rolling(df.filter(F.col(day) >= first), time, days, as_of)


def last_days_calendar(
    df: DataFrame, date: str = "date", days: int = 7, as_of: AsOf = None
) -> DataFrame:
    """On or after the date ``days`` before ``as_of`` (default: today), so ``days + 1`` dates.

    A time column is compared with the first midnight, so that the test reaches the scan.
    """
    kind = df.schema[date].dataType
    start = _start(
        as_of,
        F.current_date(),
        lambda moment: F.date_sub(moment.cast("date"), days).cast(kind),
    )
    return df.filter(F.col(date) >= start)


def peak_rows(df: DataFrame, value: str = "mag") -> DataFrame:
    """Rows that hold the highest value; ties are all kept.

    The maximum is a scalar subquery: it is reduced to one value before the second scan, which
    then skips every row group whose statistics lie below it.
    """
    return df.filter(F.col(value) == df.agg(F.max(value)).scalar())


def contains_literal(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.filter(F.col(column).contains(text))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column is present."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df
