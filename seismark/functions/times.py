"""Epoch conversion and day keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# What 64 bits of microseconds hold. Adding an epoch outside would end the job on one bad row.
EPOCH_MS_RANGE = (-(2**63) // 1000 + 1, (2**63 - 1) // 1000 - 1)


def epoch_ms_to_string(ms: Column, fmt: str = SECONDS_FORMAT) -> Column:
    """Whole-second text in the session time zone; milliseconds are cut toward zero."""
    return F.from_unixtime((ms.try_cast("bigint") / 1000).cast("bigint"), fmt)


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """UTC wall-clock timestamp with milliseconds, whatever the session time zone is; null for what a
    timestamp cannot hold."""
    return F.timestamp_add(
        "MILLISECOND",
        valid_epoch_ms(ms.try_cast("bigint")),
        F.lit("1970-01-01").cast("timestamp_ntz"),
    )


def valid_epoch_ms(ms: Column) -> Column:
    """The same number, or null when no timestamp can hold it."""
    return F.when(ms.between(*EPOCH_MS_RANGE), ms)


def epoch_ms_pair(first: Column, second: Column) -> tuple[Column, Column]:
    """Convert both times or neither: each must be present and non-zero."""
    usable = (first.try_cast("bigint") != 0) & (second.try_cast("bigint") != 0)
    return (
        F.when(usable, epoch_ms_to_timestamp(first)),
        F.when(usable, epoch_ms_to_timestamp(second)),
    )


def month_day(time: Column) -> Column:
    """Year-less day key ``MM-dd``."""
    return F.date_format(time, "MM-dd")


def event_date(time: Column) -> Column:
    return F.to_date(time)


def date_stamp(time: Column) -> Column:
    """``yyyyMMdd``, the form used in dated paths."""
    return F.date_format(time, "yyyyMMdd")
