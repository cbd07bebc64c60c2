"""Counts, means and peaks per region, state and day.

Every grouping uses built-in aggregates, which are reduced inside each input task before the
shuffle: a region that holds a third of all rows sends one row per task, like any other.
Day keys are grouped as numbers and turned into text after the grouping, so no string is built
per input row.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.functions.text import state_suffix
from seismark.functions.times import event_date
from seismark.operators.filters import value_gt
from seismark.shipping import ship_package

_DAY_CODE = "_day_code"
_LOW_BITS = 20


def row_tally() -> Column:
    return F.count(F.lit(1))


def mean(value: str, exact_scale: int | None = None) -> Column:
    """The mean of a numeric column.

    A sum of doubles depends on the order of its terms, so a retried task can change the last
    digit. With ``exact_scale`` the terms are summed as whole units of that many decimals instead:
    the result is the same on every run, and exact when the values have no more decimals than that.
    Two integer sums, of the high and the low bits, take as long as one sum of doubles and leave
    room for far more rows than one would. Terms that no such integer holds (NaN, infinite, beyond
    2**53 units) are summed as doubles beside them.
    """
    if exact_scale is None:
        return F.avg(value)
    term = F.col(value).cast("double")
    scaled = F.rint(term * 10**exact_scale)
    whole = F.abs(scaled) < float(1 << 53)  # false for NaN, which Spark orders last
    units = F.when(whole, scaled).try_cast("bigint")
    high = F.sum(F.shiftright(units, _LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    exact = F.coalesce((high * float(1 << _LOW_BITS) + low) / 10**exact_scale, F.lit(0.0))
    other = F.sum(F.when(~whole, term))
    total = F.when(other.isNull(), exact).otherwise(exact + other)
    return F.when(F.count(value) > 0, total / F.count(value))


_EXPONENT, _HALF = "_exponent", 28
_EXACT_BINS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("exponent", "high", "low")]))


def exact_means(df: DataFrame, keys: Sequence[str], value: str, out: str = "avg_value") -> DataFrame:
    """The exact mean of doubles of any size, rounded once: the same for any order of the rows and
    after any retry, without a scale.

    A double is a whole number times a power of two. The whole numbers are summed by that power, in
    two halves that have room for 2**35 rows, with partial sums before the shuffle; what is left, some
    dozens of numbers a group, is added as fractions. NaN and infinities are summed beside them.
    """
    ship_package(df.sparkSession)
    term = F.col(value).cast("double")
    finite = ~F.isnan(term) & (F.abs(term) < float("inf"))
    power = F.when(finite & (term != 0), F.floor(F.log2(F.abs(term))))  # may be one off, which whole keeps room for
    shift = F.lit(54) - F.col(_EXPONENT)
    first = F.floor(shift / 2)
    whole = (F.col("_term") * F.pow(F.lit(2.0), first) * F.pow(F.lit(2.0), shift - first)).cast("bigint")
    split = df.select(*keys, term.alias("_term"), power.cast("bigint").alias(_EXPONENT), F.when(~finite, term).alias("_other"))
    bins = split.groupBy(*keys, _EXPONENT).agg(
        F.sum(F.shiftright(whole, _HALF)).alias("high"), F.sum(whole.bitwiseAND(F.lit((1 << _HALF) - 1))).alias("low"),
        F.count("_term").alias("_n"), F.sum("_other").alias("_other"),
    )
    held = F.when(F.col(_EXPONENT).isNotNull(), F.struct(F.col(_EXPONENT).alias("exponent"), "high", "low"))
    grouped = bins.groupBy(*keys).agg(
        F.collect_list(held).cast(_EXACT_BINS).alias("_bins"), F.sum("_n").alias("_n"), F.sum("_other").alias("_other")
    )
    added = F.pandas_udf(_exact_quotients, "double")
    exact = F.when(F.col("_n") > 0, added("_bins", "_n"))
    return grouped.select(*keys, F.when(F.col("_other").isNotNull(), F.col("_other")).otherwise(exact).alias(out))


def _exact_quotients(bins: pd.Series, n: pd.Series) -> pd.Series:
    means = []
    for own, count in zip(bins, n, strict=True):
        total = sum(((int(b["high"]) << _HALF) + int(b["low"])) * Fraction(2) ** (int(b["exponent"]) - 54) for b in own)
        means.append(float(Fraction(total) / int(count)) if count else 0.0)
    return pd.Series(means, dtype="float64")


def question_sets(df: DataFrame, region: str = "area", value: str = "mag", time: str = "time") -> DataFrame:
    """Counts, means and peaks of all groupings the questions ask for, from one scan and one shuffle.

    ``grouping`` tells which keys a row is grouped by: a bit each for region (4), date (2) and
    month-day (1) that is set when the key is not used.
    """
    time_keys = df.select(
        F.col(region).alias("region"), event_date(F.col(time)).alias("date"),
        (F.month(time) * 100 + F.dayofmonth(time)).alias("month_day"), F.col(value).alias("value"),
    )
    r, d, m = (F.col(c) for c in ("region", "date", "month_day"))
    sets = [[], [r], [d], [m], [d, r], [r, m]]
    return time_keys.groupingSets(sets, r, d, m).agg(
        F.grouping_id("region", "date", "month_day").alias("grouping"), row_tally().alias("n"),
        F.avg("value").alias("avg_value"), F.max("value").alias("max_value"),
    )


def _state(region: str, separator: str) -> Column:
    return state_suffix(F.col(region), separator).alias("state")


def _by_day_code(df: DataFrame, keys: list[Column | str], time: str, day: str, out: Column):
    """Group by keys and the year-less day, as ``month * 100 + day`` while grouping."""
    code = (F.month(time) * 100 + F.dayofmonth(time)).alias(_DAY_CODE)
    grouped = df.groupBy(*keys, code).agg(out)
    text = F.format_string("%02d-%02d", F.floor(F.col(_DAY_CODE) / 100), F.col(_DAY_CODE) % 100)
    names = grouped.columns
    return grouped.select(
        *[
            F.when(F.col(_DAY_CODE).isNotNull(), text).alias(day) if n == _DAY_CODE else F.col(n)
            for n in names
        ]
    )


def count_by_region(df: DataFrame, region: str = "area", out: str = "n") -> DataFrame:
    return df.groupBy(region).agg(row_tally().alias(out))


def count_by_state(
    df: DataFrame, region: str = "area", separator: str = ",", out: str = "n"
) -> DataFrame:
    return df.groupBy(_state(region, separator)).agg(row_tally().alias(out))


def avg_by_region(
    df: DataFrame, region: str = "area", value: str = "mag", out: str = "avg_value",
    exact_scale: int | None = None,
) -> DataFrame:
    return df.groupBy(region).agg(mean(value, exact_scale).alias(out))


def avg_by_state(
    df: DataFrame, region: str = "area", value: str = "mag", separator: str = ",",
    out: str = "avg_value", exact_scale: int | None = None,
) -> DataFrame:
    return df.groupBy(_state(region, separator)).agg(mean(value, exact_scale).alias(out))


def count_by_month_day(df: DataFrame, time: str = "time", out: str = "n") -> DataFrame:
    """Per ``MM-dd``; the same day of different years falls together."""
    return _by_day_code(df, [], time, "day", row_tally().alias(out))


def count_by_date(df: DataFrame, time: str = "time", out: str = "n") -> DataFrame:
    return df.groupBy(event_date(F.col(time)).alias("date")).agg(row_tally().alias(out))


def count_by_region_month_day(
    df: DataFrame, region: str = "area", time: str = "time", out: str = "n"
) -> DataFrame:
    return _by_day_code(df, [region], time, "day", row_tally().alias(out))


def count_by_state_month_day(
    df: DataFrame, region: str = "area", time: str = "time", separator: str = ",", out: str = "n"
) -> DataFrame:
    return _by_day_code(df, [_state(region, separator)], time, "day", row_tally().alias(out))


def count_by_date_region(
    df: DataFrame, region: str = "area", time: str = "time", out: str = "n"
) -> DataFrame:
    return df.groupBy(event_date(F.col(time)).alias("date"), region).agg(row_tally().alias(out))


def avg_by_month_day(
    df: DataFrame, value: str = "mag", time: str = "time", out: str = "avg_value",
    exact_scale: int | None = None,
) -> DataFrame:
    return _by_day_code(df, [], time, "day", mean(value, exact_scale).alias(out))


def avg_by_region_month_day(
    df: DataFrame, region: str = "area", value: str = "mag", time: str = "time",
    out: str = "avg_value", exact_scale: int | None = None,
) -> DataFrame:
    return _by_day_code(df, [region], time, "day", mean(value, exact_scale).alias(out))


def avg_by_state_month_day(
    df: DataFrame, region: str = "area", value: str = "mag", time: str = "time",
    separator: str = ",", out: str = "avg_value", exact_scale: int | None = None,
) -> DataFrame:
    return _by_day_code(
        df, [_state(region, separator)], time, "day", mean(value, exact_scale).alias(out)
    )


def avg_events_per_day(df: DataFrame, time: str = "time", out: str = "avg_events") -> DataFrame:
    """The mean of the daily counts, one row."""
    return count_by_date(df, time).agg(F.avg("n").alias(out))


def max_global(df: DataFrame, value: str = "mag", out: str = "max_value") -> DataFrame:
    return df.agg(F.max(value).alias(out))


def max_by_region(
    df: DataFrame, region: str = "area", value: str = "mag", out: str = "max_value"
) -> DataFrame:
    return df.groupBy(region).agg(F.max(value).alias(out))


def frequency_and_max(df: DataFrame, region: str = "area", value: str = "mag") -> DataFrame:
    return df.groupBy(region).agg(
        row_tally().alias("frequency"), F.max(value).alias("max_intensity")
    )


def frequency_and_avg(
    df: DataFrame, region: str = "area", value: str = "mag", exact_scale: int | None = None
) -> DataFrame:
    return df.groupBy(region).agg(
        row_tally().alias("frequency"), mean(value, exact_scale).alias("avg_intensity")
    )


def _first_by(df: DataFrame, score: str, region: str) -> DataFrame:
    """The region with the highest score; among equals the smallest name."""
    return df.orderBy(F.desc_nulls_last(score), F.asc_nulls_last(region)).limit(1)


def argmax_frequency(df: DataFrame, region: str = "area") -> DataFrame:
    return _first_by(count_by_region(df, region, "frequency"), "frequency", region)


def argmax_intensity(df: DataFrame, region: str = "area", value: str = "mag") -> DataFrame:
    return _first_by(max_by_region(df, region, value, "max_intensity"), "max_intensity", region)


def distinct_regions(
    df: DataFrame, region: str = "area", value: str = "mag", threshold: float = 5
) -> DataFrame:
    """The regions with any value above the threshold."""
    return value_gt(df, value, threshold).select(region).distinct()


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    return df.agg(row_tally().alias(out))
