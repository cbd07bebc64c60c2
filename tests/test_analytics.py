"""Aggregates, filters and orders against plain Python on small tables with nulls and ties."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seismark.operators import aggregates as agg
from seismark.operators.filters import (
    last_days_calendar,
    last_days_rolling,
    peak_rows,
    value_gt,
)
from seismark.operators.sorting import sort_by, top_k_by_key
from seismark.plans import questions as ask

SCHEMA = "area string, time timestamp_ntz, mag double"
AREAS = ["Town, CA", "Other, CA", "Fiji", "", None]

rows_of_events = st.lists(
    st.tuples(
        st.sampled_from(AREAS),
        st.one_of(
            st.none(),
            st.datetimes(dt.datetime(2019, 12, 25), dt.datetime(2021, 3, 5)),
        ),
        st.one_of(st.none(), st.integers(-200, 900).map(lambda n: n / 100)),
    ),
    max_size=25,
)
few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def pairs(df):
    return Counter(tuple(r) for r in df.collect())


def state(area):
    return None if area is None else area[area.find(",") + 1 :]


def grouped(rows, key, value=lambda r: 1):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(value(r))
    return out


def mean(values):
    present = [round(v * 100) for v in values if v is not None]
    return sum(present) / 100 / len(present) if present else None


def flat(key, value):
    return (*key, value) if isinstance(key, tuple) else (key, value)


def md(t):
    return t and t.strftime("%m-%d")


@few
@given(rows=rows_of_events)
def test_groupings_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    keys = {
        "region": lambda r: r[0],
        "state": lambda r: state(r[0]),
        "month_day": lambda r: md(r[1]),
        "region_month_day": lambda r: (r[0], md(r[1])),
        "state_month_day": lambda r: (state(r[0]), md(r[1])),
    }
    for name, key in keys.items():
        counts = {k: len(v) for k, v in grouped(rows, key).items()}
        means = {k: mean(v) for k, v in grouped(rows, key, lambda r: r[2]).items()}
        got = pairs(getattr(agg, f"count_by_{name}")(df))
        assert got == Counter(flat(k, v) for k, v in counts.items()), name
        got = pairs(getattr(agg, f"avg_by_{name}")(df, exact_scale=2))
        assert got == Counter(flat(k, v) for k, v in means.items()), name
    day = lambda r: r[1] and r[1].date()
    counts = {k: len(v) for k, v in grouped(rows, day).items()}
    assert pairs(agg.count_by_date(df)) == Counter(counts.items())
    both = {k: len(v) for k, v in grouped(rows, lambda r: (day(r), r[0])).items()}
    assert pairs(agg.count_by_date_region(df)) == Counter(flat(k, v) for k, v in both.items())
    per_day = agg.avg_events_per_day(df).first()[0]
    assert per_day == (sum(counts.values()) / len(counts) if counts else None)


@few
@given(rows=rows_of_events)
def test_peaks_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    present = [r for r in rows if r[2] is not None]
    top = max((r[2] for r in present), default=None)
    assert agg.max_global(df).first()[0] == top
    assert pairs(peak_rows(df)) == Counter(r for r in present if r[2] == top)
    assert pairs(value_gt(df)) == Counter(r for r in present if r[2] > 5)
    assert pairs(agg.distinct_regions(df)) == Counter({(r[0],) for r in present if r[2] > 5})
    freq = grouped(rows, lambda r: r[0])
    last = lambda area: (area is None, area or "")
    if rows:
        want = min(freq, key=lambda a: (-len(freq[a]), last(a)))
        assert tuple(agg.argmax_frequency(df).first()) == (want, len(freq[want]))
    if present:
        want = min((r[0] for r in present if r[2] == top), key=last)
        assert tuple(agg.argmax_intensity(df).first()) == (want, top)


@few
@given(rows=rows_of_events, back=st.integers(0, 30))
def test_recent_rows_equal_brute_force(spark, rows, back):
    now = dt.datetime(2021, 3, 6, 13, 30) - dt.timedelta(days=back)
    df = spark.createDataFrame(rows, SCHEMA)
    rolling = [r for r in rows if r[1] and r[1] >= now - dt.timedelta(days=7)]
    assert pairs(last_days_rolling(df, as_of=now)) == Counter(rolling)
    first = now.date() - dt.timedelta(days=7)
    calendar = [r for r in rows if r[1] and r[1].date() >= first]
    assert pairs(last_days_calendar(df, "time", as_of=now)) == Counter(calendar)
    dated = df.withColumn("date", F.to_date("time"))
    assert pairs(last_days_calendar(dated, as_of=now.date()).drop("date")) == Counter(calendar)
    top = max((r[2] for r in rolling if r[2] is not None), default=None)
    want = Counter(r for r in rolling if r[2] is not None and r[2] == top)
    assert pairs(ask.strongest_last_days(df, as_of=now)) == want
    since = f"TIMESTAMP_NTZ'{now:%Y-%m-%d %H:%M:%S}' - INTERVAL '7' DAY"
    assert pairs(ask.strongest_last_days_sql(df, since_sql=since)) == want
    one_row = spark.range(1).select(F.lit(now).cast("timestamp").alias("t"))
    assert pairs(last_days_rolling(df, as_of=one_row)) == Counter(rolling)
    assert pairs(last_days_calendar(df, "time", as_of=one_row)) == Counter(calendar)
    peak = ask.highest_value_last_dates(df, as_of=now).first()[0]
    assert peak == max((r[2] for r in calendar if r[2] is not None), default=None)


def test_recent_rows_default_to_now(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    times = [now - dt.timedelta(days=d) for d in (1, 6.9, 7.1, 9)]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(
            [("A", t, float(i)) for i, t in enumerate(times)], SCHEMA
        ).withColumn("time", F.col("time").cast(kind))
        assert sorted(r.mag for r in last_days_rolling(df).collect()) == [0.0, 1.0]
        assert ask.strongest_last_days_sql(df).first().mag == 1.0
        assert 3.0 not in {r.mag for r in last_days_calendar(df, "time").collect()}


def test_plain_mean_and_exact_mean(spark):
    df = spark.createDataFrame([("A", None, 0.1)] * 10 + [("A", None, None)], SCHEMA)
    assert agg.avg_by_region(df).first().avg_value == pytest.approx(0.1)
    assert agg.avg_by_region(df, exact_scale=2).first().avg_value == 0.1
    assert agg.frequency_and_avg(df, exact_scale=2).first() == ("A", 11, 0.1)


def test_default_order_of_the_questions(spark):
    rows = [("B", None, 1.0)] * 2 + [("A", None, 2.0)] * 2 + [("C", None, 9.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.area for r in ask.events_by_region(df).collect()] == ["C", "A", "B"]
    assert [r.area for r in ask.frequency_and_peak(df).collect()] == ["A", "B", "C"]
    assert [r.area for r in ask.average_by_region(df).collect()] == ["B", "A", "C"]


def test_orders_place_nulls(spark):
    df = spark.createDataFrame([(2, "b"), (None, "a"), (1, "c"), (2, "a")], "k int, v string")
    assert [tuple(r) for r in sort_by(df, "k", ties=("v",)).collect()] == [
        (None, "a"), (1, "c"), (2, "a"), (2, "b"),
    ]
    assert [r.k for r in sort_by(df, "k", descending=True).collect()] == [2, 2, 1, None]
    assert [tuple(r) for r in top_k_by_key(df, "k", "v", k=3).collect()] == [
        (None, "a"), (1, "c"), (2, "a"),
    ]


def test_exact_mean_of_terms_no_integer_holds(spark):
    rows = [("a", 0.25), ("a", 0.5), ("nan", 1.0), ("nan", float("nan")), ("huge", 1e300), ("huge", 1.0)]
    rows += [("inf", float("inf")), ("none", None), ("part", None), ("part", 0.1)]
    df = spark.createDataFrame(rows, "area string, mag double")
    means = {r.area: r.avg_value for r in agg.avg_by_region(df, exact_scale=2).collect()}
    assert math.isnan(means.pop("nan"))
    assert means == {"a": 0.375, "huge": 5e299, "inf": math.inf, "none": None, "part": 0.1}


def test_exact_means_of_any_exponent(spark):
    """The correctly rounded mean, the same however the rows are dealt."""
    import math
    import random
    from fractions import Fraction

    rnd = random.Random(3)
    groups = {
        "mixed": [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300) for _ in range(500)],
        "cancel": [1e300, 1.0, -1e300, 1e-300],
        "small": [5e-324, 5e-324, 0.0, -0.0, 2.2250738585072014e-308],
        "powers": [2.0**k for k in range(-60, 61)] + [math.nextafter(2.0**k, 0) for k in range(-60, 61)],
        "decimal": [0.1] * 7 + [None],
        "huge": [1.7976931348623157e308, 1.7976931348623157e308],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {}
    for g, values in groups.items():
        own = [v for v in values if v is not None]
        want[g] = float(sum(map(Fraction, own)) / len(own))
    for parts in (1, 7):
        found = dict(map(tuple, agg.exact_means(df.repartition(parts), ["g"], "v").collect()))
        assert {g: found[g] for g in groups} == want
        assert math.isnan(found["nan"]) and found["inf"] == math.inf and found["none"] is None


def test_far_and_impossible_times_convert_or_are_null(spark):
    from seismark.functions.times import epoch_ms_to_timestamp

    ms = [253_402_300_800_000, -62_198_755_200_000, 2**63 // 1000 + 5, -(2**63), None]
    df = spark.createDataFrame([(m,) for m in ms], "ms bigint")
    years = [r[0] for r in df.select(F.year(epoch_ms_to_timestamp(F.col("ms")))).collect()]
    assert years == [10000, -1, None, None, None]
