"""The analysis questions on ``events`` and ``orders``.

``events`` stands for the curated table: event_type is the region, value the magnitude. ``orders``
spans several years, and the text after ``-`` in its priority stands for the state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from seismark.operators import aggregates as agg
from seismark.operators import sorting
from seismark.operators.filters import (
    contains_literal,
    last_days_calendar,
    last_days_clustered,
    last_days_rolling,
    not_null,
    peak_rows,
)
from seismark.operators.project import select_columns
from seismark.plans import questions as ask
from seismark.plans.questions import EventColumns, latest
from seismark.session import work_folder
from seismark.sinks.files import write_clustered
from seismark.sources.tables import read_parquet, read_query
from seismark.workload.registry import query, table

EVENTS = EventColumns("event_type", "value", "ts")
ORDERS = EventColumns("o_orderpriority", "o_totalprice", "o_orderdate")
CENTS = 2

STATE = "regexp_replace(o_orderpriority, '^[^-]*-', '')"
MONTH_DAY = "strftime(o_orderdate, '%m-%d')"
LAST_WEEK = "ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"


def mean_sql(value: str) -> str:
    return f"sum(CAST({value} AS DECIMAL(18,2)))::DOUBLE / count({value})"


# --- counts -----------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n, event_type")
def count_by_region(spark, sf):
    return ask.events_by_region(table(spark, sf, "events"), EVENTS)


@query(f"SELECT {STATE} AS state, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, state")
def count_by_state(spark, sf):
    return ask.events_by_state(table(spark, sf, "orders"), ORDERS, "-")


@query(f"SELECT {MONTH_DAY} AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, day")
def count_by_month_day(spark, sf):
    return ask.events_by_month_day(table(spark, sf, "orders"), ORDERS)


@query("SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1")
def count_by_date(spark, sf):
    return ask.events_by_date(table(spark, sf, "orders"), ORDERS)


@query(
    f"SELECT o_orderpriority, {MONTH_DAY} AS day, count(*) AS n FROM orders GROUP BY 1, 2 "
    "ORDER BY n DESC, o_orderpriority, day"
)
def count_by_region_month_day(spark, sf):
    return ask.events_by_region_month_day(table(spark, sf, "orders"), ORDERS)


@query(
    f"SELECT {STATE} AS state, {MONTH_DAY} AS day, count(*) AS n FROM orders GROUP BY 1, 2 "
    "ORDER BY n DESC, state, day"
)
def count_by_state_month_day(spark, sf):
    return ask.events_by_state_month_day(table(spark, sf, "orders"), ORDERS, "-")


@query("SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def count_by_date_region(spark, sf):
    return ask.events_by_date_region(table(spark, sf, "events"), EVENTS)


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return agg.row_count(table(spark, sf, "lineitem"))


# --- means ------------------------------------------------------------------------------------


@query(
    f"SELECT event_type, {mean_sql('value')} AS avg_value FROM events GROUP BY event_type "
    "ORDER BY avg_value, event_type"
)
def avg_value_by_region(spark, sf):
    return ask.average_by_region(table(spark, sf, "events"), EVENTS, CENTS)


@query(
    f"SELECT {STATE} AS state, {mean_sql('o_totalprice')} AS avg_value FROM orders GROUP BY 1 "
    "ORDER BY avg_value DESC, state"
)
def avg_by_state(spark, sf):
    return ask.average_by_state(table(spark, sf, "orders"), ORDERS, "-", CENTS)


@query(
    f"SELECT {MONTH_DAY} AS day, {mean_sql('o_totalprice')} AS avg_value FROM orders GROUP BY 1 "
    "ORDER BY day DESC"
)
def avg_by_month_day(spark, sf):
    return ask.average_by_month_day(table(spark, sf, "orders"), ORDERS, CENTS)


@query(
    "SELECT avg(n) AS avg_events FROM "
    "(SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1)"
)
def avg_events_per_day(spark, sf):
    return ask.average_events_per_day(table(spark, sf, "events"), EVENTS)


@query(
    f"SELECT o_orderpriority, {MONTH_DAY} AS day, {mean_sql('o_totalprice')} AS avg_value "
    "FROM orders GROUP BY 1, 2 ORDER BY day DESC, o_orderpriority"
)
def avg_by_region_month_day(spark, sf):
    return ask.average_by_region_month_day(table(spark, sf, "orders"), ORDERS, CENTS)


@query(
    f"SELECT {STATE} AS state, {MONTH_DAY} AS day, {mean_sql('o_totalprice')} AS avg_value "
    "FROM orders GROUP BY 1, 2 ORDER BY day DESC, state"
)
def avg_by_state_month_day(spark, sf):
    return ask.average_by_state_month_day(table(spark, sf, "orders"), ORDERS, "-", CENTS)


# --- peaks ------------------------------------------------------------------------------------


@query("SELECT max(value) AS max_value FROM events")
def max_global(spark, sf):
    return agg.max_global(table(spark, sf, "events"), "value")


@query("SELECT event_type, max(value) AS max_value FROM events GROUP BY event_type")
def max_by_region(spark, sf):
    return agg.max_by_region(table(spark, sf, "events"), "event_type", "value")


@query("SELECT event_type, ts FROM events WHERE value = (SELECT max(value) FROM events)")
def global_peak_rows(spark, sf):
    return ask.strongest_ever(table(spark, sf, "events"), EVENTS)


PEAK_LAST_WEEK = (
    f"SELECT event_type, ts, value FROM events WHERE {LAST_WEEK} "
    f"AND value = (SELECT max(value) FROM events WHERE {LAST_WEEK})"
)


@query(PEAK_LAST_WEEK)
def peak_last_7d_subquery(spark, sf):
    events = table(spark, sf, "events")
    return ask.strongest_last_days(events, EVENTS, as_of=latest(events, "ts"))


@query(PEAK_LAST_WEEK)
def peak_last_7d_cte(spark, sf):
    events = table(spark, sf, "events")
    return ask.strongest_last_days_sql(
        events, EVENTS, since_sql="(SELECT max(ts) - INTERVAL '7' DAY FROM {events})"
    )


@query(
    "SELECT max(value) AS max_value FROM events "
    "WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 7"
)
def max_last_7_calendar_days(spark, sf):
    events = table(spark, sf, "events")
    return ask.highest_value_last_dates(events, EVENTS, as_of=latest(events, "ts"))


@query(
    f"SELECT event_type, max(value) AS max_intensity FROM events WHERE {LAST_WEEK} "
    "GROUP BY event_type ORDER BY max_intensity DESC, event_type LIMIT 1"
)
def argmax_intensity_last_7d(spark, sf):
    events = table(spark, sf, "events")
    return ask.strongest_region_last_days(events, EVENTS, as_of=latest(events, "ts"))


@query(
    "SELECT event_type, count(*) AS frequency, max(value) AS max_intensity FROM events "
    "GROUP BY event_type ORDER BY frequency DESC, max_intensity DESC, event_type"
)
def frequency_and_max(spark, sf):
    return ask.frequency_and_peak(table(spark, sf, "events"), EVENTS)


@query(
    f"SELECT event_type, count(*) AS frequency, {mean_sql('value')} AS avg_intensity "
    "FROM events GROUP BY event_type ORDER BY frequency DESC, avg_intensity DESC, event_type"
)
def frequency_and_avg(spark, sf):
    return ask.frequency_and_average(table(spark, sf, "events"), EVENTS, CENTS)


@query(
    "SELECT event_type, count(*) AS frequency FROM events GROUP BY event_type "
    "ORDER BY frequency DESC, event_type LIMIT 1"
)
def argmax_frequency(spark, sf):
    return ask.most_frequent_region(table(spark, sf, "events"), EVENTS)


@query(
    "SELECT event_type, max(value) AS max_intensity FROM events GROUP BY event_type "
    "ORDER BY max_intensity DESC, event_type LIMIT 1"
)
def argmax_intensity(spark, sf):
    return ask.most_intense_region(table(spark, sf, "events"), EVENTS)


# --- filters ----------------------------------------------------------------------------------


@query(f"SELECT * FROM events WHERE {LAST_WEEK}")
def rows_last_7d_rolling(spark, sf):
    events = table(spark, sf, "events")
    return last_days_rolling(events, "ts", 7, latest(events, "ts"))


@query(
    "SELECT * FROM events "
    "WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 7"
)
def rows_last_7_calendar_days(spark, sf):
    events = table(spark, sf, "events")
    return last_days_calendar(events, "ts", 7, latest(events, "ts"))


@query("SELECT event_type, value FROM events WHERE value > 5")
def rows_above_threshold(spark, sf):
    return ask.events_above(table(spark, sf, "events"), EVENTS)


@query("SELECT DISTINCT event_type FROM events WHERE value > 5")
def regions_above_threshold(spark, sf):
    return ask.regions_above(table(spark, sf, "events"), EVENTS)


@query("SELECT doc_id, lang FROM documents WHERE contains(text, ' of ') AND lang IS NOT NULL")
def texts_with_region(spark, sf):
    documents = not_null(table(spark, sf, "documents"), "lang")
    return select_columns(contains_literal(documents, "text", " of "), ["doc_id", "lang"])


# --- scans and orders -------------------------------------------------------------------------


@query("SELECT event_type AS area, ts AS time, value AS mag FROM events")
def read_query_three_columns(spark, sf):
    return read_query(
        spark,
        "SELECT event_type AS area, ts AS time, value AS mag FROM {events}",
        events=table(spark, sf, "events"),
    )


@query("SELECT * FROM customer ORDER BY c_name, c_custkey")
def sort_by_string_key(spark, sf):
    return sorting.sort_by(table(spark, sf, "customer"), "c_name", ties=("c_custkey",))


@query("SELECT * FROM events ORDER BY value, event_id LIMIT 100")
def top_k_by_key(spark, sf):
    return sorting.top_k_by_key(table(spark, sf, "events"), "value", "event_id", k=100)


# --- means and groupings ----------------------------------------------------------------------

_QUARTERS = "floor(value * 4) / 4 * CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1048576 ELSE 0.0009765625 END"


def _quarters(spark, sf):
    """Values whose sums are exact in doubles, of very different size by region."""
    factor = F.when(F.col("event_type") == "view", 1.0).when(F.col("event_type") == "click", 1048576.0).otherwise(0.0009765625)
    return table(spark, sf, "events").withColumn("value", F.floor(F.col("value") * 4) / 4 * factor)


@query(f"SELECT event_type, avg({_QUARTERS})::DOUBLE AS avg_value FROM events GROUP BY event_type")
def avg_plain_by_region(spark, sf):
    return agg.avg_by_region(_quarters(spark, sf), "event_type", "value")


@query(f"SELECT event_type, avg({_QUARTERS})::DOUBLE AS avg_value FROM events GROUP BY event_type")
def avg_exact_by_region(spark, sf):
    return agg.exact_means(_quarters(spark, sf), ["event_type"], "value")


@query(
    "WITH e AS (SELECT event_type AS region, CAST(ts AS DATE) AS date, (month(ts) * 100 + day(ts))::INTEGER AS month_day, "
    "floor(value * 4) / 4 AS value FROM events) "
    "SELECT region, date, month_day, grouping(region, date, month_day)::BIGINT AS grouping, count(*) AS n, "
    "avg(value) AS avg_value, max(value) AS max_value FROM e "
    "GROUP BY GROUPING SETS ((), (region), (date), (month_day), (date, region), (region, month_day))"
)
def all_questions_one_scan(spark, sf):
    events = table(spark, sf, "events").withColumn("value", F.floor(F.col("value") * 4) / 4)
    return agg.question_sets(events, "event_type", "value", "ts")


@query(
    f"SELECT * FROM events WHERE {LAST_WEEK} AND value = (SELECT max(value) FROM events WHERE {LAST_WEEK})"
)
def peak_last_7d_clustered(spark, sf):
    """Question 7 on a layer with a folder per day: earlier days are not opened."""
    path = work_folder(spark, "clustered")
    write_clustered(table(spark, sf, "events"), path, "ts")
    events = read_parquet(spark, path)
    recent = last_days_clustered(events, "ts", "event_date", 7, latest(events, "ts"))
    return peak_rows(recent, "value").drop("event_date")
