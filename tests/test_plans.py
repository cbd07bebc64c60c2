"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from seismark.operators import aggregates as agg
from seismark.operators import quality
from seismark.operators.filters import (
    last_days_calendar,
    last_days_clustered,
    last_days_rolling,
    peak_rows,
)
from seismark.operators.sorting import top_k_by_key
from seismark.plans.curate import curate
from seismark.plans.questions import latest
from seismark.schema import RAW_DOCUMENT, VARIANT_DOCUMENT
from seismark.sinks.files import rebalanced, write_clustered
from seismark.sources.documents import read_landing_text
from seismark.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def test_grouping_is_reduced_before_its_one_shuffle(events):
    text = plan(agg.frequency_and_max(events, "event_type", "value"))
    assert text.count("Exchange") == 1 and "partial_max" in text
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_day_keys_are_grouped_as_numbers(events):
    text = plan(agg.count_by_month_day(events, "ts"))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "format_string" not in below and "date_format" not in below


def test_peak_filter_reaches_the_scan(events):
    recent = last_days_rolling(events, "ts", 7, latest(events, "ts"))
    text = plan(peak_rows(recent, "value"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(value,ScalarSubquery", text)
    assert "Join" not in text


@pytest.mark.parametrize("name", ["peak_last_7d_subquery", "peak_last_7d_cte"])
def test_stored_week_start_reaches_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,ScalarSubquery", text)


def test_time_filters_reach_the_scan(events):
    day = dt.date(2024, 1, 20)
    assert "GreaterThanOrEqual(ts" in plan(last_days_calendar(events, "ts", 7, day))
    at = dt.datetime(2024, 1, 20)
    assert "GreaterThanOrEqual(ts" in plan(last_days_rolling(events, "ts", 7, at))


def test_top_k_does_not_sort_everything(events):
    text = plan(top_k_by_key(events, "value", "event_id"))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_table_comparison_has_no_join(events):
    for df in (
        quality.cell_match(events, events, "user_id", ["event_type", "value"]),
        quality.row_count_match(events, events),
    ):
        assert "Join" not in plan(df) and "Cartesian" not in plan(df)


def test_curation_is_one_pass_without_a_shuffle(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"features": []}')
    text = plan(curate(read_landing_text(spark, str(tmp_path))))
    assert "Exchange" not in text
    assert text.count("from_json(") == 1


@pytest.mark.parametrize("schema", [RAW_DOCUMENT, VARIANT_DOCUMENT])
def test_generated_methods_stay_short_enough_to_compile(spark, tmp_path, capsys, schema):
    """The JVM does not compile methods above 8000 bytes."""
    (tmp_path / "d.json").write_text('{"features": []}')
    curate(read_landing_text(spark, str(tmp_path), schema)).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_a_hot_key_collapses_before_the_shuffle(spark):
    """A third of all rows under one repeated key: each task sends one row of it on."""
    rows = spark.range(0, 300_000, 1, 16)
    skewed = rows.select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    changed = skewed.withColumn("v", F.when(F.col("k") == 0, -F.col("v")).otherwise(F.col("v")))
    found = quality.cell_match(skewed, changed, "k", ["v"]).collect()
    assert [(r.k, r.issue, r.n_expected, r.n_actual) for r in found] == [
        (0, "ambiguous", 99_999, 99_999)
    ]


def test_no_query_uses_a_python_worker(spark):
    for name in ("frequency_and_avg", "cell_mismatches", "area_split_texts", "day_keys"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "InPandas" not in text


def test_all_questions_take_one_scan_and_one_shuffle(events):
    text = plan(agg.question_sets(events, "event_type", "value", "ts"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Expand" in text


def test_clustered_layer_opens_only_the_last_days(spark, events, tmp_path):
    path = str(tmp_path / "clustered")
    write_clustered(events, path, "ts", files=6)
    layer = spark.read.parquet(path)
    recent = last_days_clustered(layer, "ts", "event_date", 3, latest(layer, "ts"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= Subquery", plan(recent).replace("\n", " ")) or re.search(
        r"PartitionFilters: \[[^\]]*event_date[^\]]*ScalarSubquery", plan(recent)
    )
    days = {f.split("event_date=")[1].split("/")[0] for f in layer.inputFiles()}
    assert len(days) == 30 and len(layer.inputFiles()) <= 30 + 6
    last = events.agg({"ts": "max"}).first()[0]
    assert recent.count() == events.filter(F.col("ts") >= last - dt.timedelta(days=3)).count() > 0


def test_small_appends_make_few_files(spark, events, tmp_path):
    many = events.repartition(8)
    for i in range(50):
        rebalanced(many.filter(F.col("event_id") % 50 == i)).write.mode("append").parquet(str(tmp_path / "few"))
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 50
    assert spark.read.parquet(str(tmp_path / "few")).count() == events.count()
