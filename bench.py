"""Time the registered queries; prints one JSON line.

Each query runs once to warm up, then ``BENCH_RUNS`` times; the median counts. The result is
consumed by a no-op sink, so every row and column is computed and nothing is collected. Queries
that write are timed whole: their writes happen while the query is built.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seismark.session import build_session
from seismark.workload import QUERIES

HEADLINE = [
    "count_by_region", "count_by_state", "count_by_month_day", "count_by_date",
    "count_by_region_month_day", "count_by_state_month_day", "count_by_date_region",
    "avg_value_by_region", "avg_by_state", "avg_by_month_day", "avg_by_region_month_day",
    "avg_by_state_month_day", "avg_events_per_day", "max_by_region", "global_peak_rows",
    "peak_last_7d_subquery", "peak_last_7d_cte", "max_last_7_calendar_days",
    "rows_last_7d_rolling", "rows_above_threshold", "regions_above_threshold",
    "frequency_and_max", "frequency_and_avg", "argmax_frequency", "argmax_intensity",
    "top_k_by_key", "sort_by_string_key", "row_count",
    "area_regex_texts", "area_split_texts", "suffix_after_comma", "day_keys",
    "epoch_ms_to_string_events", "epoch_ms_to_timestamp_events",
    "geojson_lines_curated", "geojson_flatten_default", "geojson_split_curated",
    "geojson_flatten_preserve",
    "row_count_match", "cell_mismatches", "head_sample_match",
    "parquet_roundtrip", "ndjson_roundtrip", "overwrite_table",
]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "seismark-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        def run(query=QUERIES[name]):
            return query(spark, sf_dir)

        timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
