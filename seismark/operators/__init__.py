from seismark.operators.aggregates import (
    argmax_frequency,
    argmax_intensity,
    avg_by_month_day,
    avg_by_region,
    avg_by_region_month_day,
    avg_by_state,
    avg_by_state_month_day,
    avg_events_per_day,
    count_by_date,
    count_by_date_region,
    count_by_month_day,
    count_by_region,
    count_by_region_month_day,
    count_by_state,
    count_by_state_month_day,
    distinct_regions,
    frequency_and_avg,
    frequency_and_max,
    max_by_region,
    max_global,
    row_count,
)
from seismark.operators.filters import (
    contains_literal,
    last_days_calendar,
    last_days_rolling,
    not_null,
    peak_rows,
    value_gt,
)
from seismark.operators.project import (
    extract_properties,
    flatten_coerce_default,
    flatten_missing_only,
    select_columns,
    split_convertible,
    split_failed,
    to_json_rows,
)
from seismark.operators.quality import (
    cell_match,
    column_set_match,
    dtype_match,
    head_sample_match,
    row_count_match,
    row_differences,
)
from seismark.operators.sorting import sort_by, top_k_by_key

__all__ = [
    "argmax_frequency", "argmax_intensity", "avg_by_month_day", "avg_by_region",
    "avg_by_region_month_day", "avg_by_state", "avg_by_state_month_day", "avg_events_per_day",
    "count_by_date", "count_by_date_region", "count_by_month_day", "count_by_region",
    "count_by_region_month_day", "count_by_state", "count_by_state_month_day",
    "distinct_regions", "frequency_and_avg", "frequency_and_max", "max_by_region", "max_global",
    "row_count",
    "contains_literal", "last_days_calendar", "last_days_rolling", "not_null", "peak_rows",
    "value_gt",
    "extract_properties", "flatten_coerce_default", "flatten_missing_only", "select_columns",
    "split_convertible", "split_failed", "to_json_rows",
    "cell_match", "column_set_match", "dtype_match", "head_sample_match", "row_count_match",
    "row_differences",
    "sort_by", "top_k_by_key",
]
