from seismark.sinks.audit import AuditLog
from seismark.sinks.files import (
    write_json_rows,
    write_landing_json,
    write_ndjson,
    write_parquet_overwrite,
    write_parquet_typed,
)
from seismark.sinks.gates import (
    BadRecordBudgetExceeded,
    EmptyInput,
    MissingRequiredValues,
    required_null_report,
    split_bad_records,
    split_required,
)
from seismark.sinks.tables import (
    LoadResult,
    ensure_namespace,
    load_ndjson,
    load_table,
    preview,
    with_row_count,
)

__all__ = [
    "AuditLog",
    "write_json_rows", "write_landing_json", "write_ndjson", "write_parquet_overwrite",
    "write_parquet_typed",
    "BadRecordBudgetExceeded", "EmptyInput", "MissingRequiredValues", "required_null_report",
    "split_bad_records", "split_required",
    "LoadResult", "ensure_namespace", "load_ndjson", "load_table", "preview", "with_row_count",
]
