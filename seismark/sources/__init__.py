from seismark.sources.documents import (
    explode_features,
    read_landing_geojson,
    read_landing_text,
    split_documents,
)
from seismark.sources.split import read_landing_split
from seismark.sources.tables import (
    read_json_strings_inferred,
    read_parquet,
    read_parquet_glob,
    read_query,
    read_table,
    rows_with_schema,
    single_seed_element,
)

__all__ = [
    "explode_features", "read_landing_geojson", "read_landing_split", "read_landing_text",
    "split_documents", "read_json_strings_inferred", "read_parquet", "read_parquet_glob",
    "read_query", "read_table", "rows_with_schema", "single_seed_element",
]
