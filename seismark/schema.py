"""Declared schemas of the raw, curated and audit layers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    name: str
    kind: str  # float | int | string | epoch_ms
    default: object


# Name, kind and default of every flattened event field.
EVENT_FIELDS = [
    Field("mag", "float", 0.0),
    Field("place", "string", ""),
    Field("time", "epoch_ms", "0"),
    Field("updated", "epoch_ms", "0"),
    Field("tz", "string", ""),
    Field("url", "string", ""),
    Field("detail", "string", ""),
    Field("felt", "int", 0),
    Field("cdi", "float", 0.0),
    Field("mmi", "float", 0.0),
    Field("alert", "string", ""),
    Field("status", "string", ""),
    Field("tsunami", "int", 0),
    Field("sig", "int", 0),
    Field("net", "string", ""),
    Field("code", "string", ""),
    Field("ids", "string", ""),
    Field("sources", "string", ""),
    Field("types", "string", ""),
    Field("nst", "int", 0),
    Field("dmin", "float", 0.0),
    Field("rms", "float", 0.0),
    Field("gap", "float", 0.0),
    Field("magType", "string", ""),
    Field("type", "string", ""),
    Field("title", "string", ""),
    Field("longitude", "float", 0.0),
    Field("latitude", "float", 0.0),
    Field("depth", "float", 0.0),
]

# Position of each coordinate inside geometry.coordinates.
COORDINATES = {"longitude": 0, "latitude": 1, "depth": 2}

PROPERTY_FIELDS = [f for f in EVENT_FIELDS if f.name not in COORDINATES]

FLAT_TYPES = {
    "float": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "epoch_ms": T.LongType(),
}

CORRUPT = "_corrupt_record"
#: Columns of a reader that knows the file of each row, and whether its document ends too early.
SOURCE, UNFINISHED = "source_file", "unfinished"

# Leaves are read as text, whatever their JSON type: the conversion decides what fits a column, and
# a document is broken only if it does not parse.
RAW_FEATURE = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType([T.StructField(f.name, T.StringType()) for f in PROPERTY_FIELDS]),
        ),
        T.StructField(
            "geometry",
            T.StructType([T.StructField("coordinates", T.ArrayType(T.StringType()))]),
        ),
    ]
)

# The same feature with VARIANT leaves: an absent key is SQL null, an explicit null is not.
VARIANT_FEATURE = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType([T.StructField(f.name, T.VariantType()) for f in PROPERTY_FIELDS]),
        ),
        T.StructField("geometry", T.VariantType()),
    ]
)


def document_schema(feature: T.StructType) -> T.StructType:
    """A landed document, and the text of one that did not parse."""
    return T.StructType(
        [
            T.StructField("features", T.ArrayType(feature)),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


RAW_DOCUMENT = document_schema(RAW_FEATURE)
VARIANT_DOCUMENT = document_schema(VARIANT_FEATURE)

FLAT_SCHEMA = T.StructType([T.StructField(f.name, FLAT_TYPES[f.kind]) for f in EVENT_FIELDS])

CURATED_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.kind == "epoch_ms" else FLAT_TYPES[f.kind])
        for f in EVENT_FIELDS
    ]
    + [
        T.StructField("area", T.StringType()),
        T.StructField("ingestion_dt", T.TimestampType()),
    ]
)

CURATED_COLUMNS = CURATED_SCHEMA.fieldNames()

# Columns a load must not leave null.
REQUIRED_COLUMNS = [
    "mag", "place", "time", "updated", "longitude", "latitude", "depth", "area", "ingestion_dt",
]
REQUIRED_COLUMNS_SCHEDULED = ["mag", "place", "time", "updated"]

# Text columns compared by the table checks, and their key.
COMPARE_KEY = "ids"
HEAD_COMPARE_COLUMNS = [
    "place", "tz", "url", "detail", "alert", "status", "ids", "sources", "types",
    "magType", "type", "title", "area",
]
CELL_COMPARE_COLUMNS = [
    "place", "tz", "url", "detail", "alert", "status", "code", "ids", "sources", "types",
    "magType", "type", "title", "area",
]

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("step_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("execution_timestamp", T.TimestampType()),
        T.StructField("additional_info", T.StringType()),
    ]
)
