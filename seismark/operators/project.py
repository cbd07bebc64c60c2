"""Features to flat event rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.functions.times import valid_epoch_ms
from seismark.schema import COORDINATES, EVENT_FIELDS, FLAT_TYPES, PROPERTY_FIELDS, Field

FAILED = "_failed"


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


# Microseconds are kept: the default JSON formats cut times to milliseconds.
JSON_TIMES = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def to_json_rows(df: DataFrame, name: str = "value") -> DataFrame:
    """Every row as one JSON string; null fields are left out."""
    return df.select(F.to_json(F.struct("*"), JSON_TIMES).alias(name))


def extract_properties(
    features: DataFrame, feature: str = "feature", missing: str = "null", keep: Sequence[str] = ()
) -> DataFrame:
    """Lift the properties and the three coordinates to columns, beside the columns to ``keep``.

    ``missing="null"`` gives null for an absent geometry or coordinate; ``missing="fail"`` ends
    the job on one.
    """
    if missing not in ("null", "fail"):
        raise ValueError(f"unknown missing policy: {missing}")
    coordinates = F.col(f"{feature}.geometry.coordinates")

    def coordinate(name: str) -> Column:
        value = F.get(coordinates, F.lit(COORDINATES[name]))
        if missing == "fail":
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"feature without {name}"))
            )
        return value.alias(name)

    return features.select(
        *[F.col(f"{feature}.properties.{f.name}").alias(f.name) for f in PROPERTY_FIELDS],
        *[coordinate(name) for name in COORDINATES],
        *keep,
    )


def _typed_default(field: Field) -> Column:
    return F.lit(field.default).cast(FLAT_TYPES[field.kind])


def _valid(typed: Column, kind: str) -> Column:
    return valid_epoch_ms(typed) if kind == "epoch_ms" else typed


def _from_text(value: Column, kind: str) -> Column:
    """A leaf read as text in its declared type, null if it does not convert. A number may be
    written as text, a count or a time with decimals, and a flag counts as one or zero."""
    if kind == "string":
        return value
    number = value.try_cast("double")
    if kind == "float":
        return F.coalesce(number, _flag(value).cast("double"))
    if kind == "int":
        return F.coalesce(number.try_cast("int"), _flag(value))
    return _valid(F.coalesce(value.try_cast("long"), number.try_cast("long")), kind)


# Fixed value: a number, also as text; the number syntax of the JVM takes more, as ``4.5d`` or ``0x1p3``.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _text_does_not_convert(kind: str) -> Callable[[Column], Column]:
    return lambda value: value.isNotNull() & (
        _from_text(value, kind).isNull() | ~(value.rlike(NUMBER) | value.isin("true", "false"))
    )


def _flag(value: Column) -> Column:
    return F.when(value == "true", 1).when(value == "false", 0)


def _converted(field: Field, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return _from_text(F.col(field.name), field.kind)
    return _valid(F.col(field.name).try_cast(FLAT_TYPES[field.kind]), field.kind)


def flatten_coerce_default(
    properties: DataFrame, epoch_as_text: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Cast every field to its declared type; missing or null becomes the declared default.

    Run ``split_convertible`` first when the values may not convert: here such a value takes the
    default too.
    """

    sources = {f.name: properties.schema[f.name].dataType for f in EVENT_FIELDS}

    def flat(field: Field) -> Column:
        value = F.coalesce(_converted(field, sources[field.name]), _typed_default(field))
        as_text = epoch_as_text and field.kind == "epoch_ms"
        return (value.cast("string") if as_text else value).alias(field.name)

    return properties.select(*[flat(f) for f in EVENT_FIELDS], *keep)


def split_convertible(properties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convertible, failed): a row fails when a present value does not fit its declared type."""
    failed = not_convertible(properties)
    return properties.filter(~failed), properties.filter(failed)


def not_convertible(properties: DataFrame) -> Column:
    """Whether some present value of the row does not fit its declared type."""
    sources = {f.name: properties.schema[f.name].dataType for f in EVENT_FIELDS}
    lost, texts = [], {}
    for f in EVENT_FIELDS:
        if f.kind == "string":
            continue
        if isinstance(sources[f.name], T.StringType):
            texts.setdefault(f.kind, []).append(F.col(f.name))
        elif f.kind == "epoch_ms" or sources[f.name] != FLAT_TYPES[f.kind]:
            lost.append(F.col(f.name).isNotNull() & _converted(f, sources[f.name]).isNull())
    # one test per kind over an array: written out per field the method would be too long to compile
    for kind, leaves in texts.items():
        lost.append(F.exists(F.array(*leaves), _text_does_not_convert(kind)))
    return reduce(lambda a, b: a | b, lost)


def flatten_missing_only(
    features: DataFrame, feature: str = "feature", keep: Sequence[str] = ()
) -> DataFrame:
    """Default only where the key is absent; an explicit null stays null.

    ``feature`` is read as ``VARIANT_FEATURE``, which tells the two apart. The flag column
    ``_failed`` marks rows the null-preserving flatten leaves out: no properties or no time key, an
    explicit null geometry or coordinate list, fewer than three coordinates, a present value that
    does not convert.
    """
    geometry = F.col(f"{feature}.geometry")
    coordinates = F.try_variant_get(geometry, "$.coordinates", "variant")
    columns = []
    failures = [_explicit_null(geometry), _explicit_null(coordinates)]
    leaves: dict[str, list[Column]] = {}
    for f in EVENT_FIELDS:
        if f.name in COORDINATES:
            leaf = F.try_variant_get(geometry, f"$.coordinates[{COORDINATES[f.name]}]", "variant")
            absent = coordinates.isNull()
            failures.append(~absent & leaf.isNull())
        else:
            leaf = F.col(f"{feature}.properties.{f.name}")
            absent = leaf.isNull()
            if f.kind == "epoch_ms":
                failures.append(absent)
        leaves.setdefault(f.kind, []).append(leaf)
        default = F.when(absent, _typed_default(f))
        columns.append(F.coalesce(_leaf_value(leaf, f.kind), default).alias(f.name))
    # One test per kind over an array, not one per field: written out, the generated method would
    # be too long for the JVM to compile.
    for kind in ("float", "int", "epoch_ms"):
        failures.append(F.exists(F.array(*leaves[kind]), _loses_its_value(kind)))
    failed = F.coalesce(reduce(lambda a, b: a | b, failures), F.lit(False))
    return features.select(*columns, failed.alias(FAILED), *keep)


def _leaf_value(leaf: Column, kind: str) -> Column:
    return _valid(F.try_variant_get(leaf, "$", FLAT_TYPES[kind].simpleString()), kind)


def _loses_its_value(kind: str) -> Callable[[Column], Column]:
    return lambda leaf: (
        leaf.isNotNull() & ~F.is_variant_null(leaf) & _leaf_value(leaf, kind).isNull()
    )


def _explicit_null(leaf: Column) -> Column:
    return F.coalesce(F.is_variant_null(leaf), F.lit(False))


def split_failed(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) by the ``_failed`` flag."""
    return (
        flagged.filter(~F.col(FAILED)).drop(FAILED),
        flagged.filter(F.col(FAILED)).drop(FAILED),
    )
