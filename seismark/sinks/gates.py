"""Conditions a load must meet before it becomes visible."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismark.schema import CORRUPT, REQUIRED_COLUMNS


class EmptyInput(ValueError):
    """An overwrite was asked for with no rows to put in place."""


class MissingRequiredValues(ValueError):
    """A required column holds nulls."""


class BadRecordBudgetExceeded(ValueError):
    """More unreadable records than the load accepts."""


class LossesExceeded(ValueError):
    """More documents did not parse, or features did not convert, than the load accepts."""


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise EmptyInput("refusing to overwrite with an empty input")


def required_null_report(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row: the number of nulls in each required column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_values(df: DataFrame, columns: Sequence[str]) -> None:
    nulls = required_null_report(df, columns).first().asDict()
    broken = {name: n for name, n in nulls.items() if n}
    if broken:
        raise MissingRequiredValues(f"nulls in required columns: {broken}")


def _incomplete(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def split_required(
    df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """(complete, rejected) by the required columns."""
    incomplete = _incomplete(columns)
    return df.filter(~incomplete), df.filter(incomplete)


def split_bad_records(df: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows, texts that did not parse) of a permissive read."""
    bad = F.col(corrupt).isNotNull()
    return df.filter(~bad).drop(corrupt), df.filter(bad).select(F.col(corrupt).alias("record"))
