"""Compare two tables. The answer is a DataFrame; nothing is collected on the way.

Rows are compared as multisets: both sides are tagged, united and grouped by their full content.
Equal rows cancel inside that grouping, so there is no join and a key that is repeated many times
never meets itself pairwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.operators.sorting import top_k_by_key, with_position

_E, _A = "expected_copies", "actual_copies"


def row_count_match(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: both row counts and whether they agree."""
    both = expected.select(F.lit(1).alias(_E), F.lit(0).alias(_A)).unionAll(
        actual.select(F.lit(0).alias(_E), F.lit(1).alias(_A))
    )
    counts = both.agg(
        F.coalesce(F.sum(_E), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum(_A), F.lit(0)).alias("actual_rows"),
    )
    return counts.withColumn("matches", F.col("expected_rows") == F.col("actual_rows"))


def column_set_match(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Names found on one side only: ``missing`` in the actual table, or ``extra`` in it."""
    names_e, names_a = set(expected.columns), set(actual.columns)
    rows = [(n, "missing") for n in sorted(names_e - names_a)]
    rows += [(n, "extra") for n in sorted(names_a - names_e)]
    return expected.sparkSession.createDataFrame(rows, "name string, side string")


def dtype_match(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Names whose type differs from the declared one; null stands for an absent column."""
    declared = {f.name: f.dataType.simpleString() for f in schema}
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [
        (name, declared.get(name), found.get(name))
        for name in sorted(declared.keys() | found.keys())
        if declared.get(name) != found.get(name)
    ]
    return df.sparkSession.createDataFrame(rows, "name string, expected string, actual string")


def row_differences(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that occur a different number of times on the two sides, with both counts."""
    both = expected.select(*columns, F.lit(1).alias(_E), F.lit(0).alias(_A)).unionAll(
        actual.select(*columns, F.lit(0).alias(_E), F.lit(1).alias(_A))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum(_E).alias(_E), F.sum(_A).alias(_A))
        .filter(F.col(_E) != F.col(_A))
    )


def head_sample_match(
    expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str], n: int = 100
) -> DataFrame:
    """Differences between the first ``n`` rows by key; equal keys are ordered by the columns."""
    order = [key, *[c for c in columns if c != key]]
    return row_differences(
        top_k_by_key(expected.select(*order), *order, k=n),
        top_k_by_key(actual.select(*order), *order, k=n),
        order,
    )


def cell_match(
    expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Cell differences after cancelling the rows that are equal on both sides.

    One row per difference, told apart by ``issue``:

    * ``cell``: the key has one differing row on each side; names the column and both values.
    * ``missing`` / ``surplus``: differing rows on the expected / actual side only.
    * ``ambiguous``: several differing rows share the key, so no pairing is given;
      ``row_differences`` lists those rows whole.

    ``n_expected`` and ``n_actual`` count the differing rows of the key.
    """
    cells = [c for c in columns if c != key]
    rest = row_differences(expected, actual, [key, *cells])
    extra_e = F.greatest(F.col(_E) - F.col(_A), F.lit(0))
    extra_a = F.greatest(F.col(_A) - F.col(_E), F.lit(0))
    content = F.struct(*cells)
    # A repeated key collapses inside each task; the kept rows are used only for single ones.
    per_key = rest.groupBy(key).agg(
        F.sum(extra_e).alias("n_expected"),
        F.sum(extra_a).alias("n_actual"),
        F.first(F.when(extra_e > 0, content), ignorenulls=True).alias("_e"),
        F.first(F.when(extra_a > 0, content), ignorenulls=True).alias("_a"),
    )
    issue = (
        F.when(F.col("n_actual") == 0, "missing")
        .when(F.col("n_expected") == 0, "surplus")
        .when((F.col("n_expected") == 1) & (F.col("n_actual") == 1), "cell")
        .otherwise("ambiguous")
    )
    differing = F.array_compact(F.array(*[_cell(c) for c in cells]))
    whole_row = F.array(
        F.struct(*[F.lit(None).cast("string").alias(n) for n in ("column_name", "expected", "actual")])
    )
    return (
        per_key.withColumn("issue", issue)
        .withColumn(
            "_cell", F.explode(F.when(F.col("issue") == "cell", differing).otherwise(whole_row))
        )
        .select(key, "_cell.*", "issue", "n_expected", "n_actual")
    )


def _cell(name: str) -> Column:
    before, after = F.col(f"_e.{name}"), F.col(f"_a.{name}")
    return F.when(
        ~before.eqNullSafe(after),
        F.struct(
            F.lit(name).alias("column_name"),
            before.cast("string").alias("expected"),
            after.cast("string").alias("actual"),
        ),
    )


def positional_match(
    expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Cell differences of two tables laid side by side in the order of the key.

    Row ``n`` of one side is compared with row ``n`` of the other, also under repeated keys, whose rows
    are ordered by the columns. A side that has more rows gives one ``missing`` (of the expected
    side) or ``surplus`` row for each that has no partner.
    """
    cells = [c for c in columns if c != key]
    order = [key, *cells]
    sides = []
    for df, name in ((expected, "_e"), (actual, "_a")):
        placed = with_position(df.select(*order), *order)
        sides.append(placed.select("position", F.struct(*order).alias(name)))
    paired = sides[0].join(sides[1], "position", "full")
    issue = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "surplus").otherwise("cell")
    differing = F.array_compact(F.array(*[_cell(c) for c in order]))
    whole = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in ("column_name", "expected", "actual")]))
    return (
        paired.withColumn("issue", issue)
        .withColumn("_cell", F.explode(F.when(F.col("issue") == "cell", differing).otherwise(whole)))
        .select("position", "_cell.*", "issue")
    )


def bottom_k_sample_match(
    expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str], n: int = 100, salt: str = ""
) -> DataFrame:
    """Differences between the rows of ``n`` keys drawn at random, the same keys on both sides.

    The keys with the smallest salted hashes are taken, of those found on either side: a sample that
    does not depend on the order of the rows or their partitions, and that another salt draws anew.
    """
    order = [key, *[c for c in columns if c != key]]
    hashed = F.md5(F.concat_ws("|", F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    both = expected.select(hashed.alias("h")).unionAll(actual.select(hashed.alias("h")))
    drawn = both.distinct().orderBy("h").limit(n).agg(F.max("h"))
    sides = [df.select(*order).filter(hashed <= drawn.scalar()) for df in (expected, actual)]
    return row_differences(*sides, order)
