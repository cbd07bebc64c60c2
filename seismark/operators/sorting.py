"""Total orders and top-k.

A tied sort key leaves the order open, so each sort takes the remaining keys as tie-breakers;
they also let the range partitioning cut inside a long run of equal values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.session import work_folder


def sort_by(df: DataFrame, *keys: str, descending: bool = False, ties: tuple[str, ...] = ()):
    """Order by the keys, all ascending or all descending; ties ascending."""
    place = F.desc_nulls_last if descending else F.asc_nulls_first
    return df.orderBy(*[place(k) for k in keys], *[F.asc_nulls_first(k) for k in ties])


def top_k_by_key(df: DataFrame, *keys: str, k: int = 100) -> DataFrame:
    """The first ``k`` rows by the keys: each task keeps its own ``k`` best, no full sort."""
    return df.orderBy(*[F.asc_nulls_first(key) for key in keys]).limit(k)


def with_position(df: DataFrame, *keys: str, out: str = "position") -> DataFrame:
    """The rows with their places, from 0, in the order of the keys, nulls first.

    Range partitions are sorted side by side and written with their own numbering; a partition's first
    place is the number of rows before it, a prefix sum over one count per partition. Rows that are
    equal in all keys stand in any order, so the keys should tell rows apart that differ.
    """
    spark = df.sparkSession
    path = work_folder(spark, "positions")
    in_order = df.orderBy(*[F.asc_nulls_first(k) for k in keys])
    numbered = F.monotonically_increasing_id()
    in_order.select("*", F.shiftright(numbered, 33).alias("_part"), numbered.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")).write.parquet(path)
    written = spark.read.parquet(path)
    before, starts = 0, []
    for part, n in sorted(map(tuple, written.groupBy("_part").count().collect())):  # a row per partition
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, T.StructType([T.StructField(c, T.LongType()) for c in ("_part", "_before")]))
    placed = written.join(F.broadcast(offsets), "_part")
    return placed.withColumn(out, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
