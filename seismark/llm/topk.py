"""Exact top-k by inner product over an impact-ordered index, score at a time.

A shard of the candidates is indexed by impact: a posting is a component of a vector, its impact
the size of that component, and the postings of one quantised impact range form a segment per
dimension, kept as a slab of the vectors' matrix so that one product adds a segment range to the
scores of a whole block of queries. Segments are processed from high impact to low. After each
range the rest of a candidate is bounded by the norm of what is unprocessed of it (Cauchy-Schwarz);
the threshold is the k-th exact score among the leaders so far. Processing stops when no more than
``FEW`` of the candidates can still be members by that bound, which is a proof, and those are
rescored exactly.

Queries and candidates meet in blocks: shards of candidates against blocks of queries, the k best
of each shard, then the k best of all. Rows are dealt by their place in the scan, so neither equal
vectors nor repeated ids crowd a shard.

Edge cases: a vector that is null or has a null or non-finite component takes no part, nor does a
row with a null id; a query sees only vectors of its own length; a row is never its own answer, but
another row with the same id is; a repeated query id is answered for each of its rows; fewer than k
candidates give all of them; other columns are ignored. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismark.llm._spark import written
from seismark.llm._text import mix

K = 20
SCALE = 64
SHARD_ROWS = 8_192
QUERY_ROWS = 4_096
RANGES = 4
FEW = 0.02


def _vectors(batches: Iterator[pa.RecordBatch], scale: int, shards: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, lists, asked = (batch.column(c) for c in ("vec_id", "vector", "asked"))
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        known = np.asarray(flat.is_valid())
        x = np.floor(scale * flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64))
        bad = np.concatenate([[0], np.cumsum(~(known & np.isfinite(x)))])
        at = np.concatenate([[0], np.cumsum(size)])
        good = (bad[at[1:]] == bad[at[:-1]]) & np.asarray(lists.is_valid()) & np.asarray(ids.is_valid())
        rows = np.flatnonzero(good)
        place = number + rows
        number += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(rows)),
                pa.array(place),
                pa.array((mix(place.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)),
                asked.take(pa.array(rows)),
                pa.array(size[rows].astype(np.int64)),
                pa.array([x[at[i] : at[i + 1]].astype("<i8").tobytes() for i in rows], pa.binary()),
            ],
            names=["vec_id", "place", "shard", "asked", "size", "vector"],
        )


class ImpactIndex:
    """Slabs of one shard's vectors by falling impact, and the norms of what lies below each."""

    def __init__(self, vectors: np.ndarray, ranges: int = RANGES):
        size = np.abs(vectors)
        bounds = np.unique(np.quantile(size[size > 0], np.linspace(0, 1, ranges + 1)[1:-1])) if size.any() else []
        level = np.searchsorted(bounds, size, "right")
        self.slabs, self.rest = [], []
        for own in range(len(bounds), -1, -1):
            self.slabs.append(np.where(level == own, vectors, 0).astype(vectors.dtype))
            below = np.where(level < own, vectors, 0).astype(np.float64)
            self.rest.append(np.sqrt((below * below).sum(axis=1)))


def shard_best(query: np.ndarray, query_place: np.ndarray, vectors: np.ndarray, place: np.ndarray, ids: np.ndarray, k: int):
    """(query row, candidate row, score) of each query's k best candidates in the shard, and more
    only where scores tie with the k-th."""
    largest = float(np.abs(query).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, query.shape[1])
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    index, exact = ImpactIndex(vectors.astype(kind)), vectors.astype(kind)
    found = []
    for at in range(0, len(query), 256):
        q, own = query[at : at + 256].astype(kind), query_place[at : at + 256]
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        score, floor = np.zeros((len(q), len(exact)), kind), None
        for number, (slab, rest) in enumerate(zip(index.slabs, index.rest, strict=True)):
            score += q @ slab.T
            last = number == len(index.slabs) - 1
            if floor is None:
                self_row = own[:, None] == place[None, :]
                low = np.where(self_row, np.iinfo(np.int64).min // 2 if kind is np.int64 else -np.inf, score)
                if len(exact) > k:
                    lead = np.argpartition(low, -k - 1, axis=1)[:, -k - 1 :]
                    sure = np.einsum("qd,qkd->qk", q, exact[lead]).astype(np.float64)
                    sure[np.take_along_axis(self_row, lead, axis=1)] = -np.inf
                    floor = np.sort(sure, axis=1)[:, -k]
                else:
                    floor = np.full(len(q), -np.inf)
            # a hair wider than the proof needs, for the rounding of the norms
            open_ = (score + (norm[:, None] * rest[None, :] * (1 + 1e-9)) >= floor[:, None]) & ~self_row
            if last or open_.mean() <= FEW:
                break
        row, member = np.nonzero(open_)
        value = score[row, member] if last else np.concatenate(
            [np.einsum("nd,nd->n", q[row[i : i + 65536]], exact[member[i : i + 65536]]) for i in range(0, len(row), 65536)]
            or [np.empty(0, kind)]
        )
        keep = value >= floor[row]
        row, member, value = row[keep], member[keep], value[keep].astype(np.int64)
        order = np.lexsort((ids[member], -value, row))
        row, member, value = row[order], member[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < k
        found.append((row[best] + at, member[best], value[best]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["vector"]), "<i8").reshape(len(rows), -1)


def _meet(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    if not len(queries) or not len(candidates):
        return pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "query_place", "vec_id", "score")})
    place, ids = candidates["place"].to_numpy(), candidates["vec_id"].to_numpy()
    row, member, score = shard_best(_matrix(queries), queries["place"].to_numpy(), _matrix(candidates), place, ids, k)
    return pd.DataFrame(
        {
            "query_id": queries["vec_id"].to_numpy()[row], "query_place": queries["place"].to_numpy()[row],
            "vec_id": ids[member], "score": score,
        }
    )


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_k(
    vectors: DataFrame, asked: Column, k: int = K, scale: int = SCALE, id_column: str = "vec_id",
    vector_column: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row that ``asked`` selects.

    Components enter as ``floor(scale * x)``; equal scores are ranked by the smaller id.
    """
    source = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"), asked.alias("asked")
    )
    shards = 1 + source.count() // shard_rows
    shape = "vec_id long, place long, shard long, asked boolean, size long, vector binary"
    table = written(source.mapInArrow(lambda batches: _vectors(batches, scale, shards), shape), "topk-vectors")
    blocks = 1 + table.where("asked").count() // query_rows
    block = F.pmod(F.xxhash64("place"), F.lit(blocks))
    queries = table.where("asked").select(
        "vec_id", "place", "size", "vector", block.alias("block"), F.explode(_numbers(shards)).alias("shard")
    )
    candidates = table.select(
        "vec_id", "place", "size", "vector", "shard", F.explode(_numbers(blocks)).alias("block")
    )
    keys = ["shard", "block", "size"]
    met = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        lambda q, c: _meet(q, c, k), "query_id long, query_place long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "query_place").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
