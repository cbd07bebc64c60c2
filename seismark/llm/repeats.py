"""Where two windows of equal content can be: segments of texts by their smallest gram.

Every window of ``length`` units (bytes or words) has a smallest gram of ``gram`` units by hash,
and equal windows have the same one. Neighbouring windows that share it form a segment, so a text
is a few segments and windows can only be equal within segments of one gram. This finds the
segments that may hold a repeat and says which of them need to be compared unit by unit:

* a gram that one segment has, and that lies in it once, holds no repeat;
* a gram whose segments all have the same content repeats as a whole;
* the rest are handed to the caller, each distinct content once with the number of its places.

Segments are counted by key with sums taken in the tasks first, so copies of a passage cost a row
per task and not per copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.llm._spark import written
from seismark.llm._text import covered, mix, ranges, sequence_hashes, signed, slices, utf8

_FIRST, _LAST = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
KEY = ["doc_id", "text_hash"]


@dataclass(frozen=True)
class Units:
    """How a text is cut: ``split(data, offsets)`` gives a 64-bit code per unit, the unit offsets of
    the rows, and the byte starts and ends of the units (None where a unit is a byte)."""

    length: int
    gram: int
    split: Callable


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def segments(codes: np.ndarray, at: np.ndarray, length: int, gram: int):
    """Row, first window, number of windows, gram, content hash and whether windows repeat inside."""
    none = np.empty(0, np.int64)
    if len(codes) < length:
        return none, none, none, none, none, np.empty(0, bool)
    width = length - gram + 1
    grams = sequence_hashes(codes, gram)
    least = sliding_min(grams, width)
    whole = sequence_hashes(codes, length)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(least)]
    valid = np.arange(len(least)) + length <= at[row + 1]
    joined = np.zeros(len(least), bool)  # continues the segment of the window before
    joined[1:] = valid[1:] & valid[:-1] & (row[1:] == row[:-1]) & (least[1:] == least[:-1])
    # the smallest gram stands first in a window and again in the next one: content may repeat
    again = np.zeros(len(least), bool)
    again[:-1] = joined[1:] & (grams[: len(least) - 1] == least[:-1])
    starts = np.flatnonzero(valid & ~joined)
    if not len(starts):
        return none, none, none, none, none, np.empty(0, bool)
    stops = np.flatnonzero(valid & np.append(~joined[1:], True)) + 1
    pieces = -(-(stops - starts) // width)  # a run as long as a periodic text is cut
    if pieces.max() > 1:
        first = np.repeat(starts, pieces) + width * ranges(np.zeros(len(starts), np.int64), pieces)
        stops = np.minimum(first + width, np.repeat(stops, pieces))
        starts = first
    inner = np.add.reduceat(again, np.stack([starts, stops], 1).ravel().clip(max=len(again) - 1), dtype=np.int64)[::2] > 0
    n = stops - starts
    content = mix(whole[starts] * _FIRST + whole[stops - 1] * _LAST + n.astype(np.uint64))
    return row[starts], starts - at[row[starts]], n, signed(least[starts]), signed(content), inner


def keyed(documents: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Documents by (doc_id, text_hash): rows equal in both have equal results."""
    text = F.col(text_column)
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def same_key(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def find_segments(documents: DataFrame, units: Units) -> DataFrame:
    """(doc_id, text_hash, first, n, gram, content, inner) of all segments of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, at, _, _ = units.split(*utf8(batch.column("text")))
            row, *rest = segments(codes, at, units.length, units.gram)
            place = pa.array(row)
            columns = [batch.column(c).take(place) for c in KEY] + [pa.array(x) for x in rest]
            yield pa.RecordBatch.from_arrays(columns, names=[*KEY, "first", "n", "gram", "content", "inner"])

    return documents.mapInArrow(run, "doc_id long, text_hash long, first long, n long, gram long, content long, inner boolean")


def candidate_segments(documents: DataFrame, units: Units, label: str) -> DataFrame:
    """The segments that may hold a repeat. ``mixed``: the gram has segments of several contents."""
    found = written(
        find_segments(documents, units).select(*KEY, F.col("first").cast("int"), F.col("n").cast("short"), "gram", "content", "inner"),
        f"{label}-segments",
    )
    weight = F.when(F.col("inner"), 2).otherwise(1)
    shared = found.groupBy("gram").agg(
        F.sum(weight).alias("places"), F.min("content").alias("low"), F.max("content").alias("high"), F.max("inner").alias("any_inner")
    ).where("places > 1")
    shared = shared.select("gram", ((F.col("low") != F.col("high")) | F.col("any_inner")).alias("mixed"))
    return written(found.join(shared, "gram").drop("inner"), f"{label}-candidates")


def distinct_contents(candidates: DataFrame) -> DataFrame:
    """Each distinct (gram, content) of the mixed grams: its places, and one place to read it at."""
    return candidates.where("mixed").groupBy("gram", "content").agg(
        F.count(F.lit(1)).alias("places"), F.min(F.struct(*KEY, "first", "n")).alias("at")
    )


def read_contents(documents: DataFrame, contents: DataFrame, units: Units) -> DataFrame:
    """(gram, content, places, n, bytes) with the text of each distinct content; words are joined
    by one blank."""
    wanted = contents.groupBy("at.doc_id", "at.text_hash").agg(
        F.collect_list(F.struct("gram", "content", "places", "at.first", "at.n")).alias("wanted")
    )
    met = documents.join(wanted, same_key(documents, wanted)).select(documents["text"], "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            _, at, starts, ends = units.split(data, offsets)
            lists = batch.column("wanted")
            parts = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            first = parts.field("first").to_numpy() + at[row]
            n = parts.field("n").to_numpy().astype(np.int64)
            last = first + n + units.length - 2
            if starts is None:
                size = last - first + 1
                flat, ends_of = data[ranges(first, size)], np.cumsum(size)
            else:
                count = last - first + 1
                word = ranges(first, count)
                width = ends[word] - starts[word] + 1
                flat = np.full(int(width.sum()), 32, np.uint8)
                flat[ranges(np.cumsum(width) - width, width - 1)] = data[ranges(starts[word], width - 1)]
                ends_of = np.cumsum(width)[np.cumsum(count) - 1]
            cut = np.concatenate([[0], ends_of])
            raw = flat.tobytes()
            text = [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [parts.field("gram"), parts.field("content"), parts.field("places"), pa.array(n), pa.array(text, pa.binary())],
                names=["gram", "content", "places", "n", "bytes"],
            )

    return met.mapInArrow(run, "gram long, content long, places long, n long, bytes binary")


def by_whole_window(documents: DataFrame, contents: DataFrame, units: Units) -> DataFrame:
    """(gram, content, runs) for grams with very many contents: every window counted by the hash of
    its whole length, with sums in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            codes, at, _, _ = units.split(*utf8(batch.column("bytes")))
            n = np.diff(at) - units.length + 1
            row = np.repeat(np.arange(batch.num_rows), n)
            window = ranges(at[:-1], n)
            low = signed(sequence_hashes(codes, units.length)[window])
            high = signed(sequence_hashes(mix(codes), units.length)[window])
            place = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(low), pa.array(high), *(batch.column(c).take(place) for c in ("gram", "content", "places")), pa.array(window - at[row])],
                names=["low", "high", "gram", "content", "places", "window"],
            )

    shape = "low long, high long, gram long, content long, places long, window long"
    windows = written(read_contents(documents, contents, units).mapInArrow(run, shape), "hot-windows")
    shared = windows.groupBy("low", "high").agg(F.sum("places").alias("places")).where("places > 1").drop("places")
    run_of = F.struct(F.col("window").cast("int").alias("start"), F.lit(1).alias("n"))
    return windows.join(shared, ["low", "high"]).groupBy("gram", "content").agg(F.collect_set(run_of).alias("runs"))


def repeated_spans(candidates: DataFrame, decided: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash, spans): start and length in units of all repeated windows of a text.

    ``decided`` has (gram, content, runs): first window and number of repeated windows, in pairs.
    """
    whole = candidates.where("NOT mixed").select(*KEY, F.col("first").alias("start"), (F.col("n") + length - 1).alias("size"))
    runs = candidates.where("mixed").join(decided, ["gram", "content"]).select(*KEY, "first", F.explode("runs").alias("run"))
    part = runs.select(*KEY, (F.col("first") + F.col("run.start")).alias("start"), (F.col("run.n") + length - 1).alias("size"))
    both = whole.unionByName(part).select(*KEY, F.struct(F.col("start").cast("int").alias("start"), F.col("size").cast("int").alias("size")).alias("span"))
    return both.groupBy(*KEY).agg(F.collect_set("span").alias("spans"))


RUNS = "gram long, content long, runs array<struct<start: int, n: int>>"


def runs_batch(gram: pa.Array, content: pa.Array, n: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    """Segments with their runs of flagged windows; ``flags`` holds the n windows of each segment."""
    at = np.concatenate([[0], np.cumsum(n)])
    edge = np.zeros(len(flags) + 1, bool)
    edge[at[:-1]] = True
    begin = np.flatnonzero(flags & (edge[:-1] | ~np.concatenate([[False], flags[:-1]])))
    end = np.flatnonzero(flags & (edge[1:] | ~np.concatenate([flags[1:], [False]]))) + 1
    end = np.minimum(end, at[np.searchsorted(at, begin, "right")])
    owner = np.searchsorted(at, begin, "right") - 1
    counts = np.bincount(owner, minlength=len(n))
    has = np.flatnonzero(counts)
    pairs = pa.StructArray.from_arrays(
        [pa.array((begin - at[owner]).astype(np.int32)), pa.array((end - begin).astype(np.int32))], names=["start", "n"]
    )
    offsets = np.concatenate([[0], np.cumsum(counts[has])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [gram.take(pa.array(has)), content.take(pa.array(has)), pa.ListArray.from_arrays(pa.array(offsets), pairs)],
        names=["gram", "content", "runs"],
    )


def flagged(spans: pa.ListArray, row: int, n: int) -> np.ndarray:
    """Flags of the n units of a row that its spans cover."""
    if not spans[row].is_valid:
        return np.zeros(n, bool)
    own = spans[row].values
    start, size = own.field("start").to_numpy().astype(np.int64), own.field("size").to_numpy().astype(np.int64)
    return covered(n, start, start + size)


def repeats_of(documents: DataFrame, units: Units, label: str, shard, shard_windows: int, hot_contents: int) -> DataFrame:
    """(doc_id, text_hash, spans) of the repeated windows; ``shard`` decides one shard of contents."""
    candidates = candidate_segments(documents, units, label)
    contents = written(distinct_contents(candidates), f"{label}-contents")
    hot = contents.groupBy("gram").count().where(F.col("count") > hot_contents).select("gram")
    windows = contents.agg(F.sum("at.n")).first()[0] or 0
    read = read_contents(documents, contents.join(hot, "gram", "left_anti"), units)
    shards = 1 + windows // shard_windows
    decided = read.repartition(shards, "gram").mapInArrow(shard, RUNS)
    if hot.count():
        decided = decided.unionByName(by_whole_window(documents, contents.join(hot, "gram", "left_semi"), units))
    return repeated_spans(candidates, decided, units.length)
