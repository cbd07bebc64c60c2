"""Benchmark decontamination: windows of benchmark words looked up in every document window.

The windows of the benchmark form a hash set that every task holds. Its size is checked first:
up to ``broadcast_bytes`` of benchmark text it is broadcast; a larger benchmark is taken in parts
of that size, one scan of the documents each, and the spans found are merged by text. A hash that
matches is verified on the words themselves.

Edge cases: null and empty texts have no words; an item of fewer words than a window is one
window; repeated items count once by their id, an item with a null id hits words without being
listed; an empty benchmark hits nothing; repeated documents are scored one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismark.llm._spark import numbered, renamed_back, written
from seismark.llm._text import LOWER, WORD_OR_HIGH, covered, ranges, sequence_hashes, slices, utf8, word_hashes, word_spans

WINDOW_WORDS = 10
#: Benchmark text whose windows one task holds at a time.
BROADCAST_BYTES = 16 << 20
_BITS = 22

SPANS = "n_words long, words array<long>, items array<long>"


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, word starts, ends and offsets by row."""
    data = LOWER[data]
    return (data, *word_spans(data, offsets, WORD_OR_HIGH))


class WindowSet:
    """The windows of some benchmark items, by number of words and hash."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int):
        self.by_width: dict[int, dict[int, list[tuple[tuple[bytes, ...], list[int | None]]]]] = {}
        for item, text in items:
            data, starts, ends, _ = words_of(*utf8(pa.array([text], pa.string())))
            words = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
            if not words:
                continue
            k = min(width, len(words))
            hashes = sequence_hashes(word_hashes(data, starts, ends), k)
            for i, h in enumerate(hashes.tolist()):
                known = self.by_width.setdefault(k, {}).setdefault(h, [])
                window = tuple(words[i : i + k])
                for same, owners in known:
                    if same == window:
                        owners.append(item)
                        break
                else:
                    known.append((window, [item]))
        self.filters = {}
        for k, table in self.by_width.items():
            keys = np.sort(np.fromiter(table, np.uint64, len(table)))
            flags = np.zeros(1 << _BITS, bool)
            flags[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.filters[k] = flags, keys

    def hits(self, data, starts, ends, first, last) -> Iterator[tuple[int, int, list[int | None]]]:
        """(word, width, items) of every benchmark window in the rows' words; rows start at ``first``."""
        hashes = word_hashes(data, starts, ends)
        row_end = np.repeat(last, last - first)
        for k, (flags, keys) in self.filters.items():
            rolled = sequence_hashes(hashes, k)
            at = np.flatnonzero(flags[(rolled >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = at[at + k <= row_end[at]]
            found = np.minimum(np.searchsorted(keys, rolled[at]), len(keys) - 1)
            for i in at[keys[found] == rolled[at]].tolist():
                window = tuple(data[s:e].tobytes() for s, e in zip(starts[i : i + k], ends[i : i + k], strict=True))
                for same, owners in self.by_width[k][int(rolled[i])]:
                    if same == window:
                        yield i, k, owners


def _scan(batches: Iterator[pa.RecordBatch], windows: WindowSet) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        data, starts, ends, at = words_of(*utf8(batch.column("_text")))
        n = np.diff(at)
        hit, items = [[] for _ in range(len(n))], [set() for _ in range(len(n))]
        for word, k, owners in windows.hits(data, starts, ends, at[:-1], at[1:]):
            row = int(np.searchsorted(at, word, "right")) - 1
            hit[row].append((word - int(at[row]), k))
            items[row].update(x for x in owners if x is not None)
        words = []
        for row, spans in enumerate(hit):
            if spans:
                begin, size = np.array(spans, np.int64).T
                words.append(np.unique(ranges(begin, size)))
            else:
                words.append([])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(x) for x in batch.schema.names if x != "_text"),
                pa.array(n),
                pa.array(words, pa.list_(pa.int64())),
                pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
            ],
            names=[*(x for x in batch.schema.names if x != "_text"), "n_words", "words", "items"],
        )


def benchmark_parts(benchmark: DataFrame, id_column: str, text_column: str, part_bytes: int) -> Iterator[list]:
    """The items in parts of about ``part_bytes`` of text, dealt by hash; one is fetched at a time."""
    source = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text")).distinct()
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // part_bytes
    for number in range(parts):
        yield [tuple(r) for r in source.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == number).collect()]


def find_hits(
    spark: SparkSession,
    documents: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_column: str = "text",
    width: int = WINDOW_WORDS,
    benchmark_id: str = "item_id",
    benchmark_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``keep`` columns of every document, its number of words, hit word numbers and items.

    A benchmark of one part takes one scan. Of a larger one, the hits of each part are written by
    text, which two hashes name, before the next part is fetched; documents then meet those of
    their own text, and no others, whatever their ids.
    """
    source = documents.select(*keep, F.col(text_column).alias("_text"))
    shape = lambda frame: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema) + ", " + SPANS

    def scan(frame: DataFrame, part: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(part)
        return frame.mapInArrow(lambda batches: _scan(batches, _set_of(shared, width)), shape(frame.drop("_text")))

    parts = benchmark_parts(benchmark, benchmark_id, benchmark_text, broadcast_bytes)
    first = next(parts)
    second = next(parts, None)
    if second is None:
        return scan(source, first)
    text = F.coalesce("_text", F.lit(""))
    keys = [F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b")]
    by_text, found = source.select(*keys, "_text"), []
    for part in chain([first, second], parts):
        found.append(written(scan(by_text, part).where(F.size("words") > 0), "decontamination-part"))
    # copies of a text collapse in the tasks that read them
    spans = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in ("words", "items")]
    merged = reduce(DataFrame.unionByName, found).groupBy("_a", "_b").agg(*spans)
    plain = scan(source.select(*keep, *keys, "_text"), []).drop("words", "items")
    none = F.array().cast("array<long>")
    return plain.join(merged, ["_a", "_b"], "left").select(
        *keep, "n_words", F.coalesce("words", none).alias("words"), F.coalesce("items", none).alias("items")
    )


_sets: dict[int, WindowSet] = {}


def _set_of(shared, width: int) -> WindowSet:
    """The window set of a broadcast, built once in a Python worker."""
    key = (id(shared.value), width)
    if _sets.get("key") != key:
        _sets.clear()
        _sets.update(key=key, value=WindowSet(shared.value, width), items=shared.value)
    return _sets["value"]


def contamination(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: words, hit words, items found and whether any word is hit."""
    hits = find_hits(spark, documents, benchmark, ["doc_id"], **options)
    names = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return hits.select(
        "doc_id",
        "n_words",
        F.size("words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("words") > 0).alias("contaminated"),
    )


def remove_contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit word, with all their columns."""
    frame, names = numbered(documents)
    hits = find_hits(spark, frame, benchmark, list(names.values()), names["text"], **options)
    return renamed_back(hits.where(F.size("words") == 0), names)
