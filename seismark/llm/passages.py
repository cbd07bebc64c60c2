"""Removal of repeated word passages, found with prefix-partitioned suffix trees.

Texts are cut into segments that only equal windows can share (:mod:`repeats`); the contents that
occur in several forms are dealt to tasks by their gram. There every window start is a suffix.
Suffixes are split by prefixes of growing length until a group fits the memory set for it, and the
tree of each group is built top-down, write-only: a node's suffixes are split by the words that
follow, and a node of a single suffix is a leaf that is not followed further. The nodes that reach
the depth of a window with more than one leaf are the maximal repeats of at least that length; the
leaves below them are the repeated windows.

Edge cases: null and empty texts, and those of fewer words than a window, lose nothing; repeated
rows are repeats of each other; documents equal in id and text give equal rows; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seismark.llm import repeats
from seismark.llm._spark import small_batches
from seismark.llm._text import NOT_SPACE, mix, ranges, sequence_hashes, slices, utf8, word_hashes, word_spans

WORDS = 35
GRAM = 8
#: Windows of a shard, about, and suffixes of a tree group.
SHARD_WINDOWS = 1_000_000
GROUP_SUFFIXES = 1 << 17
#: Distinct contents of one gram above which its windows are compared one by one.
HOT_CONTENTS = 200_000


def split_words(data: np.ndarray, offsets: np.ndarray):
    starts, ends, at = word_spans(data, offsets, NOT_SPACE)
    return word_hashes(data, starts, ends), at, starts, ends


def word_units(words: int = WORDS, gram: int = GRAM) -> repeats.Units:
    return repeats.Units(words, gram, split_words)


class Prefixes:
    """Codes of the next 1, 2, 4, ... words at a place: equal codes are equal words."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.depth, self.tables, width = depth, {}, 1
        while width <= depth:
            self.tables[width] = sequence_hashes(codes, width)
            width *= 2

    def step(self, done: int) -> int:
        """The widest step of the table that is not wider than what is done or what is left."""
        return max(w for w in self.tables if w <= max(1, done) and w <= self.depth - done)

    def following(self, suffix: np.ndarray, done: int, width: int) -> np.ndarray:
        return self.tables[width][suffix + done]


def groups(prefixes: Prefixes, suffix: np.ndarray, limit: int, done: int = 0) -> Iterator[tuple[np.ndarray, int]]:
    """(suffixes, common prefix length) of parts of at most ``limit`` suffixes; only suffixes equal
    in a whole window stay together beyond that."""
    if len(suffix) <= limit or done == prefixes.depth:
        yield suffix, done
        return
    width = prefixes.step(done)
    key = prefixes.following(suffix, done, width)
    order = np.argsort(key, kind="stable")
    suffix, key = suffix[order], key[order]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))
    start = 0
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a > limit:
            if start < a:
                yield suffix[start:a], done
            yield from groups(prefixes, suffix[a:b], limit, done + width)
            start = b
        elif b - start > limit:
            yield suffix[start:a], done
            start = a
    if start < len(suffix):
        yield suffix[start:], done


def deep_leaves(prefixes: Prefixes, suffix: np.ndarray, done: int) -> np.ndarray:
    """Suffixes below the tree nodes that reach the full depth with two or more leaves."""
    node = np.zeros(len(suffix), np.uint64)
    while len(suffix):
        if done < prefixes.depth:
            width = prefixes.step(done)
            node = mix(node * np.uint64(0x9E3779B97F4A7C15) + prefixes.following(suffix, done, width))
            done += width
        order = np.argsort(node, kind="stable")
        suffix, node = suffix[order], node[order]
        new = node[1:] != node[:-1]
        inner = ~(np.concatenate([[True], new]) & np.append(new, True))  # not a leaf of its own
        suffix, node = suffix[inner], node[inner]
        if done == prefixes.depth:
            break
    return suffix


def repeated_windows(codes: np.ndarray, at: np.ndarray, places: np.ndarray, words: int, limit: int = GROUP_SUFFIXES) -> np.ndarray:
    """Flags of the windows of each row whose words are in another place."""
    n = np.diff(at) - words + 1
    window = ranges(at[:-1], n)
    repeated = np.zeros(len(codes), bool)
    prefixes = Prefixes(codes, words)
    for suffix, done in groups(prefixes, window, limit):
        repeated[deep_leaves(prefixes, suffix, done)] = True
    return repeated[window] | np.repeat(places > 1, n)


def decide(batches: Iterator[pa.RecordBatch], words: int, limit: int) -> Iterator[pa.RecordBatch]:
    # a shard's texts are hashed a slice at a time and not kept: the working arrays are many times their size
    codes, counts, columns = [], [], []
    for batch in slices(batches, "bytes"):
        own, at, _, _ = split_words(*utf8(batch.column("bytes")))
        codes.append(own)
        counts.append(np.diff(at))
        columns.append([batch.column(c).to_numpy().copy() for c in ("gram", "content", "places", "n")])
    if columns:
        gram, content, places, n = (np.concatenate(x) for x in zip(*columns, strict=True))
        at = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        codes = np.concatenate(codes)
        flags = repeated_windows(codes, at, places, words, limit)
        yield repeats.runs_batch(pa.array(gram), pa.array(content), n, flags)


def remove_passages(
    documents: DataFrame, words: int = WORDS, gram: int = GRAM, shard_windows: int = SHARD_WINDOWS,
    group_suffixes: int = GROUP_SUFFIXES, hot_contents: int = HOT_CONTENTS, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document; kept words joined by a blank."""
    small_batches(documents.sparkSession)
    source = repeats.keyed(documents, text_column, id_column)
    units = word_units(words, gram)
    spans = repeats.repeats_of(
        source, units, "passages", lambda batches: decide(batches, words, group_suffixes), shard_windows, hot_contents
    )
    met = source.join(spans, repeats.same_key(source, spans), "left").select(source["doc_id"], source["text"], "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            starts, ends, at = word_spans(data, offsets, NOT_SPACE)
            removed, digest = [], []
            for row in range(batch.num_rows):
                gone = repeats.flagged(batch.column("spans"), row, int(at[row + 1] - at[row]))
                kept = np.flatnonzero(~gone) + at[row]
                width = ends[kept] - starts[kept] + 1
                text = np.full(int(width.sum()), 32, np.uint8)
                text[ranges(np.cumsum(width) - width, width - 1)] = data[ranges(starts[kept], width - 1)]
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(text[:-1].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return met.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
