"""Exact near-duplicate groups of 64-bit SimHash fingerprints, found with vantage-point trees.

Fingerprints are computed in one scan and written; equal ones collapse to one row. A few vantage
points cut the space into shards by Hamming distance. A fingerprint belongs to one shard and is
also asked in every shard that a ball of the link distance around it reaches, by the triangle
bound, so no pair across a boundary is lost. Each shard builds its own vantage-point tree, prunes
with the same bound and gives back the links as a forest, never as pairs, so a large group costs a
row per member. A ball of radius 2 holds 2081 of the distinct fingerprints, which bounds the
links of one even in a hot group.

Edge cases: null and empty texts have fingerprint zero and link like any other; repeated rows get
the same group; a null id takes part but never names a group with other ids; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.llm._spark import components, written
from seismark.llm._text import LOWER, NOT_SPACE, ranges, signed, slices, utf8, word_spans

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2
#: Distinct fingerprints of one shard, about; and the sample that the vantage points come from.
SHARD_ROWS = 32_768
SAMPLE_ROWS = 8_192
LEAF_ROWS = 192


def text_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of every row: bit b is set if it is set in over half the shingle hashes."""
    data = LOWER[data]
    starts, ends, at = word_spans(data, offsets, NOT_SPACE)
    length = ends - starts
    first = np.cumsum(length + 1) - length - 1
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[ranges(first, length)] = data[ranges(starts, length)]
    raw, words = joined.tobytes(), np.diff(at)
    shingles = np.where(words == 0, 0, np.maximum(words - shingle + 1, 1))
    begin = ranges(at[:-1], shingles)
    end = np.minimum(begin + shingle, np.repeat(at[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    left, right = first[begin].tolist(), (first[end] + length[end]).tolist()
    hashes = np.fromiter((digest(raw[s:e], SEED) for s, e in zip(left, right, strict=True)), np.uint64, len(left))
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    result, at = np.zeros(len(words), np.uint64), np.cumsum(shingles) - shingles
    for row in np.flatnonzero(shingles).tolist():
        own = bits[at[row] : at[row] + shingles[row]]
        cut = len(own) // 255 * 255
        ones = own[cut:].sum(axis=0, dtype=np.uint8).astype(np.int64)
        if cut:  # bytes add up fastest where a sum of 255 flags fits one
            ones += np.add.reduce(own[:cut].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        result[row] = np.packbits(2 * ones > len(own), bitorder="little").view("<u8")[0]
    return result


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, code): the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            code = signed(text_fingerprints(*utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(code)], names=["doc_id", "code"])

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "doc_id long, code long")


class Node:
    """A vantage point: codes within ``radius`` of it lie inside, the others outside."""

    def __init__(self, codes: np.ndarray, leaf_rows: int, rng: np.random.Generator, depth: int = 64):
        self.codes, self.inside, self.outside = codes, None, None
        if len(codes) <= leaf_rows or depth == 0:
            return
        self.vantage = codes[rng.integers(len(codes))]
        distance = np.bitwise_count(codes ^ self.vantage)
        self.radius = int(np.partition(distance, len(codes) // 2)[len(codes) // 2])
        near = distance <= self.radius
        if near.all():
            self.radius -= 1
            near = distance <= self.radius
            if not near.any():
                return
        self.codes = None
        self.inside = Node(codes[near], leaf_rows, rng, depth - 1)
        self.outside = Node(codes[~near], leaf_rows, rng, depth - 1)

    def leaves(self) -> list[Node]:
        return [self] if self.inside is None else self.inside.leaves() + self.outside.leaves()

    def visit(self, asked: np.ndarray, index: np.ndarray, reach: int) -> Iterator[tuple[Node, np.ndarray]]:
        """Each leaf with the indexes into ``asked`` whose balls of radius ``reach`` touch it."""
        if not len(index):
            return
        if self.inside is None:
            yield self, index
            return
        distance = np.bitwise_count(asked[index] ^ self.vantage).astype(np.int16)
        yield from self.inside.visit(asked, index[distance - reach <= self.radius], reach)
        yield from self.outside.visit(asked, index[distance + reach > self.radius], reach)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest linked index of each of n nodes; a and b hold the linked index pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def shard_links(rows: pd.DataFrame, reach: int) -> pd.DataFrame:
    """Forest edges (a, b) of all links between a shard's own codes and the codes asked in it."""
    own = np.sort(rows["code"].to_numpy()[rows["own"].to_numpy()]).view(np.uint64)
    asked = np.sort(rows["code"].to_numpy()).view(np.uint64)
    if not len(own):
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    rank = np.argsort(asked, kind="stable")
    ordered = asked[rank]
    label = np.arange(len(asked))
    left, right, waiting = [], [], 0

    def settle():
        nonlocal left, right, waiting, label
        ends = np.arange(len(asked))
        label = forest(len(asked), np.concatenate([*left, ends]), np.concatenate([*right, label]))
        left, right, waiting = [], [], 0

    for leaf, index in Node(own, LEAF_ROWS, np.random.default_rng(7)).visit(asked, np.arange(len(asked)), reach):
        member = rank[np.searchsorted(ordered, leaf.codes)]
        step = max(1, (1 << 21) // len(member))
        for at in range(0, len(index), step):
            part = index[at : at + step]
            q, m = np.nonzero(np.bitwise_count(asked[part][:, None] ^ leaf.codes[None, :]) <= reach)
            left.append(part[q])
            right.append(member[m])
            waiting += len(q)
            if waiting > 1 << 21:
                settle()
    settle()
    linked = label != np.arange(len(asked))
    codes = asked.view(np.int64)
    return pd.DataFrame({"a": codes[linked], "b": codes[label[linked]]})


def near_duplicate_links(codes: DataFrame, max_distance: int = MAX_DISTANCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) over distinct ``code`` values that join all codes linked within the distance."""
    n = codes.count()
    sample = codes.orderBy(F.xxhash64("code")).limit(SAMPLE_ROWS).collect()
    points = np.array([r["code"] for r in sample], np.int64).view(np.uint64)
    tree = Node(points, max(1, int(shard_rows * len(points) / max(n, 1))), np.random.default_rng(3))
    for number, leaf in enumerate(tree.leaves()):
        leaf.shard, leaf.codes = number, None

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy(zero_copy_only=False).astype(np.int64)
            asked, every, home = code.view(np.uint64), np.arange(len(code)), np.empty(len(code), np.int64)
            for leaf, index in tree.visit(asked, every, 0):
                home[index] = leaf.shard
            for leaf, index in tree.visit(asked, every, max_distance):
                shard = np.full(len(index), leaf.shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(code[index]), pa.array(home[index] == shard)], names=["shard", "code", "own"]
                )

    dealt = codes.mapInArrow(deal, "shard long, code long, own boolean")
    return dealt.groupBy("shard").applyInPandas(lambda rows: shard_links(rows, max_distance), "a long, b long")


def simhash_groups(documents: DataFrame, max_distance: int = MAX_DISTANCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id that links reach from a document."""
    coded = written(fingerprints(documents, id_column, text_column), "simhash-codes")
    classes = written(coded.groupBy("code").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("members")), "simhash-classes")
    linked = components(near_duplicate_links(classes.select("code"), max_distance), "simhash-links")
    rooted = classes.join(linked.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "least", F.coalesce("component", "code").alias("component")
    )
    named = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = rooted.join(named, "component").select("code", "component_id")
    return coded.join(groups, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
