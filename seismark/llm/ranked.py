"""Ranked lexical search by presence-mask grouping.

Documents become rows of (id, length, term numbers, term counts) for the terms of the searched items,
written once as the index. A search task takes index rows in blocks. For an item it sets a bit per
term and document, packs the bits into one mask per document and groups the block's documents by
equal masks. A mask's highest possible score is the sum of its terms' weights times the largest part
any document of the block gets for the term. Masks are then evaluated from the highest bound down,
their documents scored exactly, until the k-th best score of the task lies above all bounds left.
Each task hands on at most k documents an item, and a window ranks these.

The items' terms are broadcast, ``PART_BYTES`` of item text at a time: a larger benchmark is dealt
into parts by hash, each searched and written before the next one is fetched.

Words are told apart by 64-bit hashes.

Edge cases: a null text has no terms; items and documents without terms give and get nothing; each
item row is ranked for itself, also with a null or repeated id; equal scores go by id, null ids
last; each repeated document row has a place of its own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismark.llm._spark import written
from seismark.llm._text import LOWER, WORD_OR_HIGH, signed, slices, utf8, word_hashes, word_spans

TOP = 20
PART_BYTES = 4 << 20
BLOCK_DOCUMENTS = 8192
BLOCK_POSTINGS = 2_000_000
#: Bits of presence an item sets up at a time; an item of very many terms takes fewer documents at once.
PRESENCE_CELLS = 1 << 24
#: Documents of the first masks scored at once; each further step takes twice as many.
FIRST_SCORED = 64
_BITS = 22

INDEX = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, item_id long, copies long, doc_id long, score long"

# Fixed values of the score: scale, and the shares of the length norm.
SCORE_SCALE, COUNT_SCALE, NORM_SCALE = 1_000_000_000, 1000, 12
NORM_BASE, NORM_LENGTH = 100 - 25, 25
WEIGHT_SCALE = 1000


class Item(NamedTuple):
    item_id: int | None
    copies: int
    terms: np.ndarray
    times: np.ndarray


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of some texts, and the n + 1 offsets of the texts."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, at = word_spans(data, offsets, WORD_OR_HIGH)
    return word_hashes(data, starts, ends), at


def items_of(part: list[tuple[int | None, str, int]]) -> tuple[np.ndarray, list[Item]]:
    """The sorted term hashes of a part of the benchmark, and its items by number in them."""
    hashes, at = hashed_words(pa.array([text for _, text, _ in part], pa.string()))
    vocabulary, number = np.unique(hashes, return_inverse=True)
    items = []
    for (item_id, _, copies), start, stop in zip(part, at[:-1], at[1:], strict=True):
        items.append(Item(item_id, copies, *np.unique(number[start:stop], return_counts=True)))
    return vocabulary, items


def index_rows(documents: DataFrame, vocabulary: np.ndarray, id_column: str, text_column: str) -> DataFrame:
    """Every document's number of terms, and its counts of the vocabulary's terms."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        flags = np.zeros(1 << _BITS, bool)
        flags[(known >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        for batch in slices(batches, "_text"):
            hashes, at = hashed_words(batch.column("_text"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            near = np.flatnonzero(flags[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, hashes[near]), max(len(known) - 1, 0))
            hit = known[place] == hashes[near]
            code, count = np.unique(row[near[hit]] * max(len(known), 1) + place[hit], return_counts=True)
            own, term = np.divmod(code, max(len(known), 1))
            bounds = pa.array(np.searchsorted(own, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (term, count)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(np.diff(at)), *lists], names=["doc_id", "n", "terms", "counts"])

    source = documents.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    return source.mapInArrow(run, INDEX)


class Best:
    """The best documents of an item so far: highest score first, then smallest id."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.none = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def least(self) -> int:
        """A document below this score cannot be among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        good = score >= self.least()
        score, ids, none = (np.concatenate(x) for x in ((self.score, score[good]), (self.id, ids[good]), (self.none, none[good])))
        order = np.lexsort((ids, none, -score))[: self.k]
        self.score, self.id, self.none = score[order], ids[order], none[order]


class Block:
    """Index rows of some documents, with the part of the score that each posting earns."""

    def __init__(self, ids: np.ndarray, none: np.ndarray, n: np.ndarray, at: np.ndarray, terms: np.ndarray, counts: np.ndarray, documents: int, words: int, vocabulary: int):
        self.ids, self.none, self.at, self.terms = ids, none, at, terms
        norm = NORM_BASE + (NORM_LENGTH * n * documents) // max(words, 1)
        row = np.repeat(np.arange(len(n)), np.diff(at))
        counts = counts.astype(np.int64)
        self.part = (SCORE_SCALE * counts) // (COUNT_SCALE * counts + NORM_SCALE * norm[row])
        order = np.argsort(terms, kind="stable")
        self.row_of, ordered = row[order], terms[order]
        self.first = np.searchsorted(ordered, np.arange(vocabulary + 1))
        self.most = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.most, terms, self.part)

    def masks(self, terms: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct masks (masks by terms) of the documents low .. high - 1, and each one's mask."""
        present = np.zeros((-(-len(terms) // 64) * 64, high - low), np.uint8)
        for bit, term in enumerate(terms.tolist()):
            rows = self.row_of[self.first[term] : self.first[term + 1]]
            present[bit, rows[np.searchsorted(rows, low) : np.searchsorted(rows, high)] - low] = 1
        packed = np.ascontiguousarray(np.packbits(present, axis=0).T)
        words = packed.view(np.uint64)
        if words.shape[1] == 1:
            _, first, mask = np.unique(words[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, mask = np.unique(packed.view(f"V{packed.shape[1]}")[:, 0], return_index=True, return_inverse=True)
        return present[: len(terms), first].T, mask.ravel()

    def search(self, item: Item, weight: np.ndarray, best: Best) -> None:
        worth = item.times * weight[item.terms]
        use = (worth > 0) & (self.first[item.terms + 1] > self.first[item.terms])
        terms, worth = item.terms[use], worth[use]
        if not len(terms):
            return
        earns = np.zeros(len(weight), np.int64)
        earns[terms] = worth
        step = max(64, PRESENCE_CELLS // len(terms))
        for low in range(0, len(self.ids), step):
            high = min(low + step, len(self.ids))
            masks, mask_of = self.masks(terms, low, high)
            bound = masks.astype(np.int64) @ (worth * self.most[terms])
            order = np.argsort(-bound, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            by_mask = np.argsort(rank[mask_of], kind="stable")
            bound_of = bound[mask_of][by_mask]  # falling
            start, size = 0, FIRST_SCORED
            while start < len(by_mask) and bound_of[start] >= best.least():
                reach = int(np.searchsorted(-bound_of, -best.least(), "right"))
                stop = min(start + size, reach)
                rows = np.sort(by_mask[start:stop]) + low
                best.add(self.score(rows, earns), self.ids[rows], self.none[rows])
                start, size = stop, size * 2

    def score(self, rows: np.ndarray, earns: np.ndarray) -> np.ndarray:
        length = self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(length)
        place = np.arange(ends[-1]) - np.repeat(ends - length - self.at[rows], length)
        gained = np.concatenate([[0], np.cumsum(earns[self.terms[place]] * self.part[place])])
        return gained[ends] - gained[ends - length]


def blocks(batches: Iterator[pa.RecordBatch], documents: int, words: int, vocabulary: int) -> Iterator[Block]:
    held: list[pa.RecordBatch] = []
    rows = postings = 0

    def made() -> Block:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table["doc_id"].combine_chunks()
        lists = [table[c].combine_chunks() for c in ("terms", "counts")]
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False))]).astype(np.int64)
        terms, counts = (x.flatten().to_numpy() for x in lists)
        none = ids.is_null().to_numpy(zero_copy_only=False)
        return Block(ids.fill_null(0).to_numpy(), none, table["n"].to_numpy(), at, terms, counts, documents, words, vocabulary)

    for batch in batches:
        start = 0
        while start < batch.num_rows:
            size = pc.list_value_length(batch.column("terms").slice(start)).to_numpy(zero_copy_only=False).cumsum()
            fits = int(np.searchsorted(size, BLOCK_POSTINGS - postings, "right"))
            take = min(max(fits, 0 if held else 1), BLOCK_DOCUMENTS - rows, batch.num_rows - start)
            if take:
                held.append(batch.slice(start, take))
                rows, postings, start = rows + take, postings + int(size[take - 1]), start + take
            if rows >= BLOCK_DOCUMENTS or start < batch.num_rows:
                yield made()
                held, rows, postings = [], 0, 0
    if held:
        yield made()


def search_part(documents: DataFrame, part: list, k: int, id_column: str, text_column: str) -> DataFrame:
    spark = documents.sparkSession
    vocabulary, items = items_of(part)
    index = written(index_rows(documents, vocabulary, id_column, text_column), "ranked-index")
    held = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(vocabulary), np.int64)
    # one row a term of this part of the benchmark
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).toArrow()
    frequency[counted["term"].to_numpy()] = counted["n"].to_numpy()
    n_documents, n_words = held
    weight = np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        best = [Best(k) for _ in items]
        for block in blocks(batches, n_documents, n_words, len(weight)):
            for item, own in zip(items, best, strict=True):
                block.search(item, weight, own)
        for number, (item, own) in enumerate(zip(items, best, strict=True)):
            size = len(own.score)
            if size:
                ids = pa.array(own.id, mask=own.none)
                own_item = [pa.array([number] * size, pa.int32()), pa.array([item.item_id] * size, pa.int64()), pa.array([item.copies] * size)]
                yield pa.RecordBatch.from_arrays([*own_item, ids, pa.array(own.score)], names=["item", "item_id", "copies", "doc_id", "score"])

    return index.mapInArrow(run, FOUND)


def item_parts(benchmark: DataFrame, id_column: str, text_column: str, part_bytes: int) -> Iterator[list]:
    """The distinct items with their copies, in parts of about ``part_bytes`` of text, one of them on
    the driver at a time."""
    items = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    items = items.where(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // part_bytes
    for number in range(parts):
        of_part: Column = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == number
        yield [tuple(r) for r in items.where(of_part).collect()]


def ranked_search(
    documents: DataFrame, benchmark: DataFrame, k: int = TOP, id_column: str = "doc_id", text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item row."""
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    parts = []
    for part in item_parts(benchmark, item_id, item_text, part_bytes):
        ranked = search_part(documents, part, k, id_column, text_column).withColumn("rank", place).where(F.col("rank") <= k)
        ranked = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        parts.append(written(ranked.select("item_id", "rank", "doc_id", "score"), "ranked-part", free_shuffles=True))
    return reduce(DataFrame.unionByName, parts)
