"""Source divergence audit on a k-squared quadtree of the group-term count matrix.

Documents are counted by (language, source, term); a language keeps the terms of at least
``min_docs`` of its documents. A group gives every kept term a smoothed share ``p`` in parts of
10**9. Per language the counts form a matrix of sources by kept terms, cut into blocks of
``BLOCK_TERMS`` terms (by hash) and pairs of ``BLOCK_SOURCES`` sources, one task group each.

In a block the nonzero cells are the leaves of a quadtree (k = 2): a bit per quadrant and level says
whether it holds a cell, and ranks in the bits lead to the children. Two sources that are zero on a
term have the shares ``p0`` there, whatever the term, so all quadrants that are zero for both are
priced at once as terms times ``abs(p0 - q0)``. The walk goes down for a pair of sources jointly,
only where one of them has a leaf, and corrects that price leaf by leaf.

Edge cases: null text, language and source are empty strings; a group without kept terms has
``p = p0``; a language without kept terms gives value 0 for its pairs; repeated rows and ids count
each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismark.llm._spark import written
from seismark.llm._text import LOWER, byte_class, mix, ranges, slices, utf8, word_hashes, word_spans

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BLOCK_TERMS = 4096
BLOCK_SOURCES = 256
#: Pairs of sources that are walked at a time; their open nodes are this many times BLOCK_TERMS at most.
WALK_PAIRS = 256
SLICE_BYTES = 1 << 21

LETTERS = byte_class(lambda b: 97 <= b <= 122 or b >= 128)
COUNTS = "lang string, source string, term string, n long, docs long"
FOUND = "lang string, source string, part string, item string, value long"


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of a UTF-8 buffer as a string array."""
    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    chars = np.ascontiguousarray(data[ranges(starts, length)])
    return pa.Array.from_buffers(pa.large_string(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(chars)])


def _totals(code: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """One place of each distinct code, and the sums of the weights over its places."""
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return order[first], [np.add.reduceat(w[order], first) for w in weights]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        data, offsets = utf8(batch.column("text"))
        data = LOWER[data]
        starts, ends, at = word_spans(data, offsets, LETTERS)
        if not len(starts):
            continue
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        row, word = np.repeat(np.arange(batch.num_rows), np.diff(at)), word_hashes(data, starts, ends)
        # the terms of each document with their counts, then those of each group
        place, (n,) = _totals(mix(word ^ mix(row.astype(np.uint64) + np.uint64(1))), np.ones(len(word), np.int64))
        first, (n, docs) = _totals(mix(word[place] ^ mix(group[row[place]].astype(np.uint64) + np.uint64(1))), n, np.ones(len(place), np.int64))
        own = place[first]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang").take(pa.array(row[own])), batch.column("source").take(pa.array(row[own])),
                gathered(data, starts[own], ends[own]).cast(pa.string()), pa.array(n), pa.array(docs),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and holding documents in every group."""
    named = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    return named.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * wide(n + SMOOTHING)
    return F.when(terms > 0, 1 + F.call_function("div", top, wide(total + SMOOTHING * terms.cast("long"))))


class QuadTree:
    """The nonzero cells of a square matrix of side 2**depth, with a value each."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, depth: int):
        code = np.zeros(len(row), np.int64)
        for bit in range(depth):
            code |= ((column >> bit) & 1) << (2 * bit) | ((row >> bit) & 1) << (2 * bit + 1)
        order = np.argsort(code)
        code, self.value, self.depth = code[order], value[order], depth
        #: By level: the number of each nonzero child quadrant among those of its level, or -1.
        self.child = []
        for level in range(depth):
            nodes, below = (np.unique(code >> 2 * (depth - x)) for x in (level, level + 1))
            bits = np.zeros(4 * len(nodes), bool)
            bits[4 * np.searchsorted(nodes, below >> 2) + (below & 3)] = True
            self.child.append(np.where(bits, np.cumsum(bits) - 1, -1))

    def excess(self, a: np.ndarray, b: np.ndarray, zero: np.ndarray) -> np.ndarray:
        """For each pair of rows, the sum of abs(value - value) over the columns where one has a
        leaf, above the price abs(zero - zero) of those columns."""
        pair, left, right = np.arange(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        if not len(self.value):
            return np.zeros(len(a), np.int64)
        for level, child in enumerate(self.child):
            shift, parts = self.depth - 1 - level, []
            for half in (0, 1):
                down = [
                    np.where(node >= 0, child[4 * node + 2 * ((rows[pair] >> shift) & 1) + half], -1)
                    for node, rows in ((left, a), (right, b))
                ]
                open_ = np.flatnonzero((down[0] >= 0) | (down[1] >= 0))  # the others are zero for both: priced already
                parts.append((pair[open_], down[0][open_], down[1][open_]))
            pair, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
        p, q = (np.where(node >= 0, self.value[node], zero[rows[pair]]) for node, rows in ((left, a), (right, b)))
        extra = np.abs(p - q) - np.abs(zero[a[pair]] - zero[b[pair]])
        return np.bincount(pair, extra, len(a)).astype(np.int64)  # whole numbers far below 2**53


def _found(lang: str, source: list, part: str, item: list, value: np.ndarray) -> pa.Table:
    n = len(value)
    columns = [pa.array(x, pa.string()) for x in ([lang] * n, source, [part] * n, item)]
    return pa.Table.from_arrays([*columns, pa.array(value, pa.int64())], names=["lang", "source", "part", "item", "value"])


def _audit_block(key: tuple, block: pa.Table) -> pa.Table:
    """The price of each pair of the block's sources in its terms, and the best terms of its sources."""
    lang, number, low, high = (x.as_py() for x in key)
    marker = pc.is_null(block["term"])
    names, cells = block.filter(marker), block.filter(pc.invert(marker))
    order = np.lexsort((names["row"].to_numpy(), names["piece"].to_numpy()))
    row_ids, piece, zero, terms = (names[c].to_numpy()[order] for c in ("row", "piece", "p", "terms"))
    source = names["source"].take(pa.array(order)).to_pylist()
    column = cells["term"].combine_chunks().dictionary_encode()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    by_id = np.argsort(row_ids)
    row = by_id[np.searchsorted(row_ids, cells["row"].to_numpy(), sorter=by_id)]
    value, lang_share = cells["p"].to_numpy(), cells["q"].to_numpy()
    depth = max(1, int(max(len(source), len(column.dictionary)) - 1).bit_length())
    tree = QuadTree(row.astype(np.int64), column.indices.to_numpy().astype(np.int64), value, depth)
    if low == high:
        a, b = np.triu_indices(len(source), 1)
    else:
        first, second = np.flatnonzero(piece == low), np.flatnonzero(piece == high)
        a, b = np.repeat(first, len(second)), np.tile(second, len(first))
    total = np.abs(zero[a] - zero[b]) * terms[a] if number == 0 else np.zeros(len(a), np.int64)
    for start in range(0, len(a), WALK_PAIRS):
        part = slice(start, start + WALK_PAIRS)
        total[part] += tree.excess(a[part], b[part], zero)
    found = [_found(lang, [source[i] for i in a], "pair", [source[i] for i in b], total)]
    if low == high:
        over = np.flatnonzero(value > lang_share)
        gap = (value - lang_share)[over]
        text = np.array([x.encode() for x in column.dictionary.to_pylist()], object)
        rank = np.empty(len(text), np.int64)
        rank[np.argsort(text)] = np.arange(len(text))
        column_of = column.indices.to_numpy()[over]
        best = np.lexsort((rank[column_of], -gap, row[over]))
        own = row[over][best]
        best = best[np.arange(len(own)) - np.searchsorted(own, own) < TOP_TERMS]
        word = [text[i].decode() for i in column_of[best]]
        found.append(_found(lang, [source[i] for i in row[over][best]], "term", word, gap[best]))
    return pa.concat_tables(found)


def divergence(documents: DataFrame, min_docs: int = MIN_DOCS, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source lies from every other source of
    its language (``pair``), and the terms it uses more than its language (``term``)."""
    of_term = Window.partitionBy("lang", "term")
    counted = written(term_counts(documents), "divergence-counts", free_shuffles=True)
    kept = counted.withColumns(
        {
            "held": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term),
            # each kept term is counted once, at its first source
            "leads": (F.col("source") == F.min("source").over(of_term)).cast("long"),
        }
    ).where(F.col("held") >= min_docs)
    cells = written(kept.select("lang", "source", "term", "n", "total", "leads"), "divergence-cells", free_shuffles=True)

    of_lang = Window.partitionBy("lang")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.sum("leads").alias("leads"))
    every = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = (
        every.join(sums, ["lang", "source"], "left")
        .fillna(0, ["group_total", "leads"])
        .withColumns(
            {
                "terms": F.sum("leads").over(of_lang), "lang_total": F.sum("group_total").over(of_lang),
                "row": F.row_number().over(of_lang.orderBy("source")) - 1, "sources": F.count(F.lit(1)).over(of_lang),
            }
        )
        .select(
            "lang", "source", "group_total", "lang_total", "terms", "row",
            F.floor(F.col("row") / block_sources).cast("int").alias("piece"),
            F.ceil(F.col("sources") / block_sources).cast("int").alias("pieces"),
            F.greatest(F.lit(1), F.ceil(F.col("terms") / block_terms)).cast("int").alias("blocks"),
        )
    )
    groups = written(groups, "divergence-groups", free_shuffles=True)
    terms, total = F.col("terms"), F.col("group_total")
    rows = cells.join(groups, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "row", "piece", "pieces",
        F.lit(None).cast("string").alias("source"), "term", share(F.col("n"), total, terms).alias("p"),
        share(F.col("total"), F.col("lang_total"), terms).alias("q"), "terms",
    )
    markers = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "row", "piece", "pieces", "source",
        F.lit(None).cast("string").alias("term"), F.coalesce(share(F.lit(0), total, terms), F.lit(0)).alias("p"),
        F.lit(0).cast("long").alias("q"), "terms",
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("partner")
    dealt = rows.unionByName(markers).select("*", partner).select(
        "lang", "block", F.least("piece", "partner").alias("low"), F.greatest("piece", "partner").alias("high"),
        "row", "piece", "source", "term", "p", "q", "terms",
    )
    found = dealt.groupBy("lang", "block", "low", "high").applyInArrow(_audit_block, FOUND)
    found = written(found, "divergence-found", free_shuffles=True)
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    best = found.where("part = 'term'").select("*", place).where(F.col("rank") <= TOP_TERMS)
    return both.select("*", place).unionByName(best)
