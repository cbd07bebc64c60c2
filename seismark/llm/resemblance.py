"""Groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, exact.

Texts meet first by SimHash: fingerprints of their five-word shingles, linked by the vantage-point
trees of :mod:`simhash`. Fingerprints tell near copies without a shared key but not all of them, and
what they bring together is decided on the shingles like any other pair. The rest meets by shingles.

Of two sets that similar, the first shingles of both, one in five and one more in an order that
holds for all texts, share one (the prefix filter), so texts meet under those only and no pair is
lost. The order is by hash, with shingles that a sample shows to be common behind all others, which
keeps boilerplate from bringing unlike texts together. From what a pair's first common shingle leaves
of both texts, those too far down the order to be similar are told at once. Pairs that meet are screened by number of
shingles and by a parity sketch of a bit per shingle (a differing shingle flips one bit at most), both
without loss, and then decided on the shingles of both texts.

A large group is joined by stars first: the texts of linked fingerprints, then those of each
shingle, meet a few centres. Only texts that are still apart then meet pairwise, so near copies cost rows per member and not per pair.
Before that, shingles that would bring a text together with many others on average, however few of
all texts that is, go behind the rarer ones too, and the first shingles are taken again in that order.

Edge cases: words are cut at ASCII white space and lower-cased in ASCII; a text of less than five
words is one shingle; null and blank texts are equal; equal texts take part once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.llm import simhash
from seismark.llm._bitmap import bitmap_of, sifted
from seismark.llm._spark import components, discard, one_of_each, small_batches, text_hash, written
from seismark.llm._text import LOWER, NOT_SPACE, mix, ranges, sequence_hashes, signed, slices, utf8, word_hashes, word_spans

SHINGLE_WORDS = 5
#: Least similarity, as a fraction of whole numbers.
PART, WHOLE = 4, 5
SAMPLE = 16
HOT_SHARE = 1e-3
HOT_TEXTS = 4
SKETCH_BITS = 10
STAR_ROUNDS = 2
CENTRES = 3
#: Open pairs a text, on average, from which a shingle is crowded. While such pairs are more than one in so
#: many entries, their shingles go behind the others, a few times at most and so many shingles at a time (an
#: even share, if there are more; what stays costs pairs only).
CROWD = 2
ENTRIES_A_PAIR = 4
REORDERS = 3
MOVED_AT_ONCE = 1_000_000
PARTITION_ENTRIES = 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, in that order."""
    data = LOWER[data]
    starts, ends, at = word_spans(data, offsets, NOT_SPACE)
    words, hashes = np.diff(at), word_hashes(data, starts, ends)
    rows = np.arange(len(words))
    row, value = [rows[words == 0]], [np.zeros(int((words == 0).sum()), np.uint64)]
    for k in range(1, width + 1):
        own = rows[words == k] if k < width else rows[words >= k]
        if len(own):
            count = words[own] - k + 1
            row.append(np.repeat(own, count))
            value.append(sequence_hashes(hashes, k)[ranges(at[own], count)])
    row, value = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that many texts of a sample hold, and their ranks by frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(signed(shingle_sets(*utf8(batch.column("text")))[1]))], names=["key"])

    sample = texts.where(F.pmod("text_hash", F.lit(SAMPLE)) == 0)
    often = max(HOT_TEXTS, HOT_SHARE * sample.count())
    rows = sample.select("text").mapInArrow(run, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often).toArrow()
    hot, count = rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    rank = np.empty(len(hot), np.uint64)
    rank[np.lexsort((hot, count))] = np.arange(len(hot), dtype=np.uint64)
    order = np.argsort(hot)
    return hot[order], rank[order]


ENTRY = ["key", "node", "size", "place"]


def prefix_rows(texts: DataFrame, late: np.ndarray | None = None) -> DataFrame:
    """(key, node, size, place): the first shingles of every text, how many it has, and those before.

    The shingles ``late``, in their order, come behind all others but the common ones.
    """
    hot, rank = common_shingles(texts)
    if late is not None:
        late = late.view(np.uint64)
        late = late[~np.isin(late, hot)]
        hot, rank = np.concatenate([late, hot]), np.concatenate([np.arange(len(late), dtype=np.uint64), rank + np.uint64(len(late))])
        order = np.argsort(hot)
        hot, rank = hot[order], rank[order]
    shared = texts.sparkSession.sparkContext.broadcast((hot, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = shared.value
        for batch in slices(batches, "text"):
            row, value = shingle_sets(*utf8(batch.column("text")))
            place = value >> np.uint64(1)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
                place = np.where(hot[at] == value, rank[at] | np.uint64(1 << 63), place)
            order = np.lexsort((value, place, row))
            size = np.bincount(row, minlength=batch.num_rows)
            inner = ranges(np.zeros(len(size), np.int64), size)
            keep = inner < (size - -(-size * PART // WHOLE) + 1)[row]
            own = row[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(value[order][keep])), batch.column("text_hash").take(pa.array(own)), pa.array(size[own]), pa.array(inner[keep])],
                names=ENTRY,
            )

    return texts.select("text_hash", "text").mapInArrow(run, ", ".join(f"{c} long" for c in ENTRY))


def by_key(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray] | None:
    """Columns of a task's rows, sorted by key, without the keys that stand once."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return None
    table = pa.Table.from_batches(rows)
    columns = [table[c].to_numpy() for c in names]
    order = np.lexsort((columns[1], columns[0]))
    key = columns[0][order]
    same = key[1:] == key[:-1]
    again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    order = order[again]
    return [c[order] for c in columns] if len(order) else None


def met_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = by_key(batches, *ENTRY)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=ENTRY)


def pair_rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def star_pairs(batches: Iterator[pa.RecordBatch], salts: range) -> Iterator[pa.RecordBatch]:
    """Each text with a few centres of each of its keys, unless they are joined already."""
    found = by_key(batches, "key", "node", "size", "component")
    if not found:
        return
    key, node, size, component = found
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(first, len(key)))
    for salt in salts:
        draw = mix(node.view(np.uint64) ^ mix(np.full(1, salt + 1, np.uint64)))
        centre = np.repeat(np.lexsort((draw, key))[first], count)
        fits = (component[centre] != component) & (WHOLE * np.minimum(size, size[centre]) >= PART * np.maximum(size, size[centre]))
        yield pair_rows(node[fits], node[centre[fits]])


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where the groups of equal rows begin; the rows of one lie together."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(fresh)


def open_rows(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...] | None:
    """(key, node, size, place, component, limit) by key and size, without the keys of one component.

    A text is similar to one that is no smaller, if the key is the first they share, only up to the
    size ``limit``: of both together PART of (WHOLE + PART) of the shingles are in both at least.
    """
    found = by_key(batches, *ENTRY, "component")
    if not found:
        return None
    key, _, size, place, component = found
    first = group_starts(key)
    several = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
    order = np.lexsort((size, key))
    order = order[np.repeat(several, np.diff(np.append(first, len(key))))]
    key, node, size, place, component = (c[order] for c in found)
    limit = np.minimum(size * WHOLE // PART, (size - place) * (WHOLE + PART) // PART - size)
    return (key, node, size, place, component, limit) if len(key) else None


def crowded_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, pairs): the keys under which many pairs of a text are open, and how many at most."""
    found = open_rows(batches)
    if not found:
        return
    key, _, size, _, component, limit = found
    first = group_starts(key)
    count = np.diff(np.append(first, len(key)))
    # pairs of texts that are not joined yet
    order = np.lexsort((component, key))
    joined = group_starts(key[order], component[order])
    members = np.diff(np.append(joined, len(key)))
    apart = count * (count - 1) // 2 - np.add.reduceat(members * (members - 1) // 2, np.searchsorted(joined, first))
    # pairs whose sizes fit
    most = int(size.max())
    above = np.repeat(np.arange(len(first)) * (most + 1), count)
    reached = np.searchsorted(above + size, above + np.minimum(limit, most), "right")
    fitting = np.add.reduceat(np.maximum(reached - 1 - np.arange(len(key)), 0), first)
    pairs = np.minimum(apart, fitting)
    many = pairs > CROWD * count
    yield pa.RecordBatch.from_arrays([pa.array(key[first][many]), pa.array(pairs[many])], names=["key", "pairs"])


def open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of texts under a key that are not joined yet, whose sizes fit, and that may be
    similar if the key is the first they share."""
    found = open_rows(batches)
    if not found:
        return
    key, node, size, place, component, limit = found
    edges = np.append(group_starts(key), len(key))
    last = np.repeat(edges[1:], np.diff(edges))
    at, gap, rest = np.arange(len(key)), 1, size - place
    # by size, the fitting partners of a text are the rows right behind it
    while len(at):
        at = at[at + gap < last[at]]
        at = at[limit[at] >= size[at + gap]]
        shared = (WHOLE + PART) * rest[at + gap] >= PART * (size[at] + size[at + gap])
        apart = at[shared & (component[at] != component[at + gap])]
        if len(apart):
            yield pair_rows(node[apart], node[apart + gap])
        gap += 1


def sketches_of(row: np.ndarray, value: np.ndarray, n: int) -> list[bytes]:
    """A bit per shingle or more for each of ``n`` texts: the parity of its shingles by their last bits."""
    size = np.bincount(row, minlength=n)
    bits = np.maximum(SKETCH_BITS, np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    edges = np.concatenate([[0], np.cumsum(1 << bits)])
    place = edges[row] + (value & ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1))[row]).astype(np.int64)
    packed = np.packbits((np.bincount(place, minlength=edges[-1]) & 1).astype(bool)).tobytes()
    return [packed[start // 8 : stop // 8] for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def sketch_rows(texts: DataFrame) -> DataFrame:
    """(node, size, code, sketch) of every text; the code is its SimHash fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                row, value = shingle_sets(*utf8(part.column("text")))
                sketch, size = sketches_of(row, value, part.num_rows), np.bincount(row, minlength=part.num_rows)
                code = signed(simhash.text_fingerprints(*utf8(part.column("text")), SHINGLE_WORDS))
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_hash"), pa.array(size), pa.array(code), pa.array(sketch, pa.binary())], names=["node", "size", "code", "sketch"]
                )

    return texts.select("text_hash", "text").mapInArrow(run, "node long, size long, code long, sketch binary")


def fingerprint_rows(sketches: DataFrame) -> DataFrame:
    """(key, node, size): every text under the group that links of fingerprints make of its own."""
    codes = written(sketches.select("code").distinct(), "resemblance-codes", free_shuffles=True)
    linked = components(simhash.near_duplicate_links(codes), "resemblance-fingerprints", free=True).withColumnRenamed("node", "code")
    grouped = sketches.select("node", "size", "code").join(linked, "code", "left")
    return grouped.select(F.coalesce("component", "code").alias("key"), "node", "size")


def sketch_distance(left: bytes, right: bytes) -> int:
    """Differing bits; the longer sketch is folded to the length of the shorter first."""
    short, long = (np.frombuffer(x, np.uint64) for x in sorted((left, right), key=len))
    while len(long) > len(short):
        long = long[: len(long) // 2] ^ long[len(long) // 2 :]
    return int(np.bitwise_count(short ^ long).sum(dtype=np.int64))


def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that may still be similar by their sketches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        pairs = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)
        differing = np.array([sketch_distance(*pair) for pair in pairs], np.int64)
        # similar sets of n shingles together differ in (WHOLE - PART) / (WHOLE + PART) of n at most
        kept = pa.array(np.flatnonzero((WHOLE + PART) * differing <= (WHOLE - PART) * batch.column("sizes").to_numpy()))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(kept) for c in ("a", "b")], names=["a", "b"])


def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose shingle sets are similar."""
    for batch in slices(batches, "left"):
        n = batch.num_rows
        sides = [shingle_sets(*utf8(batch.column(c))) for c in ("left", "right")]
        row, value = (np.concatenate(x) for x in zip(*sides, strict=True))
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        both = np.bincount(row[1:][(row[1:] == row[:-1]) & (value[1:] == value[:-1])], minlength=n)
        kept = pa.array(np.flatnonzero(WHOLE * both >= PART * (np.bincount(row, minlength=n) - both)))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(kept) for c in ("a", "b")], names=["a", "b"])


def similar_pairs(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts that are similar, each once."""
    pairs = written(pairs.where("a <> b").distinct(), "resemblance-pairs", free_shuffles=True)
    side = lambda c, name, value: sketches.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col(value).alias(name))
    met = pairs.join(side("a", "left", "sketch"), "a").join(side("b", "right", "sketch"), "b")
    close = written(
        met.select("a", "b", "left", "right", (F.col("a_size") + F.col("b_size")).alias("sizes")).mapInArrow(screen, "a long, b long"),
        "resemblance-close", free_shuffles=True,
    )
    # of the texts only those that a pair names move
    wanted = close.select(F.col("a").alias("text_hash")).unionByName(close.select(F.col("b").alias("text_hash"))).distinct()
    named = sifted(texts.select("text_hash", "text"), ("text_hash", bitmap_of(wanted, "text_hash"))).join(wanted, "text_hash", "left_semi")
    text = lambda c, name: named.select(F.col("text_hash").alias(c), F.col("text").alias(name))
    whole = close.join(text("a", "left"), "a").join(text("b", "right"), "b").select("a", "b", "left", "right")
    links = written(whole.mapInArrow(decide, "a long, b long"), "resemblance-links", free_shuffles=True)
    discard(pairs)
    discard(close)
    return links


def similar_groups(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """(text_hash, component) of every distinct text."""
    small_batches(documents.sparkSession)
    source = documents.select(text_hash(text_column).alias("text_hash"), F.coalesce(text_column, F.lit("")).alias("text"))
    # a text that stands once needs no comparison to be told from its copies, and stays where it is
    often = bitmap_of(source.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "text_hash")
    once = sifted(source, ("text_hash", often), met=False)
    copies = sifted(source, ("text_hash", often)).dropDuplicates(["text_hash"])
    texts = written(once.unionByName(copies), "resemblance-texts", free_shuffles=True)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = 1 + int(size / 25 / PARTITION_ENTRIES)  # words of five letters, one in five a key
    sketches = written(sketch_rows(texts), "resemblance-sketches")

    def entries_of(rows: DataFrame) -> DataFrame:
        met = rows.repartition(partitions, "key").mapInArrow(met_again, ", ".join(f"{c} long" for c in ENTRY))
        return written(met, "resemblance-entries", free_shuffles=True)

    def with_components(rows: DataFrame, joined: DataFrame) -> DataFrame:
        rows = rows.join(joined, "node", "left").select(*ENTRY, F.coalesce("component", "node").alias("component"))
        return rows.repartition(partitions, "key")

    def joined_by(links: DataFrame) -> DataFrame:
        return written(components(links, "resemblance-components", free=True), "resemblance-joined", free_shuffles=True)

    entries, links, joined = entries_of(prefix_rows(texts)), None, None
    for number in range(STAR_ROUNDS + 1):  # the first by fingerprints
        if joined:
            rows = with_components(entries, joined)
        else:
            rows = fingerprint_rows(sketches).withColumn("component", F.col("node")).repartition(partitions, "key")
        salts = range(CENTRES * number, CENTRES * number + CENTRES)
        pairs = rows.mapInArrow(lambda batches, salts=salts: star_pairs(batches, salts), "a long, b long")
        found = similar_pairs(pairs, texts, sketches)
        links = links.unionByName(found) if links else found
        joined = joined_by(links)
    late = np.empty(0, np.int64)
    for _ in range(REORDERS):
        rows = with_components(entries, joined).mapInArrow(crowded_keys, "key long, pairs long")
        crowded = written(rows, "resemblance-crowded", free_shuffles=True)
        n, met = crowded.agg(F.count("key"), F.sum("pairs")).first()
        if ENTRIES_A_PAIR * (met or 0) <= entries.count():
            break
        moved = crowded.where(F.pmod("key", F.lit(-(-n // MOVED_AT_ONCE))) == 0).toArrow()
        key, often = moved["key"].to_numpy(), moved["pairs"].to_numpy()
        key = key[np.lexsort((key, often))]
        discard(crowded)
        fresh = key[~np.isin(key, late)]
        if not len(fresh):
            break
        discard(entries)
        late = np.concatenate([fresh, late])
        entries = entries_of(prefix_rows(texts, late))
    pairs = with_components(entries, joined).mapInArrow(open_pairs, "a long, b long")
    joined = joined_by(links.unionByName(similar_pairs(pairs, texts, sketches)))
    named = texts.select("text_hash").join(joined.withColumnRenamed("node", "text_hash"), "text_hash", "left")
    groups = named.select("text_hash", F.coalesce("component", "text_hash").alias("component"))
    groups = written(groups, "resemblance-groups", free_shuffles=True)
    for table in (texts, entries, sketches):
        discard(table)
    return groups


def keep_one_of_each_group(documents: DataFrame) -> DataFrame:
    """One row of each group, the first by id and text; a group whose ids are all null keeps one too."""
    return one_of_each(documents, similar_groups(documents))
