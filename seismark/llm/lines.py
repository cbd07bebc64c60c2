"""Line deduplication: equal lines by grouping, near lines by a segment-partition edit join.

Every line that holds more than ASCII white space takes part. Equal lines form a class whatever their
length. Classes are linked if their lines lie within an edit distance that grows with the length of the
shorter one: one edit per ``NEAR_CHARS`` characters, ``MAX_EDITS`` at most, so shorter lines must be equal.

A line is cut into one segment more than its allowed edits, so of two lines within the distance one
has a segment that is unchanged in the other. Segments go into an index by number, length of line
and content; a line probes the indexes of its own and the shorter lengths with the few substrings
that the position and length of a segment allow (the multi-match-aware choice). Pairs that meet
under a key are screened by a 64-bit parity signature of their characters (an edit flips at most two
bits) and verified with a banded bit-parallel edit distance over whole lines.

Copies of a line are one line of the join, so they cost no pairs. A key that many different lines
share (found on a sample, a bounded number of them) is split by parts of the signature: of
``2 * edits + 1`` parts one agrees in any pair, so the split loses nothing.

A line is removed if an equal line, or one of a linked class, occurs earlier: in a smaller document
(by id, null first, then by hash of the text), or above it in its document.

Edge cases: null, empty and blank texts have no lines; blank lines are never removed; rows equal in id
and text are one document, told by ``n_rows``, and keep the same lines; rows of one id, or without one,
that differ in text are documents of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismark.llm._bitmap import BITMAP_BITS, bitmap_of, sifted
from seismark.llm._spark import discard, numbered, renamed_back, small_batches, text_hash, written
from seismark.llm._text import WORD_BASE, keep_freed, mix, powers, ranges, signed, slices, utf8

MAX_EDITS = 2
#: Characters of a line for each edit that it allows.
NEAR_CHARS = 20
#: A key is hot from this share of the lines on, as far as a sample of one in ``SAMPLE`` tells.
HOT_SHARE = 2e-4
HOT_LINES = 100
SAMPLE = 50
#: What a line has at least on average, to tell the number of lines from the size of the texts.
LINE_CHARS = 40
PARTITION_ENTRIES = 1_000_000
VERIFIED_CHARS = 1 << 20
#: Classes with more lines are joined by broadcast; they are 1 / ``HOT_CLASS_SHARE`` at most.
HOT_CLASS_SHARE = 2e-4
HOT_CLASS_LINES = 1000

_inverse = np.ones(1, np.uint64)
#: Codes of the characters that most lines are made of.
_CODES = mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(77))


def codes(chars: np.ndarray) -> np.ndarray:
    """A scrambled 64-bit value for every character."""
    found = _CODES.take(chars, mode="clip")
    rare = np.flatnonzero(chars >= len(_CODES))
    found[rare] = mix(chars[rare].astype(np.uint64) + np.uint64(77))
    return found


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    while len(_inverse) < n:
        step = np.uint64(pow(int(WORD_BASE), -len(_inverse), 2**64))
        _inverse = np.concatenate([_inverse, _inverse * step])
    return _inverse[:n]


@dataclass
class Lines:
    """The lines of some rows that are not blank: row, number in the row, span in ``chars``."""

    chars: np.ndarray
    row: np.ndarray
    number: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Lines:
        chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        # a break inside a row ends a line and skips a character; a row's end only ends one
        end = np.sort(np.concatenate([2 * np.flatnonzero(chars == 10) + 1, 2 * at[1:]]))
        start = np.concatenate([[0], ((end + 1) // 2)[:-1]])
        row = np.concatenate([[0], np.cumsum(end % 2 == 0)[:-1]])
        number = np.arange(len(end)) - np.searchsorted(row, row)
        length = end // 2 - start
        inked = np.concatenate([[0], np.cumsum((chars != 32) & ((chars < 9) | (chars > 13)))])
        keep = inked[start + length] > inked[start]
        return cls(chars, row[keep], number[keep], start[keep], length[keep])

    def __post_init__(self) -> None:
        """Line hashes, and the characters' terms that the other values of a line are made of."""
        inner = ranges(np.zeros(len(self.start), np.int64), self.length)
        self.code = codes(self.chars[inner + np.repeat(self.start, self.length)])
        self.terms = self.code * powers(int(self.length.max(initial=1)))[inner]
        self.first = np.cumsum(self.length) - self.length
        self.low = self.hashed(self.terms)

    def hashed(self, terms: np.ndarray) -> np.ndarray:
        if not len(terms):
            return np.empty(0, np.uint64)
        return mix(np.add.reduceat(terms, self.first) + self.length.astype(np.uint64))

    @cached_property
    def high(self) -> np.ndarray:
        return self.hashed(mix(self.terms))

    @cached_property
    def signature(self) -> np.ndarray:
        if not len(self.code):
            return np.empty(0, np.uint64)
        return np.bitwise_xor.reduceat(np.uint64(1) << (self.code >> np.uint64(58)), self.first)

    @cached_property
    def sums(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.terms, dtype=np.uint64)])

    def substring(self, rows: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = self.first[rows] + start
        return (self.sums[at + length] - self.sums[at]) * inverse_powers(int(self.length.max()))[start]

    def text(self, i: int) -> str:
        return self.chars[self.start[i] : self.start[i] + self.length[i]].tobytes().decode("utf-32-le")


def allowed(length: np.ndarray, edits: int, near_chars: int) -> np.ndarray:
    """The edits that a line may be away from lines of its length or longer."""
    return np.minimum(edits, length // near_chars)


def entries(lines: Lines, edits: int, near_chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(line, key, whether it is an index entry): the segments of each line and its probes."""
    every = np.arange(len(lines.length))
    for most in range(1, edits + 1):  # of the edits that the indexed line allows
        parts = most + 1
        for shorter in range(most + 1):
            indexed = lines.length - shorter
            rows = every[(allowed(indexed, edits, near_chars) == most) & (indexed >= parts)]
            length = indexed[rows]
            for part in range(parts):
                longer = length % parts
                start = part * (length // parts) + np.maximum(0, part - (parts - longer))
                size = length // parts + (part >= parts - longer)
                low = max(-part, shorter - (most - part))
                high = min(part, shorter + (most - part))
                for shift in range(low, high + 1):
                    at = start + shift
                    fits = (at >= 0) & (at + size <= lines.length[rows])
                    own = rows[fits]
                    if not len(own):
                        continue
                    code = lines.substring(own, at[fits], size[fits])
                    name = (length[fits] * (edits + 1) + part).astype(np.uint64)
                    yield own, mix(code + mix(name)), shorter == 0 and shift == 0


ENTRY = "key long, line long, signature long, indexed boolean"


def entry_rows(documents: DataFrame, edits: int, near_chars: int, hot: np.ndarray) -> DataFrame:
    """Index entries and probes of the lines of all documents; hot keys are split by signature."""
    pieces = 2 * edits + 1
    bounds = np.linspace(0, 64, pieces + 1).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in slices(batches, "text"):
            lines = Lines.of(*utf8(batch.column("text")))
            _, first = np.unique(lines.low, return_index=True)  # copies within a slice are one line
            single = np.zeros(len(lines.low), bool)
            single[first] = True
            found = [(own[single[own]], key[single[own]], indexed) for own, key, indexed in entries(lines, edits, near_chars)]
            if not found:
                continue
            own, key = (np.concatenate(x) for x in list(zip(*found, strict=True))[:2])
            indexed = np.repeat([x[2] for x in found], [len(x[0]) for x in found])
            if len(hot):
                place = np.minimum(np.searchsorted(hot, signed(key)), len(hot) - 1)
                burning = hot[place] == signed(key)
                split = np.flatnonzero(burning)
                sign = lines.signature[own[split]]
                new = [
                    mix(key[split] ^ mix((sign << low) >> (low + np.uint64(64) - high) | np.uint64(i + 1) << np.uint64(56)))
                    for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
                ]
                key = np.concatenate([key[~burning], *new])
                indexed = np.concatenate([indexed[~burning], *[indexed[split]] * pieces])
                own = np.concatenate([own[~burning], *[own[split]] * pieces])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(signed(lines.low[own])), pa.array(signed(lines.signature[own])), pa.array(indexed)],
                names=["key", "line", "signature", "indexed"],
            )

    return documents.select("text").mapInArrow(run, ENTRY)


def candidate_pairs(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different lines of a task's keys whose signatures are close enough."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    key, line, sign = (table[c].to_numpy() for c in ("key", "line", "signature"))
    indexed = table["indexed"].to_numpy()
    order = np.lexsort((~indexed, line, key))
    key, line, sign, indexed = key[order], line[order], sign[order].view(np.uint64), indexed[order]
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (line[1:] != line[:-1])])
    key, line, sign, indexed = key[fresh], line[fresh], sign[fresh], indexed[fresh]
    at, gap = np.arange(len(key)), 1
    while len(at):
        at = at[at + gap < len(key)]
        at = at[key[at + gap] == key[at]]
        pair = at[(indexed[at] | indexed[at + gap]) & (np.bitwise_count(sign[at] ^ sign[at + gap]) <= 2 * edits)]
        if len(pair):
            yield pa.RecordBatch.from_arrays([pa.array(line[pair]), pa.array(line[pair + gap])], names=["a", "b"])
        gap += 1


def edit_distances(left: list[str], right: list[str], edits: int) -> np.ndarray:
    """Edit distance of each pair, or ``edits + 1`` if larger: a bit vector of the cells within
    ``edits`` of the diagonal moves down it one column at a time, for all pairs at once."""
    a_len, b_len = (np.array([len(t) for t in x], np.int64) for x in (left, right))
    result = np.full(len(left), edits + 1)
    fit = np.flatnonzero((np.abs(a_len - b_len) <= edits) & (np.minimum(a_len, b_len) > edits))
    tiny = np.flatnonzero(np.minimum(a_len, b_len) <= edits)
    for i in tiny.tolist():
        result[i] = min(edits + 1, plain_distance(left[i], right[i]))
    if not len(fit):
        return result
    a_len, b_len = a_len[fit], b_len[fit]
    width = int(max(a_len.max(), b_len.max())) + 2 * edits + 2
    a, b = np.zeros((len(fit), width), np.uint32), np.full((len(fit), width), 0xFFFFFFFF, np.uint32)
    for k, i in enumerate(fit.tolist()):  # row texts start behind ``edits`` blanks
        a[k, edits : edits + a_len[k]] = np.frombuffer(left[i].encode("utf-32-le"), np.uint32) + 1
        b[k, : b_len[k]] = np.frombuffer(right[i].encode("utf-32-le"), np.uint32) + 1
    one, top = np.uint64(1), 63
    plus = np.full(len(fit), (2**64 - 1) << (top - edits) & (2**64 - 1), np.uint64)
    minus, distance = np.zeros(len(fit), np.uint64), np.full(len(fit), edits)
    below = np.full(len(fit), np.uint64(1) << np.uint64(top - 1))
    for j in range(int(b_len.max())):
        match = np.zeros(len(fit), np.uint64)
        for r in range(2 * edits + 1):
            match |= (a[:, j + r] == b[:, j]).astype(np.uint64) << np.uint64(top - 2 * edits + r)
        zero = (((match & plus) + plus) ^ plus) | match | minus
        rise, fall = minus | ~(zero | plus), zero & plus
        live, diagonal = j < b_len, j < a_len - edits
        step = np.where(diagonal, 1 - (zero >> np.uint64(top)).astype(np.int64), ((rise & below) > 0).astype(np.int64) - ((fall & below) > 0))
        distance += np.where(live, step, 0)
        below = np.where(diagonal, below, below >> one)
        plus, minus = fall | ~((zero >> one) | rise), (zero >> one) & rise
    result[fit] = np.minimum(distance, edits + 1)
    return result


def plain_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def verify(batches: Iterator[pa.RecordBatch], edits: int, near_chars: int) -> Iterator[pa.RecordBatch]:
    """The pairs within the distance, checked in blocks of lines of about one length."""
    for batch in batches:
        left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        size = np.array([max(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64)
        limit = allowed(np.array([min(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64), edits, near_chars)
        order, end, good = np.argsort(size, kind="stable"), len(size), []
        while end:  # from the longest down, so a block is no wider than its first pair
            start = max(0, end - max(1, VERIFIED_CHARS // max(1, int(size[order[end - 1]]))))
            part = order[start:end]
            near = edit_distances([left[i] for i in part], [right[i] for i in part], edits) <= limit[part]
            good.append(part[near])
            end = start
        if good:
            kept = pa.array(np.sort(np.concatenate(good)))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(kept) for c in ("a", "b")], names=["a", "b"])


def near_lines(documents: DataFrame, edits: int = MAX_EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(a, b): all pairs of different lines within the distance, by line hash, each pair once."""
    none = np.empty(0, np.int64)
    sampled = entry_rows(documents.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0), edits, near_chars, none)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a line gives a bounded number of entries and one that gives any has near_chars: so many are hot at most
    often = max(HOT_LINES, HOT_SHARE * size / LINE_CHARS / SAMPLE)
    rows = sampled.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often).select("key").collect()
    hot = np.sort(np.array([r["key"] for r in rows], np.int64))
    found = entry_rows(documents, edits, near_chars, hot)
    partitions = 1 + int(size / LINE_CHARS / PARTITION_ENTRIES)
    pairs = found.repartition(partitions, "key").mapInArrow(lambda batches: candidate_pairs(batches, edits), "a long, b long")
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "lines-pairs", free_shuffles=True)
    wanted = pairs.select(F.col("a").alias("line")).unionByName(pairs.select(F.col("b").alias("line"))).distinct()
    # keeps most other lines out of the shuffle that the exact join needs
    shared = documents.sparkSession.sparkContext.broadcast(bitmap_of(wanted, "line"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in slices(batches, "text"):
            lines = Lines.of(*utf8(batch.column("text")))
            _, first = np.unique(lines.low, return_index=True)
            at = lines.low[first] >> np.uint64(64 - BITMAP_BITS)
            first = first[(shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(lines.low[first])), pa.array([lines.text(i) for i in first.tolist()], pa.string())], names=["line", "line_text"]
            )

    every = documents.select("text").mapInArrow(texts, "line long, line_text string")
    known = written(every.join(wanted, "line", "left_semi").dropDuplicates(["line"]), "lines-texts", free_shuffles=True)
    met = pairs.join(known.select(F.col("line").alias("a"), F.col("line_text").alias("left")), "a").join(
        known.select(F.col("line").alias("b"), F.col("line_text").alias("right")), "b"
    )
    close = met.select("a", "b", "left", "right").mapInArrow(lambda batches: verify(batches, edits, near_chars), "a long, b long")
    links = written(close, "lines-links", free_shuffles=True)
    discard(pairs)
    discard(known)
    return links


def line_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, number, line, high): the lines of each document, and number -1 for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in slices(batches, "text"):
            lines = Lines.of(*utf8(batch.column("text")))
            row = np.concatenate([np.arange(batch.num_rows), lines.row])
            blank = np.zeros(batch.num_rows, np.int64)
            values = [np.concatenate([blank - 1, lines.number]), np.concatenate([blank, signed(lines.low)]), np.concatenate([blank, signed(lines.high)])]
            columns = [batch.column(c).take(pa.array(row)) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, values)], names=["doc_id", "text_hash", "number", "line", "high"])

    return documents.mapInArrow(run, "doc_id long, text_hash long, number long, line long, high long")


def place() -> Column:
    """Where a line stands, in the order that says which is earlier."""
    return F.struct("doc_id", "text_hash", "number")


def line_classes(rows: DataFrame) -> DataFrame:
    """(line, high, first, n): the classes of equal lines, where each stands first, and how often."""
    own = rows.where("number >= 0")
    return own.groupBy("line", "high").agg(F.min(place()).alias("first"), F.count(F.lit(1)).alias("n"))


def linked_classes(documents: DataFrame, edits: int = MAX_EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(a, b, a_first, b_first): the pairs of linked classes, each once, by line hash, and the place
    (doc_id, text_hash, number) where each class stands first."""
    source = keyed(documents)
    classes = line_classes(line_rows(source))
    side = lambda c: classes.select(F.col("line").alias(c), F.col("first").alias(f"{c}_first"))
    return near_lines(source, edits, near_chars).join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_first", "b_first")


def decided_lines(rows: DataFrame, documents: DataFrame, edits: int, near_chars: int) -> DataFrame:
    """The lines that are not alone: of a class with several lines or with links. Each with where its
    class stands first, the links of the class, and whether an equal or a linked line is earlier."""
    first = written(line_classes(rows), "lines-classes", free_shuffles=True)
    links = near_lines(documents, edits, near_chars)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of_a = first.select(F.col("line").alias("a"), F.col("high").alias("a_high"), F.col("first").alias("a_first"))
    of_b = first.select(F.col("line").alias("b"), F.col("first").alias("b_first"))
    near = both.join(of_a, "a").join(of_b, "b").groupBy(F.col("a").alias("line"), F.col("a_high").alias("high")).agg(
        F.count(F.lit(1)).alias("links"), F.max(F.col("b_first") < F.col("a_first")).alias("near")
    )
    known = first.join(near, ["line", "high"], "left").where("n > 1 OR links IS NOT NULL")
    facts = written(known.fillna({"links": 0, "near": False}), "lines-facts", free_shuffles=True)
    discard(first)
    discard(links)
    # a line alone meets no fact and stays out of the shuffle; a class of many lines goes to them
    lines = facts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > max(HOT_CLASS_LINES, int(HOT_CLASS_SHARE * lines))
    kept = sifted(rows.where("number >= 0"), ("line", bitmap_of(facts, "line")))
    hot = F.broadcast(facts.where(often))
    met = kept.join(hot, ["line", "high"]).unionByName(
        kept.join(hot.select("line", "high"), ["line", "high"], "left_anti").join(facts.where(~often), ["line", "high"])
    )
    repeated = place() > F.col("first")
    return met.select("doc_id", "text_hash", "number", "line", "first", "links", "near", repeated.alias("repeated"))


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", text_hash("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))


def line_report(documents: DataFrame, edits: int = MAX_EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """One row per document: on how many rows it stands, its lines, repeats, near repeats, lines
    removed, and links of its lines to different ones. ``classes`` lists those of its lines that are not
    alone, by number, with their class (the line's hash), where it stands first, and its links."""
    small_batches(documents.sparkSession)
    source = keyed(documents)
    rows = written(line_rows(source), "lines-rows")
    count = lambda c: F.count(F.when(c, 1))
    keys = ["doc_id", "text_hash"]
    all_lines = rows.groupBy(*keys).agg(count(F.col("number") < 0).alias("n_rows"), count(F.col("number") >= 0).alias("n_all"))
    entry = F.struct(
        F.col("number").alias("line"), F.col("line").alias("class"), F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.number").alias("first_line"), "links", "repeated", "near",
    )
    # a set, as rows equal in id and text have the same lines
    found = decided_lines(rows, source, edits, near_chars).groupBy(*keys).agg(F.sort_array(F.collect_set(entry)).alias("classes"))
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_key"))
    met = all_lines.join(found, same, "left").withColumn("classes", F.coalesce("classes", F.array().cast(found.schema["classes"].dataType)))
    number = lambda test: F.size(F.filter("classes", test)).cast("long")
    return met.select(
        "doc_id", "n_rows", (F.col("n_all") / F.col("n_rows")).cast("long").alias("n_lines"),
        number(lambda x: x["repeated"]).alias("n_repeated"), number(lambda x: x["near"]).alias("n_near"),
        number(lambda x: x["repeated"] | x["near"]).alias("n_removed"),
        F.aggregate("classes", F.lit(0).cast("long"), lambda n, x: n + x["links"]).alias("n_links"), "classes",
    )


def without_repeats(documents: DataFrame, edits: int = MAX_EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """The documents without their removed lines; one that loses all its text is left out."""
    small_batches(documents.sparkSession)
    frame, names = numbered(documents)
    own, whole = F.col(names["doc_id"]), F.col(names["text"])
    plain = keyed(documents)
    rows = written(line_rows(plain), "lines-rows")
    decided = decided_lines(rows, plain, edits, near_chars).where("repeated OR near")
    gone = decided.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_key")).agg(F.collect_set("number").alias("_gone"))
    gone = written(gone, "lines-gone", free_shuffles=True)
    discard(rows)
    # texts that lose no line stay where they are
    source = frame.withColumn("_hash", text_hash(names["text"]))
    touched = bitmap_of(gone, "_key")
    alone = sifted(source, ("_hash", touched), met=False)
    met = sifted(source, ("_hash", touched)).join(gone, own.eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")), "left")
    kept = F.filter(F.split(whole, "\n", -1), lambda line, i: ~F.array_contains("_gone", i.cast("long")))
    untouched = F.col("_gone").isNull()
    text = F.when(untouched, whole).otherwise(F.array_join(kept, "\n"))
    cut = met.withColumn("_cut", text).where(untouched | F.col("_cut").rlike(r"[^\x09-\x0D ]"))
    values = {names["text"]: F.col("_cut")}
    if "n_chars" in names:
        values[names["n_chars"]] = F.when(untouched, F.col(names["n_chars"])).otherwise(F.length("_cut").cast(frame.schema[names["n_chars"]].dataType))
    return renamed_back(alone.select(*names.values()).unionByName(cut.withColumns(values).select(*names.values())), names)
