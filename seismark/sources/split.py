"""Large landed documents, cut between their features and read by many tasks.

A document of any layout is read as byte ranges. The text source cuts it at every ``{``, so that a
minified document falls into ranges as well; each range is scanned in order, in bulk, by its task.

1. Each range is summarised for both states it may start in, outside or inside a JSON string: how its
   quotes flip that state, how many brackets it closes that were opened before it, how many it
   leaves open, and the kinds of the lowest of these. Summaries combine, and a fold over the ranges of
   a file gives the state at the start of each. A backslash needs no state: a range starts with ``{``.
2. Knowing its state, a range tells the elements of the top-level arrays (cut at their commas) from
   the rest. The rest of all ranges, with the number of each run of elements in place of the
   elements, is the frame of the document: a small document that is parsed as a whole. It parses only
   if the document is complete, and it names the runs that belong to ``features``.
3. The elements of those runs are read and parsed. Elements that cross a range are put together
   from their parts.

Only frames, crossing elements and a state per range move between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.schema import CORRUPT, RAW_FEATURE, SOURCE, UNFINISHED
from seismark.session import work_folder
from seismark.shipping import ship_package

PIECE = "value string, source_file string, block long, file_bytes long"
CHUNK_BYTES = 1 << 18
#: Ranges whose states are broadcast at a time; of more ranges, files are taken in several parts.
RANGES_AT_ONCE = 1_000_000

_BRACE, _QUOTE, _BACKSLASH = b'{"\\'
_KIND = np.zeros(256, np.int8)
for _character, _step in ((b"{", 1), (b"[", 1), (b"}", -1), (b"]", -1), (b",", 2)):
    _KIND[_character[0]] = _step
#: Kinds of open brackets that a state keeps: the document and what is directly in it.
_KEPT = 2


def read_pieces(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """The text of every file between its opening braces, in order within a range."""
    reader = spark.readStream if streaming else spark.read
    text = reader.options(lineSep="{", recursiveFileLookup=True, **options).text(path)
    place = "_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size"
    return text.select("value", *(F.col(c).alias(n) for c, n in zip(place, ("source_file", "block", "file_bytes"), strict=True)))


class Shape(NamedTuple):
    """Brackets of a stretch: closed ones that it did not open, open ones left, their lowest kinds."""

    closes: int = 0
    opens: int = 0
    kinds: bytes = b""

    def then(self, other: Shape) -> Shape:
        if other.closes > self.opens:
            return Shape(self.closes + other.closes - self.opens, other.opens, other.kinds)
        left = self.opens - other.closes
        return Shape(self.closes, left + other.opens, (self.kinds[:left] + other.kinds)[:_KEPT])


class Summary(NamedTuple):
    """What a stretch does to the state: by its start outside (0) or inside (1) a string."""

    flips: bool = False
    shapes: tuple[Shape, Shape] = (Shape(), Shape())

    def then(self, other: Summary) -> Summary:
        shapes = tuple(shape.then(other.shapes[start ^ self.flips]) for start, shape in enumerate(self.shapes))
        return Summary(self.flips ^ other.flips, shapes)


def quotes_of(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that open or close a string."""
    quotes, slashes = np.flatnonzero(data == _QUOTE), np.flatnonzero(data == _BACKSLASH)
    if not len(slashes):
        return quotes
    first = np.flatnonzero(np.concatenate([[True], np.diff(slashes) != 1]))
    run = np.diff(np.append(first, len(slashes)))
    escaped = (slashes[first] + run)[run % 2 == 1]
    return quotes[~np.isin(quotes, escaped)]


def marks_of(data: np.ndarray, quotes: np.ndarray, inside: int) -> np.ndarray:
    """Places of the brackets and commas outside strings."""
    marks = np.flatnonzero(_KIND[data])
    return marks[(np.searchsorted(quotes, marks) + inside) % 2 == 0]


def shape_of(data: np.ndarray, quotes: np.ndarray, inside: int) -> Shape:
    marks = marks_of(data, quotes, inside)
    brackets = data[marks[_KIND[data[marks]] != 2]]
    if not len(brackets):
        return Shape()
    level = np.concatenate([[0], np.cumsum(_KIND[brackets], dtype=np.int64)])
    low, kinds = int(level.min()), []
    for height in range(low, min(low + _KEPT, int(level[-1]))):  # opened last above this level, and left open
        last = len(level) - 1 - int(np.argmax(level[::-1] == height))
        kinds.append(int(brackets[last]))
    return Shape(-low, int(level[-1]) - low, bytes(kinds))


def ranges_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bool, np.ndarray]]:
    """(file, block, file bytes, whether the range begins here, text) of each stretch of a range."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("value").fill_null("").cast(pa.large_binary())
        files, blocks = batch.column("source_file").dictionary_encode(), batch.column("block").to_numpy()
        file_at = files.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(file_at) != 0)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            part = text.slice(start, stop - start)
            _, offsets, data = part.buffers()
            at = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
            raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
            key = files.dictionary[file_at[start]].as_py(), int(blocks[start])
            begins = key != before
            opened = at[1 if begins and key[1] == 0 else 0 : -1] - at[0]  # nothing stands before the first piece of a file
            yield *key, batch.column("file_bytes")[start].as_py(), begins, np.insert(raw, opened, _BRACE)
            before = key


_SUMMARY = "source_file string, block long, flips int, " + ", ".join(
    f"closes{s} long, opens{s} long, kinds{s} binary" for s in (0, 1)
)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SUMMARY.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in _SUMMARY.split(", ")]

    def row(key, found: Summary):
        values = [*key, int(found.flips), *found.shapes[0], *found.shapes[1]]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    key, found = None, Summary()
    for file, block, _, begins, data in ranges_in(batches):
        if begins:
            if key:
                yield row(key, found)
            key, found = (file, block), Summary()
        quotes = quotes_of(data)
        here = Summary(bool(len(quotes) % 2), (shape_of(data, quotes, 0), shape_of(data, quotes, 1)))
        found = found.then(here)
    if key:
        yield row(key, found)


def _fold(summaries: pa.Table) -> pa.Table:
    """The state at the start of each range of a file: one row a range, in one task a file."""
    now, rows = Summary(), []
    for r in sorted(summaries.to_pylist(), key=lambda r: r["block"]):
        rows.append((r["source_file"], r["block"], int(now.flips), now.shapes[0].opens, now.shapes[0].kinds))
        shapes = tuple(Shape(r[f"closes{s}"], r[f"opens{s}"], r[f"kinds{s}"]) for s in (0, 1))
        now = now.then(Summary(bool(r["flips"]), shapes))
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["source_file", "block", "inside", "depth", "kinds"])


class Part(NamedTuple):
    """A stretch of a document: of its frame, or of the elements of a run."""

    role: str  # frame | whole | tail | middle | head
    run: int | None
    opens: bool  # starts behind the opening bracket of its array
    ends: bool  # stops at the closing one
    text: bytes


class RangeWalk:
    """Tells elements from frame in a range whose start state is known."""

    def __init__(self, block: int, inside: int, depth: int, kinds: bytes):
        self.inside, self.depth, self.kinds = inside, depth, kinds
        self.next_run, self.run = block, None
        self.pending: list[bytes] = []
        self.opens = self.crossing = False
        self.frame: list[bytes] = []
        if depth > 1 and kinds == b"{[":
            self._start_run(b", ")
            self.crossing = True

    def _start_run(self, before: bytes) -> None:
        self.run, self.next_run = self.next_run, self.next_run + 1
        self.frame.append(before + str(self.run).encode())

    def _element(self, text: bytes, ends: bool) -> Part:
        part = Part("head" if self.crossing else "whole", self.run, self.opens, ends, b"".join([*self.pending, text]))
        self.pending, self.opens, self.crossing = [], False, False
        return part

    def feed(self, data: np.ndarray) -> Iterator[Part]:
        raw = data.tobytes()
        quotes = quotes_of(data)
        marks = marks_of(data, quotes, self.inside)
        self.inside = (self.inside + len(quotes)) % 2
        character = data[marks]
        step = np.where(_KIND[character] == 2, 0, _KIND[character]).astype(np.int64)
        after = self.depth + np.cumsum(step)
        before = after - step
        commas = marks[(_KIND[character] == 2) & (before == 2)]
        at = 0
        edges = np.flatnonzero(((step > 0) & (before <= 1)) | ((step < 0) & (after <= 1)))
        for i in edges.tolist():
            place, kind = int(marks[i]), bytes([character[i]])
            if step[i] > 0:
                self.kinds = self.kinds[: int(before[i])] + kind
                if self.kinds == b"{[" and self.run is None:
                    self.frame.append(raw[at : place + 1])
                    self._start_run(b"")
                    self.opens, at = True, place + 1
            else:
                self.kinds = self.kinds[: max(int(after[i]), 0)]
                if self.run is not None:
                    yield from self._cut(raw, at, commas[(commas >= at) & (commas < place)])
                    yield self._element(raw[self.cut : place], True)
                    self.run, at = None, place
        if self.run is None:
            self.frame.append(raw[at:])
        else:
            yield from self._cut(raw, at, commas[commas >= at])
            self.pending.append(raw[self.cut :])
        self.depth = int(after[-1]) if len(after) else self.depth

    def _cut(self, raw: bytes, at: int, commas: np.ndarray) -> Iterator[Part]:
        """Elements up to the last comma, in chunks; ``cut`` is where the next one starts."""
        while len(commas):
            own = self.pending or self.crossing  # the first element completes what is pending, alone
            stop = int(commas[0 if own else max(int(np.searchsorted(commas, at + CHUNK_BYTES, "right")) - 1, 0)])
            yield self._element(raw[at:stop], False)
            at, commas = stop + 1, commas[commas > stop]
        self.cut = at

    def finish(self) -> Iterator[Part]:
        if self.run is not None:
            yield Part("middle" if self.crossing else "tail", self.run, self.opens, False, b"".join(self.pending))
        yield Part("frame", None, False, False, b"".join(self.frame))


States = dict[str, dict[int, tuple[int, int, bytes, frozenset]]]


def parts_of(batches: Iterator[pa.RecordBatch], states: States) -> Iterator[tuple[str, int, int, int, Part]]:
    """(file, block, file bytes, bytes of the range so far, part); files without a state are left out."""
    walk, size, place = None, 0, None
    for file, block, file_bytes, begins, data in ranges_in(batches):
        if begins:
            if walk:
                for part in walk.finish():
                    yield *place, size, part
            known = states.get(file, {}).get(block)
            walk, size, place = RangeWalk(block, *known[:3]) if known else None, 0, (file, block, file_bytes)
        if walk:
            size += len(data)
            for part in walk.feed(data):
                yield *place, size, part
    if walk:
        for part in walk.finish():
            yield *place, size, part


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


_OUTLINE = "source_file string, block long, seq int, file_bytes long, size long, role string, run long, opens boolean, ends boolean, text binary"
_ELEMENTS = "source_file string, run long, opens boolean, ends boolean, text binary"


def _element_text(opens: str = "opens", ends: str = "ends", text: str = "text"):
    """The elements as the text of an array; a lone blank between brackets is none, any other is an error."""
    content = F.col(text).cast("string")
    blank = F.trim(F.translate(content, "\t\r\n", "   ")) == ""
    inner = F.when(~blank, content).when(F.col(opens) & F.col(ends), F.lit("")).otherwise(F.lit(","))
    return F.concat(F.lit("["), inner, F.lit("]"))


def split_documents_of(pieces: DataFrame, feature: T.DataType = RAW_FEATURE) -> DataFrame:
    """The features of all complete documents among the pieces, a row for each bit of a document, and
    a row with its frame for each document that is not complete."""
    spark = pieces.sparkSession
    ship_package(spark)
    states = _written(pieces.mapInArrow(_summarise, _SUMMARY).groupBy("source_file").applyInArrow(_fold, "source_file string, block long, inside int, depth long, kinds binary"))
    parts = 1 + states.count() // RANGES_AT_ONCE
    of_part = F.pmod(F.xxhash64("source_file"), F.lit(parts))
    return reduce(DataFrame.unionByName, [_part(spark, pieces.where(of_part == i) if parts > 1 else pieces, states.where(of_part == i), feature) for i in range(parts)])


def _written(frame: DataFrame) -> DataFrame:
    path = work_folder(frame.sparkSession, "split")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _part(spark: SparkSession, pieces: DataFrame, states: DataFrame, feature: T.DataType) -> DataFrame:
    known: States = {}
    for r in states.collect():  # at most RANGES_AT_ONCE rows
        known.setdefault(r["source_file"], {})[r["block"]] = (r["inside"], r["depth"], bytes(r["kinds"]), frozenset())
    shared = spark.sparkContext.broadcast(known)

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, (file, block, file_bytes, size, part) in enumerate(parts_of(batches, shared.value)):
            if part.role != "whole":
                yield _batch([(file, block, seq, file_bytes, size, *part)], _OUTLINE)

    drawn = _written(pieces.mapInArrow(outline, _OUTLINE))
    in_order = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", F.col("text").cast("string").alias("text")))), lambda x: x.text), "")
    # the text source drops a brace at the very end of a file: its size tells
    lost = F.when(F.sum("size") == F.first("file_bytes") - 1, F.lit("{")).otherwise(F.lit(""))
    frames = drawn.where("role = 'frame'").groupBy("source_file").agg(F.concat(in_order, lost).alias("frame"))
    outer = T.StructType([T.StructField("features", T.ArrayType(T.LongType())), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("frame", outer, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    judged = _written(frames.where(F.trim("frame") != "").select("source_file", "frame", parsed.alias("outer")).select("source_file", "frame", "outer.*"))
    runs = judged.where(F.col(CORRUPT).isNull()).select("source_file", F.explode("features").alias("run"))

    wanted: dict[str, set[int]] = {}
    for r in runs.collect():  # one row a range, or a few
        wanted.setdefault(r["source_file"], set()).add(r["run"])
    picked = spark.sparkContext.broadcast({file: (known[file], frozenset(own)) for file, own in wanted.items()})

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = {file: own for file, (own, _) in picked.value.items()}
        for file, _, _, _, part in parts_of(batches, states):
            if part.role == "whole" and part.run in picked.value[file][1]:
                yield _batch([(file, *part[1:])], _ELEMENTS)

    whole = pieces.mapInArrow(elements, _ELEMENTS).select("source_file", _element_text().alias("elements"))
    crossing = Window.partitionBy("source_file").orderBy("block", "seq")
    numbered = drawn.where("role <> 'frame'").withColumn("element", F.sum((F.col("role") == "tail").cast("int")).over(crossing))
    joined = numbered.groupBy("source_file", "element").agg(
        in_order.alias("text"), F.min_by("run", F.struct("block", "seq")).alias("run"),
        F.min_by("opens", F.struct("block", "seq")).alias("opens"), F.max_by("ends", F.struct("block", "seq")).alias("ends"),
    )
    joined = joined.join(runs, ["source_file", "run"], "left_semi").select("source_file", _element_text().alias("elements"))
    read = whole.unionByName(joined).withColumn("features", F.from_json("elements", T.ArrayType(feature)))
    bits = read.select("features", F.when(F.col("features").isNull(), F.col("elements")).alias(CORRUPT), SOURCE, F.lit(False).alias(UNFINISHED))
    none = F.lit(None).cast(T.ArrayType(feature)).alias("features")
    broken = judged.where(F.col(CORRUPT).isNotNull()).select(none, F.col("frame").alias(CORRUPT), SOURCE, F.lit(True).alias(UNFINISHED))
    return bits.unionByName(broken)


def read_landing_split(
    spark: SparkSession, path: str, feature: T.DataType = RAW_FEATURE, streaming: bool = False, **options
) -> DataFrame:
    """Large documents of any layout, read in pieces; the columns of the other readers, the file, and
    whether its document is unfinished.

    A row holds the features of one piece of a document, or in ``_corrupt_record`` what did not
    parse: a piece whose features are lost, or the frame of a document that is not complete, which
    gives no features at all. A stream gives the pieces of landed files; ``of_batch`` turns a batch of
    them into documents.
    """
    pieces = read_pieces(spark, path, streaming, **options)
    return pieces if streaming else split_documents_of(pieces, feature)


read_landing_split.of_batch = split_documents_of
