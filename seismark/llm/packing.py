"""Packing of tokenised documents into sequences of fixed length, best fit decreasing.

Tokenising is a narrow step over the scanned rows. Documents longer than a window are cut into
full windows and a rest. The pieces, a few numbers each, are dealt to buckets by a hash of their
place in the scan, so neither a hot key nor a long document meets in one bucket; the number of
buckets follows the bytes of text. Each bucket is packed on its own, which leaves at most a few
open windows a bucket, a small part of its thousands.

Edge cases: a null or empty text is a document of the end id alone; repeated rows are packed once
each; an empty table gives no rows; a null id is carried through; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.llm._text import LOWER, byte_class, mix, ranges, slices, utf8, word_hashes, word_spans

WINDOW = 2048
END_ID = 1
#: Text of one bucket; about eight million tokens, four thousand windows.
BUCKET_BYTES = 32 << 20
#: Chunks of text whose ids a Python worker keeps, some 40 bytes each; the table starts anew when it is full.
CACHED_CHUNKS = 1_000_000

_CHUNKS_A_LINE = 2000

#: Bytes below U+0180 but for most controls: there text is normalised by lower-casing and cut at
#: blanks exactly as the tokenizer does it. A row with another byte, an odd space, a dotted capital
#: I or the opening of a special token goes to the tokenizer whole.
_ODD = byte_class(lambda b: b < 32 and b not in b"\t\n\r" or b == 127 or b >= 0xC6)
_MARK = byte_class(lambda b: b in b".,;:!?")
_CHUNK = byte_class(lambda b: b not in b" \t\n\r")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class SegmentTree:
    """Open windows by remaining capacity; finds the tightest one that still holds a length."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.filled = [False] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = capacity + self.size
        while node and not self.filled[node]:
            self.filled[node] = True
            node //= 2

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the smallest capacity >= length."""
        filled, node = self.filled, length + self.size
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not filled[node]:
                    node += 1
        capacity = node - self.size
        window = self.windows[capacity].pop()
        if not self.windows[capacity]:
            while node and not (node < self.size and (filled[2 * node] or filled[2 * node + 1])):
                filled[node] = False
                node //= 2
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length (1 .. capacity), longest first."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = SegmentTree(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.take(length) if length < capacity else None
        if found is None:
            found, opened = (capacity, opened), opened + 1
        room, number = found
        window[i], offset[i] = number, capacity - room
        if room > length:
            tree.put(room - length, number)
    return window, offset


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of the Latin-1 block lower-cased."""
    capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = LOWER[data]
    data[1:][capital] += 32
    return data


def unusual(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the rows that the tokenizer must see whole (see ``_ODD``)."""
    odd = _ODD[data]
    pair, after = data[:-1], data[1:]
    odd[:-1] |= (pair == 0xC2) & (after <= 0xA0) | (pair == 0xC4) & (after == 0xB0) | (pair == 60) & (after == 124)
    return np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) > 0


def chunk_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the chunks: split at blanks, and before a last mark that follows a letter, which the
    tokenizer cuts there too. So a word is one chunk whether or not a comma follows."""
    starts, ends, _ = word_spans(data, offsets, _CHUNK)
    long = np.flatnonzero(ends - starts >= 3)
    last, before, lead = (data[ends[long] - i] for i in (1, 2, 3))
    letter = (before >= 97) & (before <= 122) | (lead == 0xC3) & (before >= 0xA0) & (before != 0xB7)
    cut = long[_MARK[last] & letter]
    marks = ends[cut] - 1
    ends = ends.copy()
    ends[cut] = marks
    place = np.searchsorted(starts, marks)
    starts, ends = np.insert(starts, place, marks), np.insert(ends, place, marks + 1)
    return starts, ends, np.searchsorted(starts, offsets)


class Chunks:
    """Ids of the white-space separated chunks of texts; each distinct chunk is encoded once."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.forget()

    def forget(self) -> None:
        self.hashes, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int64)  # in the order of the hashes
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode chunks, many to a string; the offsets of the tokens tell them apart."""
        ids, sizes, length = [self.ids], [], ends - starts
        for at in range(0, len(starts), _CHUNKS_A_LINE):
            size = length[at : at + _CHUNKS_A_LINE]
            line = np.full(int((size + 1).sum()), 32, np.uint8)
            line[ranges(np.cumsum(size + 1) - size - 1, size)] = data[ranges(starts[at : at + _CHUNKS_A_LINE], size)]
            text = line.tobytes().decode()
            # one string at a time: the tokenizer's tokens take far more memory than their ids
            coded = self.tokenizer.encode(text, add_special_tokens=False)
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            chunk = np.cumsum(code == 32)[np.array([o[0] for o in coded.offsets], np.int64)] if len(coded) else []
            sizes.append(np.bincount(np.asarray(chunk, np.int64), minlength=len(size)))
            ids.append(np.array(coded.ids, np.uint32))
        self.ids = np.concatenate(ids)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of every row, and which rows are unusual: their ids must be taken whole instead."""
        if len(self.hashes) > CACHED_CHUNKS:
            self.forget()
        data, whole = lowered(data), unusual(data, offsets)
        starts, ends, at = chunk_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        number = np.full(len(distinct), -1)
        met = np.flatnonzero(place < len(self.hashes))
        met = met[self.hashes[place[met]] == distinct[met]]
        number[met] = self.numbers[place[met]]
        # chunks that only unusual rows have are not encoded
        usual = np.bincount(inverse[~np.repeat(whole, np.diff(at))], minlength=len(distinct)) > 0
        new = np.flatnonzero((number < 0) & usual)
        if len(new):
            number[new] = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(new))
            self.hashes = np.insert(self.hashes, place[new], distinct[new])
            self.numbers = np.insert(self.numbers, place[new], number[new])
            self.learn(data, starts[first[new]], ends[first[new]])
        index = number[inverse]
        sizes = np.where(index < 0, 0, self.starts[index + 1] - self.starts[index])
        ids = self.ids[ranges(np.where(index < 0, 0, self.starts[index]), sizes)]
        cut = np.concatenate([[0], np.cumsum(sizes)])[at]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], whole

    def encode_whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_chunks: dict[str, Chunks] = {}


def chunks_of(path: str) -> Chunks:
    if path not in _chunks:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _chunks[path] = Chunks(Tokenizer.from_file(path))
    return _chunks[path]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int, buckets: int):
    coder, number = chunks_of(path), TaskContext.get().partitionId() << 40
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        coded, whole = coder.encode(data, offsets)
        rows, start, length, crc, total = [], [], [], [], []
        for row, own in enumerate(coded):
            if whole[row]:
                own = coder.encode_whole(data[offsets[row] : offsets[row + 1]].tobytes().decode())
            own = np.append(own, np.uint32(end_id)).astype("<u4")
            for begin in range(0, len(own), window):
                piece = own[begin : begin + window]
                rows.append(row)
                start.append(begin)
                length.append(len(piece))
                crc.append(zlib.crc32(piece.tobytes()))
                total.append(len(own))
        place = np.arange(number, number + len(rows), dtype=np.uint64)
        number += len(rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                pa.array((mix(place) % np.uint64(buckets)).astype(np.int64)),
            ],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"],
        )


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per piece: where it starts in its document and where it lies in its sequence.

    ``start`` and ``length`` count ids of the document with its end id; ``ids_crc32`` is the CRC
    of the ids as little-endian unsigned 32-bit numbers. A sequence holds at most ``window`` ids
    at offsets 0, 1, ... without a gap.
    """
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    size = source.agg(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0
    buckets = 1 + size // bucket_bytes
    pieces = source.mapInArrow(
        lambda batches: _pieces(batches, tokenizer_path, window, end_id, buckets), PIECES + ", bucket long"
    )

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "length", "ids_crc32"], ignore_index=True)
        number, offset = best_fit_decreasing(rows["length"].to_numpy(), window)
        return rows.assign(sequence_id=(rows["bucket"].to_numpy() << 32) + number, offset=offset).drop(columns="bucket")

    return pieces.groupBy("bucket").applyInPandas(place, PIECES + ", sequence_id long, offset long")
