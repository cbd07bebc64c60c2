"""Removal of repeated byte strings, found with suffix arrays built by external induced sorting.

Texts are cut into segments that only equal windows can share (:mod:`repeats`), which leaves the
suffix arrays the contents that occur in several forms. These are dealt to shards by their gram, so
equal windows always meet. A shard is sorted by induction: its LMS substrings are named and their
suffixes ordered by names of doubling reach, which is the recursion on the reduced text as far as a
window reaches; then all other suffixes are induced, first the L-type in rising, then the S-type in
falling order. The induction runs over queues, one per first byte: a tuple (suffix, common prefix
with the one before) is taken from the lowest (highest) queue and puts its left neighbour into that
of its byte, with the common prefix as the minimum over the tuples in between, plus one. Queues
beyond ``queue_bytes`` go to a file of the task, unlinked from the start as a shuffle spill is, so a
shard may be larger than memory. A suffix whose common prefix with a neighbour reaches the window
length starts a repeated string.

Edge cases: null and empty texts, and those shorter than a window, lose nothing; repeated rows
are repeats of each other; documents equal in id and text give equal rows; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seismark.llm import repeats
from seismark.llm._text import BYTE_CODE, ranges, slices, utf8

LENGTH = 200
GRAM = 32
#: Bytes of content in a shard, about, and of queue entries that a task holds in memory.
SHARD_BYTES = 4 << 20
QUEUE_BYTES = 64 << 20
#: Distinct contents of one gram above which its windows are compared one by one.
HOT_CONTENTS = 200_000
_CHUNK = 1 << 16
_NONE = np.iinfo(np.int16).max


def byte_units(length: int = LENGTH, gram: int = GRAM) -> repeats.Units:
    return repeats.Units(length, gram, lambda data, offsets: (BYTE_CODE[data], offsets, None, None))


class DiskQueues:
    """First-in first-out queues of (suffix, common prefix) by first symbol, on disk beyond a size."""

    def __init__(self, memory: int):
        self.memory, self.held, self.file = memory, 0, None
        self.parts: dict[int, list] = {}

    def put(self, symbol: int, suffix: np.ndarray, common: np.ndarray) -> None:
        size = suffix.nbytes + common.nbytes
        if self.held + size > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            entry = (self.file.tell(), len(suffix))
            self.file.write(suffix.tobytes() + common.tobytes())
        else:
            entry = (suffix, common)
            self.held += size
        self.parts.setdefault(symbol, []).append(entry)

    def take(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Everything in a queue so far, oldest first, in pieces of about ``_CHUNK`` entries."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for a, b in self.parts.pop(symbol, []):
            if isinstance(a, int):
                self.file.seek(a)
                raw = self.file.read(6 * b)
                a, b = np.frombuffer(raw, np.int32, b), np.frombuffer(raw, np.int16, b, 4 * b)
            else:
                self.held -= a.nbytes + b.nbytes
            held.append((a, b))
            size += len(a)
            if size >= _CHUNK:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low .. high], both included, for many ranges."""
    table = [values]
    while len(table[-1]) > 1 << (len(table) - 1) and (1 << len(table)) <= len(values):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    level = np.frexp((high - low + 1).astype(np.float32))[1] - 1
    result = np.empty(len(low), values.dtype)
    for k in np.unique(level).tolist():
        own = level == k
        result[own] = np.minimum(table[k][low[own]], table[k][high[own] - (1 << k) + 1])
    return result


class Induction:
    """Suffix order of texts that end in separators (symbol 0), to a depth, with common prefixes."""

    def __init__(self, symbols: np.ndarray, depth: int, memory: int):
        self.s, self.depth = symbols, depth
        self.padded = np.concatenate([symbols, np.zeros(depth + 16, np.uint8)])
        self.memory, n = memory, len(symbols)
        change = np.flatnonzero(symbols[1:] != symbols[:-1])
        after = np.append(change, n - 1)[np.searchsorted(change, np.arange(n))]
        following = np.append(symbols[1:], np.uint8(0))
        self.small = symbols[after] < following[after]  # S-type: less than its right neighbour
        self.small[symbols == 0] = True
        self.lms = np.flatnonzero(self.small & ~np.concatenate([[True], self.small[:-1]]))

    def words(self, at: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(self.padded, 8)
        return np.ascontiguousarray(view[np.minimum(at, len(view) - 1)]).view(">u8").ravel().astype(np.uint64)

    def names(self) -> np.ndarray:
        """Rank of each LMS substring; a separator is smaller than all and unlike any other."""
        lms, m = self.lms, len(self.lms)
        end = np.append(lms[1:], lms[-1])
        typed = np.zeros(len(self.s) + 8, np.uint64)
        typed[: len(self.s)] = self.s.astype(np.uint64) * np.uint64(2) + self.small
        group, active, reach = np.zeros(m, np.int64), np.arange(m), 0
        while len(active):
            at, stop = lms[active] + reach, end[active]
            key = np.zeros(len(active), np.uint64)
            for i in range(7):
                key = key << np.uint64(9) | np.where(at + i <= stop, typed[np.minimum(at + i, len(typed) - 1)], np.uint64(0))
            order = np.lexsort((key, group[active]))
            active, key = active[order], key[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (group[active][1:] != group[active][:-1])])
            first = np.flatnonzero(new)
            base = group[active]
            # ranks are places in the sorted whole: those of a group start at its own place
            inside = np.arange(len(active)) - np.searchsorted(base, base)
            group[active] = (base + inside)[first][np.cumsum(new) - 1]
            size = np.diff(np.append(first, len(active)))
            reach += 7
            more = (np.repeat(size, size) > 1) & (lms[active] + reach <= end[active])
            active = active[more]
            active = active[np.argsort(group[active], kind="stable")]
        is_end = self.s[lms] == 0
        rank = group + is_end.sum()
        rank[is_end] = np.arange(is_end.sum())
        return rank

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS suffixes in order to the depth, and the common prefix of each with the one before."""
        lms, m = self.lms, len(self.lms)
        rank, step = np.append(self.names(), -1), 1
        order = np.argsort(rank[:-1], kind="stable")
        value = rank[order]
        first = np.concatenate([[True], value[1:] != value[:-1]])
        rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]  # ranks are places in the order
        while step < m:
            value = rank[order]
            new = np.concatenate([[True], value[1:] != value[:-1]])
            size = np.diff(np.append(np.flatnonzero(new), m))
            span = lms[np.minimum(order + step, m - 1)] - lms[order]
            open_ = np.flatnonzero((np.repeat(size, size) > 1) & (span < self.depth) & (self.s[lms[order]] > 0))
            if not len(open_):
                break
            # a group is open or settled as a whole: equal names reach equally far
            own = order[open_]
            nested = np.lexsort((rank[np.minimum(own + step, m)], rank[own]))
            order[open_] = own = own[nested]
            first, second = rank[own], rank[np.minimum(own + step, m)]
            split = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
            rank = rank.copy()
            rank[own] = open_[np.flatnonzero(split)][np.cumsum(split) - 1]
            step *= 2
        at = lms[order]
        return at, np.concatenate([[0], self.common(at[:-1], at[1:])]).astype(np.int16)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes a and b, to the depth; a separator ends it."""
        result, active, reach = np.zeros(len(a), np.int64), np.arange(len(a)), 0
        while len(active) and reach < self.depth:
            x, y = self.words(a[active] + reach), self.words(b[active] + reach)
            differ = x ^ y
            lead = np.where(differ == 0, 8, 7 - (np.frexp(differ.astype(np.float64))[1] - 1) // 8)
            byte = np.ascontiguousarray(x.astype(">u8")).view(np.uint8).reshape(-1, 8) == 0
            ended = np.where(byte.any(axis=1), byte.argmax(axis=1), 8)
            lead = np.minimum(lead, ended)
            result[active] += lead
            active = active[lead == 8]
            reach += 8
        return np.minimum(result, self.depth)

    def push(self, queues: DiskQueues, suffix: np.ndarray, common: np.ndarray, state: dict, small: bool) -> None:
        """Put the left neighbours of suffixes taken in order into their queues."""
        for at in range(0, len(suffix), _CHUNK):
            own, lcp = suffix[at : at + _CHUNK], common[at : at + _CHUNK]
            left = own - 1
            known = (left >= 0) & (self.small[left] == small) & (self.s[left] > 0)
            place = np.flatnonzero(known)
            least = lcp.min()
            if not len(place):
                np.minimum(state["least"], least, out=state["least"])
                continue
            symbol = self.s[left[place]]
            order = np.argsort(symbol, kind="stable")
            place, symbol = place[order], symbol[order]
            first = np.concatenate([[True], symbol[1:] != symbol[:-1]])
            low = np.where(first, 0, np.concatenate([[0], place[:-1] + 1]))
            shared = range_min(lcp, low, place)
            shared = np.where(first, np.minimum(shared, state["least"][symbol]), shared)
            shared = np.minimum(shared.astype(np.int64) + 1, self.depth).astype(np.int16)
            shared[first & ~state["any"][symbol]] = 0
            begin = np.flatnonzero(first)
            stop = np.append(begin[1:], len(place))
            np.minimum(state["least"], least, out=state["least"])
            tail = np.minimum.accumulate(lcp[::-1])[::-1]
            for b, e in zip(begin.tolist(), stop.tolist(), strict=True):
                name, last = int(symbol[b]), int(place[e - 1])
                state["any"][name] = True
                state["least"][name] = tail[last + 1] if last + 1 < len(lcp) else _NONE
                queues.put(name, left[place[b:e]].astype(np.int32), shared[b:e])

    def close(self, least: int) -> np.ndarray:
        """Flags of the suffixes that share at least ``least`` symbols with a neighbour in the order."""
        flags = np.zeros(len(self.s), bool)
        start = lambda: {"least": np.full(256, _NONE, np.int16), "any": np.zeros(256, bool)}
        queues, large, state = DiskQueues(self.memory), DiskQueues(self.memory), start()
        seeds, shared = self.sorted_lms() if len(self.lms) else (np.empty(0, np.int64), np.empty(0, np.int16))
        edges = np.searchsorted(self.s[seeds], np.arange(257))
        last_large = np.full(256, -1)

        def mark(suffix: np.ndarray, common: np.ndarray, before: int) -> None:
            near = common >= least
            flags[suffix[near]] = True
            previous = np.concatenate([[before], suffix[:-1]])[near]
            flags[previous[previous >= 0]] = True

        for symbol in range(256):
            while symbol in queues.parts:  # a suffix may put its left neighbour into its own queue
                for suffix, common in list(queues.take(symbol)):
                    mark(suffix, common, last_large[symbol])
                    last_large[symbol] = suffix[-1]
                    large.put(symbol, suffix, common)
                    self.push(queues, suffix, common, state, False)
            a, b = edges[symbol], edges[symbol + 1]
            if a < b:
                own = shared[a:b].copy()
                own[0] = self.between(last_large[symbol], seeds[a])
                self.push(queues, seeds[a:b].astype(np.int32), own, state, False)
        state = start()
        for symbol in range(255, 0, -1):
            last = -1
            while symbol in queues.parts:
                for suffix, common in list(queues.take(symbol)):
                    mark(suffix, common, last)
                    last = suffix[-1]
                    self.push(queues, suffix, common, state, True)
            parts = list(large.take(symbol))  # one byte's share of the suffixes
            before = self.between(last, last_large[symbol])
            if before >= least:
                flags[[last, last_large[symbol]]] = True
            for suffix, common in reversed(parts):
                falling = np.concatenate([[before], common[:0:-1]]).astype(np.int16)
                before = common[0]
                self.push(queues, suffix[::-1], falling, state, True)
        return flags

    def between(self, a: int, b: int) -> int:
        return int(self.common(np.array([a]), np.array([b]))[0]) if a >= 0 and b >= 0 else 0


def repeated_windows(texts: list[bytes], places: np.ndarray, length: int, memory: int = QUEUE_BYTES) -> np.ndarray:
    """Flags of the windows of the texts (len - length + 1 each) whose content is in another place."""
    size = np.array([len(t) for t in texts], np.int64)
    n = size - length + 1
    first = np.cumsum(size + 1) - size - 1
    symbols = np.zeros(int((size + 1).sum()), np.uint8)  # UTF-8 has no byte 255, so b + 1 fits
    symbols[ranges(first, size)] = np.frombuffer(b"".join(texts), np.uint8) + 1
    flags = Induction(symbols, length + 8, memory).close(length)[ranges(first, n)]
    return flags | np.repeat(places > 1, n)


def decide(batches: Iterator[pa.RecordBatch], length: int, memory: int) -> Iterator[pa.RecordBatch]:
    """A shard: its contents together, sorted as one text."""
    rows = [b for b in batches if b.num_rows]
    if rows:
        table = pa.Table.from_batches(rows).combine_chunks()
        n = table["n"].to_numpy().astype(np.int64)
        flags = repeated_windows(table["bytes"].to_pylist(), table["places"].to_numpy(), length, memory)
        yield repeats.runs_batch(table["gram"].combine_chunks(), table["content"].combine_chunks(), n, flags)


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
    queue_bytes: int = QUEUE_BYTES, hot_contents: int = HOT_CONTENTS, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    source = repeats.keyed(documents, text_column, id_column)
    units = byte_units(length, gram)
    spans = repeats.repeats_of(
        source, units, "substring", lambda batches: decide(batches, length, queue_bytes), max(1, shard_bytes // 3), hot_contents
    )
    met = source.join(spans, repeats.same_key(source, spans), "left").select(source["doc_id"], source["text"], "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            removed, runs, digest = [], [], []
            for row in range(batch.num_rows):
                own = data[offsets[row] : offsets[row + 1]]
                gone = repeats.flagged(batch.column("spans"), row, len(own))
                removed.append(int(gone.sum()))
                runs.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if removed[-1] else 0)
                digest.append(hashlib.sha256(own[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
