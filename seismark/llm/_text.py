"""Vectorised text helpers of the training-data operators.

Everything works on the UTF-8 bytes of an Arrow string column, so no Python string is made per
word. Rows are cut into slices of half a MB: working arrays stay in the cache whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_rng = np.random.default_rng(20240607)
#: A random 64-bit value for every byte value, and an odd base for each kind of rolling hash.
BYTE_CODE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
SEQUENCE_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

SPACES = b" \t\n\x0b\x0c\r"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(inside) -> np.ndarray:
    """A table of 256 flags: ``inside(byte)`` says whether a byte belongs to a word."""
    return np.array([bool(inside(b)) for b in range(256)])


NOT_SPACE = byte_class(lambda b: b not in SPACES)
WORD_OR_HIGH = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90 or b >= 128)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array end to end, and the n + 1 offsets of its rows; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if len(array) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1]
    at = at.astype(np.int64)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


#: The C library keeps up to twice this much freed memory, once a block of this size was freed.
KEPT_BLOCK = 24 << 20


def keep_freed() -> None:
    """From now on this process uses the memory of one slice's arrays again for the next.

    Without it every larger array is mapped, faulted in page by page and unmapped, which costs more
    than the work on it. glibc's limits follow the largest block freed so far, up to 32 MB; the block
    freed here is never touched.
    """
    np.empty(KEPT_BLOCK, np.uint8)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``size`` bytes of text, or one row if longer."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, and the n + 1 word offsets of the rows."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    flag = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # words do not cross rows
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = flag[:-1]
    starts = np.flatnonzero(flag & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = flag[1:]
    ends = np.flatnonzero(flag & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the word base, modulo 2**64."""
    global _powers
    while len(_powers) < n:
        step = np.uint64(pow(int(WORD_BASE), len(_powers), 2**64))
        _powers = np.concatenate([_powers, _powers * step])
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.empty(0, np.uint64)
    length = ends - starts
    total = int(length.sum())
    first = np.cumsum(length) - length
    inner = np.arange(total) - np.repeat(first, length)
    chars = data[inner + np.repeat(starts, length)]
    terms = BYTE_CODE[chars] * powers(int(length.max()))[inner]
    return mix(np.add.reduceat(terms, first) + length.astype(np.uint64))


def sequence_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Rolling hash of every ``k`` consecutive values: ``len(values) - k + 1`` entries."""
    if len(values) < k:
        return np.empty(0, np.uint64)
    result, have, block, width, base = None, 0, values, 1, int(SEQUENCE_BASE)
    rest = k
    while rest:
        if rest & 1:
            if result is None:
                result = block
            else:
                n = len(values) - have - width + 1
                result = result[:n] * np.uint64(base) + block[have : have + n]
            have += width
        rest >>= 1
        if rest:
            n = len(block) - width
            block = block[:n] * np.uint64(base) + block[width:]
            width *= 2
            base = base * base % 2**64
    return mix(result[: len(values) - k + 1])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges ``start .. start + length - 1``, one range after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(first - np.asarray(starts, np.int64), lengths)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags of the positions 0 .. n - 1 that lie in any of the spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.clip(starts, 0, n), 1)
    np.add.at(step, np.clip(ends, 0, n), -1)
    return np.cumsum(step[:-1]) > 0
