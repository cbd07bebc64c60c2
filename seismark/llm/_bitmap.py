"""Maps of fixed size that say which hashes may be among some, whatever their number.

A map keeps most rows that a join will not need out of its shuffle. It never leaves out a row that
the join needs; the fuller it is, the more rows it lets through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Leading bits of a hash that a map tells apart: 8 MB.
BITMAP_BITS = 26


def bitmap_of(keys: DataFrame, key: str) -> np.ndarray:
    """A bit per leading bits of the keys, put together in the tasks."""
    index = F.shiftrightunsigned(key, 64 - BITMAP_BITS)
    bits = F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({key}, {64 - BITMAP_BITS}) & 63 AS INT))"))
    words = keys.groupBy(F.shiftright(index, 6).alias("word")).agg(bits.alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap.view(np.uint64)


#: Rows that a sieve copies at a time.
ROWS_AT_ONCE = 1000


def sifted(frame: DataFrame, *sieves: tuple[str, np.ndarray], met: bool = True) -> DataFrame:
    """The rows whose keys may all be among those of their bitmaps; with ``met`` false the others,
    of which one key surely is not. All sieves work in one pass, in one Python worker a task."""
    names, schema = [key for key, _ in sieves], frame.schema
    shared = frame.sparkSession.sparkContext.broadcast([bitmap for _, bitmap in sieves])

    def inside(batch: pa.RecordBatch) -> np.ndarray:
        found = np.ones(batch.num_rows, bool)
        for key, bitmap in zip(names, shared.value, strict=True):
            at = batch.column(key).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            found &= (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) > 0
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                yield part.filter(pa.array(inside(part) == met))

    return frame.mapInArrow(run, schema)
