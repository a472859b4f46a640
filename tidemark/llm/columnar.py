"""Numpy views of Arrow text columns and vectorised hashing of byte ranges.

Used inside ``mapInArrow`` tasks.  Everything works on bounded slices of a batch,
so a task holds some tens of megabytes whatever the size of its partition; only
a single document longer than the slice bound is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19


def plain_text(name: str) -> Column:
    """The text column with null taken as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after another, and n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with at most ``limit`` bytes of text.

    Yields (rows, bytes, offsets); a longer document makes a slice of its own.
    """
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield (
                batch.slice(start, end - start),
                data[offsets[start] : offsets[end]],
                offsets[start : end + 1] - offsets[start],
            )
            start = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class RangeHash:
    """64-bit hashes of arbitrary ranges of a sequence of small symbols.

    A polynomial over random symbol values modulo 2^64: one running sum serves
    every range, and an odd base can be divided out again, so equal ranges have
    equal hashes wherever they stand.
    """

    def __init__(self, seed: int = 1, symbols: int = 256):
        random = np.random.default_rng(seed)
        self._values = random.integers(1, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2)
        self._values += np.uint64(1)
        self._base = int(random.integers(1, 1 << 62)) * 2 + 1
        self._powers = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            size = max(n, SLICE_BYTES + 1024)
            base = np.uint64(self._base)
            back = np.uint64(pow(self._base, -1, 1 << 64))
            with np.errstate(over="ignore"):
                self._powers = np.multiply.accumulate(np.full(size, base, np.uint64))
                self._inverse = np.multiply.accumulate(np.full(size, back, np.uint64))

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(self._values[symbols] * self._powers[: len(symbols)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self._inverse[start])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of ``counts`` values (rows along axis 0)."""
    out = np.zeros((len(counts), *values.shape[1:]), np.float64)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
