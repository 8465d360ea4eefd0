"""Saved tables, whole-text batches and vectorised hashing for the operators of this package."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from webcapture.shared import new_path

#: Bytes of text that a task turns into numpy arrays at once; a longer text is one batch of its own.
BATCH_BYTES = 1 << 20
#: The same where larger batches mean fewer different words to look up or to send.
WORD_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
#: A second base, for a second hash that is independent of the first.
OTHER_BASE = 0xC2B2AE3D27D4EB4F


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: the lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the places where each begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def by_bytes(batches: Iterator[pa.RecordBatch], text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of whole rows with about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(length) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def mix(value: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit depends on all."""
    value = np.asarray(value, np.uint64)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


#: Powers are the product of one of the first few and one of every so many, so that no table is as long as a text.
_STRIDE_BITS = 12
_STRIDE = 1 << _STRIDE_BITS


@functools.cache
def _low(base: int) -> np.ndarray:
    steps = np.full(_STRIDE, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _high(base: int, count: int) -> np.ndarray:
    steps = np.full(max(count, 1), pow(base, _STRIDE, 1 << 64), np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Hasher:
    """Hashes of byte ranges of one array, by differences of a running polynomial sum."""

    def __init__(self, data: np.ndarray, base: int = _BASE) -> None:
        strides, inverse = (len(data) >> _STRIDE_BITS) + 1, pow(base, -1, 1 << 64)
        self._low, self._high = _low(inverse), _high(inverse, strides)
        value = np.zeros(strides << _STRIDE_BITS, np.uint64)
        value[: len(data)] = data
        value[: len(data)] += np.uint64(1)
        by_stride = value.reshape(strides, _STRIDE)
        by_stride *= _low(base)
        by_stride *= _high(base, strides)[:, None]
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[: len(data)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self._sums[end] - self._sums[start]
        raw *= self._low[start & (_STRIDE - 1)]
        raw *= self._high[start >> _STRIDE_BITS]
        return mix(raw + np.asarray(end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_places(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes, and how many words precede each text."""
    inside = is_word[data]
    full = offsets[:-1] < offsets[1:]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][full]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


class BitFilter:
    """A filter of fixed size for 64-bit values: lets through all that were put in, and few others."""

    BLOCKS = 64

    def __init__(self, bits: int, packed: np.ndarray) -> None:
        self.bits, self.packed = bits, packed

    @staticmethod
    def places(values: np.ndarray, bits: int) -> np.ndarray:
        seeds = np.array([0x632BE59BD9B4E019, 0xE220A8397B1DCDAF, 0x9E6C63D0676A9A99], np.uint64)
        return (mix(values.view(np.uint64)[:, None] + seeds) >> np.uint64(64 - bits)).astype(np.int64)

    def __contains__(self, value: int) -> bool:
        return bool(self.lets(np.array([value], np.int64))[0])

    def lets(self, values: np.ndarray) -> np.ndarray:
        place = self.places(values, self.bits)
        return ((self.packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).all(axis=1)

    @classmethod
    def of(cls, values: DataFrame, bits: int) -> BitFilter:
        """The filter of a column of longs. Tasks send blocks of bits, which are joined as they stream by."""
        schema = pa.schema([("block", pa.int32()), ("marks", pa.binary())])

        def rows(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(blocks), pa.int32()), pa.array([b.tobytes() for b in blocks.values()], pa.binary())], schema=schema)

        def mark(batches):
            marks = np.zeros(1 << bits, bool)
            for batch in batches:
                marks[cls.places(batch.column(0).to_numpy(), bits)] = True
            yield rows({k: part for k, part in enumerate(np.packbits(marks).reshape(cls.BLOCKS, -1)) if part.any()})

        def join(batches):
            blocks: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, marks in zip(batch.column("block").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                    marks = np.frombuffer(marks, np.uint8)
                    blocks[block] = blocks[block] | marks if block in blocks else marks
            yield rows(blocks)

        packed = np.zeros((cls.BLOCKS, (1 << bits) // 8 // cls.BLOCKS), np.uint8)
        marked = values.mapInArrow(mark, "block int, marks binary").repartition(cls.BLOCKS, "block").mapInArrow(join, "block int, marks binary")
        for block, marks in marked.collect():
            packed[block] = np.frombuffer(marks, np.uint8)
        return cls(bits, packed.reshape(-1))
