"""A count-min sketch that answers one question: may this hash occur twice or more?

Each row of the sketch has two bit planes: a cell was met, and was met again. Sketches of partitions
merge to the sketch of their union, in any order. Like every count-min sketch it overestimates only:
a hash that occurs twice is always reported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidegate.llm.words import release
from tidegate.session import overridden

ROWS = 2
#: 2**28 cells: two rows are 128 MB in a building task and 64 MB where they are looked up.
MAX_BITS = 28
MIN_BITS = 16
BLOCK_BYTES = 1 << 17
BATCH_ROWS = "1000"
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
U64 = np.uint64


def bits_for(expected: int, max_bits: int = MAX_BITS) -> int:
    """Cells per row, as a power of two: two to four for each expected hash, within the bound.

    Beyond the bound more hashes are reported than occur twice; none is lost.
    """
    return int(min(max(MIN_BITS, (2 * max(expected, 1)).bit_length()), max_bits))


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((hashes * U64(_FACTORS[row])) >> U64(64 - bits)).astype(np.int64)


class RepeatSketch:
    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros((ROWS, 1 << bits - 3), np.uint8)
        self.again = np.zeros((ROWS, 1 << bits - 3), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for row in range(ROWS):
            cells = np.sort(_cells(hashes, row, self.bits))
            fresh = np.concatenate([[True], cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, bool)
            at = np.flatnonzero(fresh)
            cell, times = cells[at], np.diff(at, append=len(cells))
            byte, bit = cell >> 3, np.left_shift(1, cell & 7).astype(np.uint8)
            seen = ((self.once[row][byte] & bit) != 0) | (times > 1)
            np.bitwise_or.at(self.again[row], byte[seen], bit[seen])
            np.bitwise_or.at(self.once[row], byte, bit)

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(number, once, again) of each block that is not empty, packed."""
        size = min(BLOCK_BYTES, self.once.shape[1])
        once, again = self.once.reshape(-1, size), self.again.reshape(-1, size)
        packer = zstandard.ZstdCompressor(level=1)
        for number in np.flatnonzero(once.any(axis=1)).tolist():
            yield number, packer.compress(once[number].tobytes()), packer.compress(again[number].tobytes())


def repeated(again: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may occur twice or more, by the merged planes `again` (rows, bytes)."""
    out = np.ones(len(hashes), bool)
    for row in range(ROWS):
        cell = _cells(hashes, row, bits)
        out &= ((again[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)
    return out


def merged_planes(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, met: bool = False) -> np.ndarray:
    """The planes `again` of the sketch over all rows of `df`; hashes_of gives the hashes of a batch.
    With `met`, the planes `once`: what `repeated` then reports is whether a hash may occur at all.

    Every task fills a sketch of its own, and blocks of equal number merge in a second stage. What
    the driver gets, and may broadcast, has ROWS * 2**bits / 8 bytes, whatever the input.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = None
        for batch in batches:
            for hashes in hashes_of(batch):
                sketch = sketch or RepeatSketch(bits)
                sketch.add(hashes)
        if sketch:
            for number, once, again in sketch.blocks():
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([number], pa.int32()), "once": pa.array([once], pa.binary()), "again": pa.array([again], pa.binary())}
                )
        del sketch
        release()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, once, again = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int32()), "again": pa.array([(once if met else again).tobytes()], pa.binary())})

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for k, first, second in zip(*(batch.column(i).to_pylist() for i in range(3))):
                first, second = (np.frombuffer(opener.decompress(x), np.uint8) for x in (first, second))
                if k != number:
                    if number is not None:
                        yield done()
                    number, once, again = k, first.copy(), second.copy()
                else:
                    again |= second | (once & first)
                    once |= first
        if number is not None:
            yield done()

    slots = df.sparkSession.sparkContext.defaultParallelism  # one sketch for each task that can run at a time is enough
    parts = df.coalesce(slots).mapInArrow(build, "block int, once binary, again binary")
    blocks = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, again binary")
    planes = np.zeros((ROWS, 1 << bits - 3), np.uint8)
    flat = planes.reshape(-1, min(BLOCK_BYTES, planes.shape[1]))
    with overridden(df.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}):
        for row in blocks.toLocalIterator(prefetchPartitions=True):
            flat[row.block] = np.frombuffer(row.again, np.uint8)
    return planes
