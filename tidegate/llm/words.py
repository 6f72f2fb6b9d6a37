"""Words of many texts at once, in numpy over Arrow buffers: where they stand, and their hashes.

Used inside Spark tasks. A batch is cut into groups of whole texts of about `GROUP_BYTES`, so that
the working arrays stay small whatever the batch size; one text longer than that is a group by
itself.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
HASH_SPAN = 1 << 17

#: Word bytes of `[^\x20\x09-\x0D]+`.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, for text in which A-Z are lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

U64 = np.uint64


@dataclass
class Texts:
    """Rows `first` to `first + n` of a batch: their bytes and where each begins and ends."""

    first: int
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def text_groups(column: pa.Array, group_bytes: int = GROUP_BYTES) -> Iterator[Texts]:
    """Groups of whole texts of a string or binary column; a null reads as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(at, at[row] + group_bytes, side="right")) - 1
        last = min(max(last, row + 1), n)
        lo, hi = at[row], at[last]
        yield Texts(row, bytes_[lo:hi], at[row:last] - lo, at[row + 1 : last + 1] - lo)
        row = last


def parts(batches: Iterator[pa.RecordBatch], rows: int = 2500) -> Iterator[pa.RecordBatch]:
    """Batches of at most `rows` rows, for work whose memory grows with the batch."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
    release()


def release() -> None:
    """Gives memory that a task no longer uses back to the system: a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@dataclass
class Words:
    """Words of a group in order: byte bounds, the text they are in, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    count: np.ndarray


def find_words(texts: Texts, word_bytes: np.ndarray) -> Words:
    inside = np.zeros(len(texts.data) + 2, bool)
    inside[1:-1] = word_bytes[texts.data]
    step = inside[1:] != inside[:-1]
    cuts = np.unique(np.concatenate([texts.begin, texts.end]))
    kept_cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a text ends in a word and the next begins with one
    edges = np.flatnonzero(step)
    start, end = edges[::2], edges[1::2]
    if len(kept_cuts):
        start = np.sort(np.concatenate([start, kept_cuts]))
        end = np.sort(np.concatenate([end, kept_cuts]))
    first = np.searchsorted(start, texts.begin)
    count = np.searchsorted(start, texts.end) - first
    return Words(start, end, np.repeat(np.arange(len(first)), count), first, count)


def mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> U64(27))
    values = values * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


@lru_cache(maxsize=4)
def _lane(lane: int) -> tuple[np.ndarray, int, int]:
    table = np.random.default_rng(977 + lane).integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
    base = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)[lane]
    return table, base, pow(base, -1, 1 << 64)


@lru_cache(maxsize=8)
def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1), modulo 2**64."""
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * U64(pow(base, filled, 1 << 64))
        filled += more
    return out


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes. Spans are in ascending order of both bounds.

    Done over stretches of the data of about `HASH_SPAN` bytes; a span longer than that makes its
    stretch longer.
    """
    table, base, inverse = _lane(lane)
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        lo = int(start[at])
        stop = max(int(np.searchsorted(end, lo + HASH_SPAN, side="right")), at + 1)
        hi = int(end[stop - 1])
        size = max(HASH_SPAN, 1 << (hi - lo).bit_length())
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[data[lo:hi]] * powers(base, size)[: hi - lo], out=sums[1:])
        s, e = start[at:stop] - lo, end[at:stop] - lo
        hashes = (sums[e] - sums[s]) * powers(inverse, size + 1)[s]
        out[at:stop] = mix(hashes + (e - s).astype(np.uint64) * U64(0x9E3779B97F4A7C15))
        at = stop
    return out


def window_hashes(words: Words, hashes: np.ndarray, size: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each window of `size` words within one text, and the window's hash."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    base = U64((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)[lane])
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = value * base + hashes[k : k + n]
    return whole, mix(value)[whole]
