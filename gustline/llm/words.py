"""Words, shingles and windows of whole Arrow batches, without a Python loop over words.

A word is a maximal run of bytes other than space and the controls 0x09-0x0D; no byte of a multi-byte
UTF-8 character is one of these. Word hashes are polynomial hashes modulo 2**64 of all bytes of the
word and its length, mixed; a window's hash combines those of its words. Two different words or
windows share a 64-bit hash with a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 19  # text handled at once; a single longer text is a chunk of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept up to the chunk size."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    size = max(n, CHUNK_BYTES + 1)
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        tables.append(np.multiply.accumulate(steps))
    if size == CHUNK_BYTES + 1:
        _powers = tables[0], tables[1]
    return tables[0], tables[1]


@dataclass
class Words:
    """Words of a chunk of texts: byte ranges, the row of each word, and its hash."""

    data: np.ndarray  # the chunk's bytes, lower-cased if asked for
    offsets: np.ndarray  # of each row's text in data, one more than rows
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each row's words, one more than rows
    hashes: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words of one row, and the index of its first word."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total, done = np.zeros(n, np.uint64), 0
        power, span, part = _STEP, 1, self.hashes
        with np.errstate(over="ignore"):
            while True:  # binary digits of size: part holds windows of span words
                if size & span:
                    total = total * power + part[done : done + n]
                    done += span
                if 2 * span > size:
                    break
                part = part[:-span] * power + part[span:]
                power, span = power * power, 2 * span
        row = self.row
        at = np.flatnonzero(row[:n] == row[size - 1 :])
        return mix(total[at]), at


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    offsets = offsets.astype(np.int64) - int(offsets[0])
    n = int(offsets[-1])
    if lower:
        data = _LOWER[data]
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    up, down = _power_tables(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
        hashes = mix(hashes)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, Words]]:
    """First row and words of consecutive groups of rows of about ``CHUNK_BYTES``."""
    if not len(column):
        return
    data, offsets = texts_of(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        to = max(at + 1, min(to, len(column)))
        yield at, find_words(data[offsets[at] : offsets[to]], offsets[at : to + 1], lower)
        at = to


Batches = Iterator[pa.RecordBatch]


BATCH_ROWS = 1000  # texts that go from Spark to a worker at once, at most
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """The frame, with batches of its session bounded: those of Spark's default hold ten thousand whole texts,
    in the executor and again in the worker."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH, "0")) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    return df


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over batches that gives freed memory back when it ends. Workers are used again by later
    stages and wait in between; what the allocators keep of a stage's arrays would count all that time."""

    @wraps(run)
    def inner(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def release() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
