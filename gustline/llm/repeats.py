"""Find the hashes that occur more than once among very many, without a shuffle row for each.

Each task sorts blocks of its hashes, settles repeats inside a block on the spot and packs the first
ones of a block by ranges of the hash into binary rows, byte plane by byte plane, so that what is
alike in sorted hashes compresses. A range is then read by one group. Since a block sends each hash
once, a hash that a third of all documents hold costs its range one entry per block, not one per
document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.words import lean, release

BLOCK = 1 << 19  # entries sorted at once
SETTLED = 1 << 16  # repeats of a block in one binary row
RANGES_PER_PARTITION = 4  # hash ranges per shuffle partition, at least; a range is held by a task at once
RANGE_BYTES = 64 << 20  # of text whose entries one range holds, about, at most

Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # hash, further hash bits, document id, position
Emit = Callable[[pa.RecordBatch], Iterator[Entries]]


def planes(values: np.ndarray) -> bytes:
    """The values' bytes, all first bytes first."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data: bytes, dtype, count: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, count).T).view(dtype).reshape(count)


def _packed(h: np.ndarray, more: np.ndarray, doc: np.ndarray, at: np.ndarray, many: np.ndarray) -> bytes:
    least = int(doc.min())
    far = (doc - least).astype(np.uint64)
    head = np.array([len(h), least], np.int64).tobytes()
    return head + b"".join(planes(x) for x in (h, more.astype(np.uint32), far, at.astype(np.uint32), many.astype(np.uint8)))


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    n, least = np.frombuffer(data, np.int64, 2).tolist()
    found, at = [], 16
    for kind in (np.uint64, np.uint32, np.uint64, np.uint32, np.uint8):
        size = n * np.dtype(kind).itemsize
        found.append(from_planes(data[at : at + size], kind, n))
        at += size
    h, more, far, place, many = found
    return h, more, far.astype(np.int64) + least, place.astype(np.int64), many.astype(bool)


def _sorted(parts: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    """The entries by hash, document and position, and where the least entry of each one's hash is. The parts
    are emptied, and only one column is held twice at a time."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    parts.clear()
    order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
    for k, column in enumerate(columns):
        columns[k] = column[order]
    first = np.ones(len(order), bool)
    first[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    return columns, np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, from which the number of hash ranges follows."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def repeated(docs: DataFrame, emit: Emit, *, size: int = 0, drop_firsts: bool = False) -> DataFrame:
    """Rows (h, doc_id, at) of all entries whose hash more than one entry has.

    ``size`` is the number of bytes of text behind the entries: what a range holds does not grow with it.
    With ``drop_firsts`` the least entry of each hash, by document id and position, is left out, with
    entries of the same id and position; ``h`` is then of no meaning.
    """
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(ranges, -(-size // RANGE_BYTES))

    def batch_of(kinds: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(blobs, pa.binary())], ["part", "entries"])

    def block(parts: list[Entries], salt: int) -> pa.RecordBatch:
        (h, more, doc, at), least = _sorted(parts)
        first = least == np.arange(len(least))
        elsewhere = (doc != doc[least]) | (at != at[least])
        kinds, blobs = [], []
        again = np.flatnonzero(elsewhere if drop_firsts else ~first)  # settled here; any task may pass them on
        for k, a in enumerate(range(0, len(again), SETTLED)):
            own = again[a : a + SETTLED]
            kinds.append(ranges + (salt + k) % ranges)
            hidden = np.zeros(len(own), np.uint64) if drop_firsts else h[own]
            blobs.append(_packed(hidden, np.zeros(len(own), np.uint32), doc[own], at[own], np.ones(len(own), bool)))
        follows = np.append(~first[1:], False)[first]
        h, more, doc, at = (x[first] for x in (h, more, doc, at))
        group = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        found, begin = np.unique(group, return_index=True)
        kinds += found.astype(np.int64).tolist()
        for a, b in zip(begin, [*begin[1:], len(h)], strict=True):
            blobs.append(_packed(*(x[a:b] for x in (h, more, doc, at, follows))))
        return batch_of(kinds, blobs)

    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []
        size, salt = 0, TaskContext.get().partitionId() * 31
        for batch in batches:
            for entries in emit(batch):
                held.append(entries)
                size += len(entries[0])
                if size >= BLOCK:
                    yield block(held, salt)
                    held, size, salt = [], 0, salt + 7
        if size:
            yield block(held, salt)

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        release()  # what the range before left
        parts = [_unpacked(x.as_py()) for x in table.column("entries")]
        if key[0].as_py() < ranges:
            (h, _, doc, at, many), least = _sorted(parts)
            if drop_firsts:
                keep = (doc != doc[least]) | (at != at[least])
            else:
                first = least == np.arange(len(least))
                keep = many | ~first
                keep[:-1] |= ~first[1:]
            h, doc, at = h[keep], doc[keep], at[keep]
        else:
            h, _, doc, at, _ = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.table([pa.array(h.view(np.int64)), pa.array(doc), pa.array(at)], ["h", "doc_id", "at"])

    sent = docs.mapInArrow(send, "part long, entries binary")
    return sent.groupBy("part").applyInArrow(settle, "h long, doc_id long, at long")
