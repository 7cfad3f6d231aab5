"""Remove passages that the corpus has before: every word inside a window of ``size`` words whose word
sequence also starts earlier (in a smaller document id, or earlier in the same document).

1. Each window has an anchor: the least hash among its ``ANCHOR``-word runs. Equal windows have equal
   anchors, so a window whose anchor occurs once in the corpus is new. Consecutive windows mostly share
   their anchor; one entry per anchor is looked up (``repeats``).
2. Only windows with a repeated anchor are hashed themselves (96 bits) and looked up the same way; all
   but the earliest of each are marked. Ranges of marked windows are joined back to their documents.

Both steps keep the earliest of a task's equal entries before anything is shuffled, so a passage or a
document with any number of copies costs a hash range one entry per task. Windows are judged on the
input, not on what is left.

Nulls: a null text has no words; a row without id is kept whole and compared with nothing. Repeated
rows (one id, one text) do not count as earlier than each other. Rows with one id and different texts
share what is removed, so ids should be unique. Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.functions.signals import quoted
from gustline.llm.names import fresh, numbered
from gustline.llm.repeats import repeated, text_bytes
from gustline.llm.words import Words, chunks, in_small_batches, lean, mix
from gustline.session import stage

SIZE = 20
ANCHOR = 8
BROADCAST_ROWS = 1 << 21  # ranges sent to all tasks at most; more are joined by a shuffle

RANGES = "doc_id long, begins array<long>, ends array<long>"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def anchors(words: Words, size: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each run of windows with one anchor."""
    _, windows = words.windows(size)
    if not len(windows):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes, at = words.windows(part)
    reach = size - part + 1
    runs = np.full(len(words.hashes) + reach, np.uint64(2**64 - 1))
    runs[at] = hashes
    place = windows + sliding_window_view(runs, reach)[windows].argmin(axis=1)
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)))
    return runs[place[first]], windows[first], np.diff(np.append(first, len(windows)))


def _merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touching and overlapping ranges made one; sorted by begin."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    opens = np.append(True, begins[1:] > ends[:-1])
    return begins[opens], ends[np.append(opens[1:], True)]


def _per_document(entries: DataFrame, bits: int) -> DataFrame:
    """Ranges of windows of each document; an entry's position is first window * 2**bits + windows - 1."""

    @lean
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends = [], []
            for row in batch.column(1):
                at = row.values.to_numpy()
                a, b = _merged(at >> bits, (at >> bits) + (at & ((1 << bits) - 1)) + 1)
                begins.append(a)
                ends.append(b)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(begins, kind), pa.array(ends, kind)], ["doc_id", "begins", "ends"])

    return entries.groupBy("doc_id").agg(F.collect_list("at").alias("at")).mapInArrow(merge, RANGES)


def _joined(docs: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    total = ranges.agg(F.sum(F.size("begins") + 1)).first()[0] or 0
    return docs.join(F.broadcast(ranges) if total <= BROADCAST_ROWS else ranges, "doc_id", how)


def repeated_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Ranges of the windows of each document that occur earlier; documents without are left out."""
    part, bits = min(ANCHOR, size), max(1, (size - 1).bit_length())
    docs = in_small_batches(docs).where("doc_id is not null")

    def looked_up(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy()
        for at, words in chunks(batch.column(1)):
            hashes, first, count = anchors(words, size, part)
            row = np.searchsorted(words.first, first, "right") - 1
            yield hashes, np.zeros(len(first), np.uint32), ids[at + row], ((first - words.first[row]) << bits) + count - 1

    def hashed(batch: pa.RecordBatch):
        ids, begins, ends = batch.column(0).to_numpy(), batch.column(2), batch.column(3)
        for at, words in chunks(batch.column(1)):
            steps = np.zeros(len(words.hashes) + 2, np.int64)
            for k in range(words.rows):
                np.add.at(steps, begins[at + k].values.to_numpy() + words.first[k], 1)
                np.add.at(steps, ends[at + k].values.to_numpy() + words.first[k], -1)
            hashes, windows = words.windows(size)
            wanted = np.cumsum(steps)[windows] > 0
            words.hashes = mix(words.hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))
            more, _ = words.windows(size)
            windows = windows[wanted]
            row = np.searchsorted(words.first, windows, "right") - 1
            yield hashes[wanted], (more[wanted] >> np.uint64(32)).astype(np.uint32), ids[at + row], windows - words.first[row]

    volume = text_bytes(docs)
    candidates = stage(_per_document(repeated(docs, looked_up, size=volume), bits), "candidate-windows")
    again = repeated(_joined(docs, candidates, "inner").select("doc_id", "text", "begins", "ends"), hashed, size=volume, drop_firsts=True)
    return stage(_per_document(again.withColumn("at", F.col("at") * 2), 1), "repeated-windows")


def _pruned(docs: DataFrame, size: int) -> DataFrame:
    return _joined(docs, repeated_windows(docs.select("doc_id", "text"), size), "left")


def _kept(text: str | None, begins, ends, size: int) -> tuple[list[bytes], int]:
    """Words that stay, and how many there were."""
    words = (text or "").encode().split()  # splits bytes at exactly the separators of words
    if begins is None:
        return words, len(words)
    kept, at = [], 0
    for begin, end in zip(begins, ends, strict=True):
        kept += words[at:begin]
        at = max(at, end + size - 1)
    return kept + words[at:], len(words)


def dedup(docs: DataFrame, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of words, number removed, and checksum of what stays, per document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    @lean
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, sha = [], [], []
            for text, begins, ends in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
                kept, total = _kept(text.as_py(), begins.as_py(), ends.as_py(), size)
                n.append(total)
                removed.append(total - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _pruned(docs, size).select("doc_id", "text", "begins", "ends").mapInArrow(digest, RESULT)


def dedup_texts(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """The documents with all their columns; a text that lost words has the others joined by a space."""
    at, width = docs.columns.index("text"), len(docs.columns)
    mark = fresh("doc_mark", docs.columns)

    @lean
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, begins, ends in zip(*(batch.column(k) for k in (at, width, width + 1)), strict=True):
                own = text.as_py()
                texts.append(own if begins.as_py() is None else b" ".join(_kept(own, begins.as_py(), ends.as_py(), size)[0]).decode())
            names = batch.schema.names[:width]
            yield batch.select(names).set_column(at, names[at], pa.array(texts, pa.string()))

    ranges = repeated_windows(docs.select(F.col("doc_id").cast("long"), "text"), size)
    total = ranges.agg(F.sum(F.size("begins") + 1)).first()[0] or 0
    first, last = fresh("begins", docs.columns), fresh("ends", docs.columns)
    ranges = ranges.withColumnsRenamed({"doc_id": mark, "begins": first, "ends": last})
    marked = docs.withColumn(mark, F.col("doc_id").cast("long"))
    joined = marked.join(F.broadcast(ranges) if total <= BROADCAST_ROWS else ranges, mark, "left")
    plain = numbered(joined.select(*(F.col(quoted(c)) for c in docs.columns), first, last))
    return plain.mapInArrow(prune, plain.select(plain.columns[:width]).schema).toDF(*docs.columns)
