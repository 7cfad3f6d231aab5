"""Harmonic packing of whole documents into sequences of a fixed capacity.

A piece of length L belongs to the class ``capacity // L``: a bin of class j takes exactly j pieces.
Documents are cut so that pieces nearly fill their class's share of a bin: whole sequences first,
then the rest, which goes whole when it fills at least ``FULL`` of its share and else leaves a piece
that fills the next smaller share exactly. A rest shrinks from at most C/j to at most C/(j(j+1)), so
a document has few pieces beyond its whole sequences.

Each worker fills the bins of every class on its own, in one pass over its pieces, holding only open
bins (fewer than j pieces per class). Pieces in bins that a worker could not finish go to a second
level with far fewer workers, and so on; the last level has one, which gets at most the open bins of
a bounded number of workers and packs what stays open by decreasing length.

Nulls: a null text counts as empty (one piece: the end id); a null id is kept as null. Repeated rows
are separate documents. Other columns are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.tokens import encoder
from gustline.llm.words import in_small_batches, lean
from gustline.session import stage

FULL = 31 / 32
FAN_IN = 32  # workers of a level per worker of the next

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = f"{PIECES}, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def cuts(tokens: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces, in order."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        count = capacity // rest
        length = rest if rest >= FULL * (capacity // count) else capacity // (count + 1)
        lengths.append(length)
        rest -= length
    return lengths


def piece_table(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Encode each text, add the end id and cut; one row per piece."""

    @lean
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                start = 0
                for length in cuts(len(ids), capacity):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc, start, length, crc, len(ids)))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 5)], _NAMES
            )

    return docs.mapInArrow(pieces, PIECES)


def _fill(level: int, last: bool, capacity: int):
    """Fill the bins of every class from one worker's pieces; what stays open has no sequence."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # all is encoded now, and workers wait for other stages with what they keep
        first = (level << 58) | (TaskContext.get().partitionId() << 36)
        made = 0
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            length = table.column("length").to_numpy()
            kind = capacity // length
            order = np.argsort(kind, kind="stable")
            kinds, begin, count = np.unique(kind[order], return_index=True, return_counts=True)
            rank = np.arange(len(order)) - np.repeat(begin, count)
            sorted_kind = kind[order]
            full = rank < np.repeat(count // kinds * kinds, count)
            placed = order[full]
            if len(placed):
                opens = rank[full] % sorted_kind[full] == 0
                number = np.cumsum(opens) - 1
                ahead = np.cumsum(length[placed]) - length[placed]
                offset = ahead - ahead[opens][number]
                yield from _with_place(table.take(placed), first + made + number, offset)
                made += int(number[-1]) + 1
            held = table.take(order[~full])
        if held is not None and len(held):
            if last:
                number, offset, order = _decreasing(held.column("length").to_numpy(), capacity)
                yield from _with_place(held.take(order), first + made + number, offset)
            else:
                empty = pa.nulls(len(held), pa.int64())
                yield from _with_place(held, empty, empty)

    return run


def _with_place(table: pa.Table, sequence, offset) -> list[pa.RecordBatch]:
    table = table.append_column("sequence_id", pa.array(sequence, pa.int64()))
    return table.append_column("offset", pa.array(offset, pa.int64())).combine_chunks().to_batches()


def _decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place pieces by decreasing length, each into an open bin with the least room that takes it."""
    order = np.argsort(-lengths, kind="stable")
    number, offset = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = 0
    for k, length in enumerate(lengths[order].tolist()):
        room = next((r for r in range(length, capacity) if by_room[r]), capacity)
        if room < capacity:
            at = by_room[room].pop()
        else:
            at, bins = bins, bins + 1
        number[k], offset[k] = at, capacity - room
        by_room[room - length].append(at)
    return number, offset, order


def pack(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document; one row per piece with its place.

    ``sequence_id`` names the level, the worker and the bin; ids are distinct and not dense. Pieces of a
    sequence lie gapless from offset 0. Every id of every document is in exactly one piece.
    """
    chosen = in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    open_pieces = stage(piece_table(chosen, tokenizer, end_id, capacity), "pieces")
    workers = open_pieces.rdd.getNumPartitions()
    done: list[DataFrame] = []
    level = 0
    while True:
        last = workers <= 1
        placed = open_pieces.mapInArrow(_fill(level, last, capacity), PLACED)
        if last:
            done.append(placed)
            break
        placed = stage(placed, f"packed-{level}")
        done.append(placed.where("sequence_id is not null"))
        workers = -(-workers // FAN_IN)
        open_pieces = placed.where("sequence_id is null").select(*_NAMES).coalesce(workers)
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result
