"""Token ids in files of fixed bit width, with random access.

A shard is one file (all numbers little-endian):

- blocks of up to ``BLOCK`` ids, each id in the least bits that hold the vocabulary, least
  significant bit first, each block from a byte boundary;
- the footer: offsets of the blocks (8 bytes each, and their end), ids of the documents (8 bytes
  each), the shard's token position of each document (8 bytes each, and their end);
- the trailer: the offset of the footer, numbers of blocks, documents and tokens, bits per id and the
  magic (six 8-byte numbers).

Id k of a shard is in block k // BLOCK, so any range is read by seeking to its blocks and unpacked by
numpy without a loop over ids.

Shards are written by the tasks themselves through ``pyarrow.fs``, below a folder that all executors
share. A task attempt writes a file of its own name, and only the attempt whose manifest row Spark
commits is ever read; what a lost executor leaves is ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.tokens import encoder
from gustline.session import scratch_path, stage

BLOCK = 8192
_MAGIC = 0x315449424B434150
_TRAILER = 48

MANIFEST = "shard long, path string, docs long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    digits = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(digits.astype(np.uint8), bitorder="little").tobytes()


def unpack_bits(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint64)
    at = np.arange(count, dtype=np.int64) * bits
    value = np.zeros(count, np.uint64)
    for k in range((bits + 14) // 8):
        value |= raw[(at >> 3) + k] << np.uint64(8 * k)
    return ((value >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class ShardWriter:
    """Streams ids into one file; holds one block and the positions of the documents."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.at, self.tokens = 0, 0
        self.blocks, self.docs, self.starts = [], [], []
        self.open: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids)
        self.open.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            self._flush(whole=False)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.open) if self.open else np.empty(0, np.uint32)
        keep = 0 if whole else len(ids) % BLOCK
        for at in range(0, len(ids) - keep, BLOCK):
            data = pack_bits(ids[at : min(at + BLOCK, len(ids) - keep)], self.bits)
            self.blocks.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.open, self.waiting = [ids[len(ids) - keep :]], keep

    def close(self) -> None:
        self._flush(whole=True)
        footer = self.at
        for numbers in ([*self.blocks, self.at], self.docs, [*self.starts, self.tokens]):
            self.out.write(np.asarray(numbers, "<i8").tobytes())
        trailer = [footer, len(self.blocks), len(self.docs), self.tokens, self.bits, _MAGIC]
        self.out.write(np.asarray(trailer, "<i8").tobytes())


class ShardReader:
    """Random access to one shard."""

    def __init__(self, file):
        self.file = file
        file.seek(file.size() - _TRAILER)
        footer, blocks, docs, self.tokens, self.bits, magic = np.frombuffer(file.read(_TRAILER), "<i8").tolist()
        if magic != _MAGIC:
            raise ValueError("not a shard of packed ids")
        file.seek(footer)
        numbers = np.frombuffer(file.read(8 * (blocks + 1 + docs + docs + 1)), "<i8")
        self.blocks, self.docs, self.starts = np.split(numbers, [blocks + 1, blocks + 1 + docs])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end (exclusive) of the shard."""
        if start >= end:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK, (end - 1) // BLOCK
        self.file.seek(int(self.blocks[first]))
        data = self.file.read(int(self.blocks[last + 1] - self.blocks[first]))
        parts = []
        for block in range(first, last + 1):
            at = int(self.blocks[block] - self.blocks[first])
            to = int(self.blocks[block + 1] - self.blocks[first])
            count = min(BLOCK, self.tokens - block * BLOCK)
            parts.append(unpack_bits(data[at:to], count, self.bits))
        return np.concatenate(parts)[start - first * BLOCK : end - first * BLOCK]

    def documents(self, at_once: int = 64 * BLOCK) -> Iterator[tuple[int, int, np.ndarray]]:
        """Document id, position in the shard and ids, in order, reading about ``at_once`` ids a time."""
        k = 0
        while k < len(self.docs):
            to = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + at_once, "right")) - 1)
            ids = self.ids(int(self.starts[k]), int(self.starts[to]))
            for i in range(k, to):
                a, b = self.starts[i] - self.starts[k], self.starts[i + 1] - self.starts[k]
                yield int(self.docs[i]), int(self.starts[i]), ids[a:b]
            k = to


def _opened(path: str):
    return fs.FileSystem.from_uri(path)


def write_ids(docs: DataFrame, folder: str, *, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, add the end id, write shards in ascending id order; returns the manifest.

    Shards follow each other in id order, as do documents in a shard; rows with equal ids are ordered by
    a hash of their text. A null text counts as empty. A null id has no place in a file of numbers: rows
    without id are left out. Other columns are ignored; an empty table gives an empty manifest.
    """
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("doc_id is not null")
    order = [F.col("doc_id"), F.xxhash64("text")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, writer, path = encoder(tokenizer).encode, TaskContext.get().partitionId(), None, ""
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    path = f"{folder.rstrip('/')}/shard-{shard:07d}-{uuid.uuid4().hex}.ids"
                    system, name = _opened(path)
                    system.create_dir(name.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(name)
                    writer = ShardWriter(out, encoder(tokenizer).bits)
                writer.add(doc, np.append(encode(text.as_py()), np.uint32(end_id)).astype(np.uint32))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": path, "docs": len(writer.docs), "tokens": writer.tokens}],
                pa.schema([("shard", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]),
            )

    rows = chosen.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(rows.mapInArrow(write, MANIFEST), "id-manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the shards: its place among all ids, length and checksum."""
    before = F.expr("sum(tokens) over (order by shard rows between unbounded preceding and 1 preceding)")
    shards = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = _opened(row["path"])
                with system.open_input_file(name) as file:
                    found = [
                        (doc, row["before"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), row["shard"])
                        for doc, start, ids in ShardReader(file).documents()
                    ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

    return shards.repartition(max(1, manifest.count())).mapInArrow(read, DOCUMENTS)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, **options))
