"""Quality rules: a hashed n-gram log-likelihood ratio beside counts of plain faults.

Words and word pairs are known by 64-bit hashes. The cells of two multinomials, one of the trusted target
and one of the raw corpus, come from labelled rows: at most ``SAMPLE`` of them (those with the least hashes
of their ids) are dealt into halves by another hash. N-grams that two documents of the first half hold,
good or bad, have a cell each; others share the cells of their shapes. The target is counted over the
good documents of the second half, so that n-grams without a cell get the share that unseen good text has
of them; the raw corpus is counted over all rows, and brought to the target's size. One is added to each
cell. So the cells do not fill or multiply as the corpus grows, while their raw counts follow all of it.

A document's score is the mean of log(target / raw) over its n-grams, so its length does not matter, and
it is kept when the score reaches the threshold and no base rule rejects it. Counts are integers summed
over all tasks, so scores do not depend on the partitioning.

Base counts, over words as in ``words``: characters in words; characters out of ``#*$%&|<>``; lines
with a word that equal an earlier line; words inside 8-word windows that occur twice or more in the
text, the first included. A document fails them with fewer than ``MIN_WORDS`` words, or with more than
``MAX_REPEATED`` percent of its words in repeated windows.

Nulls: a null text has no words and fails; a null id or label is not used. Of contradicting labels of one
id the worse counts. Of rows with one id and different texts one gives cells; all are counted and judged.
Repeated rows are counted and judged one by one. Other columns are ignored by ``judge`` and passed on by
``keep_good``. An empty table gives an empty result; without labels every score is 0 and the base rules
decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.names import numbered
from gustline.llm.words import Words, chunks, in_small_batches, lean
from gustline.session import stage

SAMPLE = 8192  # labelled rows that cells and target are taken from, at most
DOCUMENTS = 2  # documents of the first half that must hold an n-gram with a cell of its own
THRESHOLD = -0.7  # mean log ratio; see the README for the scores of good text and junk
MIN_WORDS = 20
MAX_REPEATED = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# Kinds of bytes, for the shapes of n-grams without a cell of their own.
_KIND = np.full(256, 5, np.int64)  # beyond ASCII
_KIND[:128] = 4  # other marks and controls
for _k, _group in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?")):
    _KIND[list(_group)] = _k
_KINDS = 6
_WORD_SHAPES, _PAIR_SHAPES = _KINDS**3, 2 * _KINDS**2
SHAPES = _WORD_SHAPES + _PAIR_SHAPES


@dataclass(frozen=True)
class Ratios:
    """``hashes`` of the n-grams with cells, sorted, and the log ratio of each cell; behind those of the
    hashes stand the cells of the shapes."""

    hashes: np.ndarray
    values: np.ndarray


def ngram_cells(words: Words, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and row of every word and word pair.

    A word without a cell of its own has that of its shape: the kinds of its first byte and of its last
    two; a pair that of the kinds where its words meet, and whether they are the same.
    """
    row = words.row
    pairs, at = words.windows(2)
    first, last = _KIND[words.data[words.starts]], _KIND[words.data[words.ends - 1]]
    inner = _KIND[words.data[np.maximum(words.starts, words.ends - 2)]]
    shape = (first * _KINDS + inner) * _KINDS + last
    meet = (last[at] * _KINDS + first[at + 1]) * 2 + (words.hashes[at] == words.hashes[at + 1])
    cells = np.concatenate([_cells(words.hashes, known, shape), _cells(pairs, known, _WORD_SHAPES + meet)])
    return cells, np.concatenate([row, row[at]])


def _cells(hashes: np.ndarray, known: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    if not len(known):
        return shapes
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, len(known) + shapes)


def repeated_words(words: Words, size: int) -> np.ndarray:
    """Words of each row inside windows of ``size`` words that the row holds more than once."""
    hashes, at = words.windows(size)
    row = words.row
    order = np.lexsort((hashes, row[at]))
    sorted_hash, sorted_row = hashes[order], row[at][order]
    same = (sorted_hash[1:] == sorted_hash[:-1]) & (sorted_row[1:] == sorted_row[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begin = at[order[twice]]
    steps = np.bincount(begin, minlength=len(row) + 1) - np.bincount(begin + size, minlength=len(row) + 1)
    covered = np.cumsum(steps)[: len(row)] > 0
    return np.bincount(row[covered], minlength=words.rows)


def repeated_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    return again


def faults(words: Words, texts: pa.Array) -> dict[str, np.ndarray]:
    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return np.diff(total[words.offsets])

    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    inside = np.cumsum(inside[:-1]) > 0 if len(words.data) else np.empty(0, bool)
    # two words meet without a gap only where one text ends and the next begins
    return {
        "n_words": np.diff(words.first),
        "word_chars": per_row(inside & ((words.data & 0xC0) != 0x80)),
        "n_symbols": per_row(_SYMBOL[words.data]),
        "n_dup_lines": np.array([repeated_lines(t.as_py()) for t in texts], np.int64),
        "n_repeat_words": repeated_words(words, 8),
    }


def labelled(labels: DataFrame, *, rows: int = SAMPLE) -> DataFrame:
    """(doc_id, good, second) of at most ``rows`` labelled ids: whether they are good and in the second half."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg((F.min("quality") >= 1).alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return stage(chosen.withColumn("second", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 1), "labelled")


def _vocabulary(docs: DataFrame, chosen: DataFrame) -> np.ndarray:
    """Sorted hashes of the n-grams that enough documents of the first half hold."""

    @lean
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in chunks(batch.column(0)):
                pairs, at = words.windows(2)
                row = words.row
                hashes, row = np.concatenate([words.hashes, pairs]), np.concatenate([row, row[at]])
                order = np.lexsort((row, hashes))
                hashes, row = hashes[order], row[order]
                once = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])) if len(hashes) else np.empty(0, bool)
                found, n = np.unique(hashes[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["h", "n"])

    texts = docs.join(F.broadcast(chosen.where("not second").select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    counts = texts.select("text").mapInArrow(held, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return np.sort(counts.where(F.col("n") >= DOCUMENTS).select("h").toArrow()["h"].to_numpy().view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Ratios:
    """Log ratio of each cell. ``docs`` has doc_id and text, ``labels`` doc_id and quality (1 for good).

    The driver gets the cells, which the bound of the sample bounds; every task sends the counts of the
    cells that it met.
    """
    docs = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = labelled(labels, rows=sample)
    known = _vocabulary(docs, chosen)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros((2, len(shared.value) + SHAPES), np.int64)
        for batch in batches:
            flag = batch.column(1).to_numpy(zero_copy_only=False)
            for at, words in chunks(batch.column(0)):
                cells, row = ngram_cells(words, shared.value)
                raw += np.bincount(cells, minlength=len(raw))
                trusted = flag[at : at + words.rows]
                if trusted.any():
                    good += np.bincount(cells[trusted[row]], minlength=len(raw))
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, raw[used], good[used])], ["cell", "n_raw", "n_good"])

    target = chosen.where("good and second").select("doc_id", F.lit(True).alias("target"))
    rows = docs.join(F.broadcast(target), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = rows.mapInArrow(count, "cell long, n_raw long, n_good long")
    sums = counts.groupBy("cell").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_good").alias("n_good")).toArrow()
    raw, good = np.zeros((2, len(known) + SHAPES))
    raw[sums["cell"].to_numpy()] = sums["n_raw"].to_numpy()
    good[sums["cell"].to_numpy()] = sums["n_good"].to_numpy()
    raw *= good.sum() / max(1.0, raw.sum())  # to the size of the target, so that one more weighs the same
    return Ratios(known, np.log(good + 1) - np.log(raw + 1))


def _judged(batch: pa.RecordBatch, at_text: int, ratios: Ratios, threshold: float) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    texts = batch.column(at_text)
    for at, words in chunks(texts):
        found = faults(words, texts.slice(at, words.rows))
        cells, row = ngram_cells(words, ratios.hashes)
        total = np.bincount(row, weights=ratios.values[cells], minlength=words.rows)
        found["score"] = total / np.maximum(np.bincount(row, minlength=words.rows), 1)
        n, repeated = found["n_words"], found["n_repeat_words"]
        found["base_failed"] = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n)
        found["kept"] = ~found["base_failed"] & (found["score"] >= threshold)
        yield at, found


def judge(docs: DataFrame, ratios: Ratios, *, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, score and verdict of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _judged(batch, 1, shared.value, threshold):
                columns = [batch.column(0).slice(at, len(x["kept"])), *(pa.array(x[c], pa.int64()) for c in _COUNTS)]
                columns += [pa.array(x[c]) for c in ("base_failed", "score", "kept")]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_COUNTS, "base_failed", "score", "kept"])

    return in_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, JUDGED)


def keep_good(docs: DataFrame, ratios: Ratios, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with all their columns."""
    at_text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [x["kept"] for _, x in _judged(batch, at_text, shared.value, threshold)]
            if kept:
                yield batch.filter(pc.cast(pa.array(np.concatenate(kept)), pa.bool_()))

    plain = numbered(in_small_batches(docs))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
