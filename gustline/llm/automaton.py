"""Suffix automata of reference texts, and the passages of documents that occur in them.

A reference is cut into shards of a bounded number of words. The suffix automaton of a shard accepts every
run of its words; it is built word by word, then kept in flat arrays: the longest run and the suffix link
of each state, and the transitions sorted by state and word. Shards are sent to all tasks, one after the
other. Documents are streamed through them in step, a batch at a time: each word takes the transition, or
suffix links are followed until there is one, so every word knows how many words up to it occur in the
reference (its matching statistic). Spans whose statistic reaches ``size`` are removed.

Nulls: a null text has no words. Texts of the reference are separate: no run crosses from one to the next;
one that is longer than a shard is cut with an overlap of ``size`` - 1 words, so that no passage of ``size``
is lost. Repeated rows, empty tables and other columns make no difference.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.words import Words, chunks

SHARD_WORDS = 1 << 18  # words of a shard, at most


@dataclass(frozen=True)
class Automaton:
    """``words`` are the known word hashes, sorted; transitions are keyed state << 24 | place of the word."""

    words: np.ndarray
    longest: np.ndarray
    link: np.ndarray
    keys: np.ndarray
    targets: np.ndarray

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.words, self.longest, self.link, self.keys, self.targets))

    def statistics(self, words: Words) -> np.ndarray:
        """For each word, the number of words up to it (of its text) that occur together in the shard."""
        place = np.minimum(np.searchsorted(self.words, words.hashes), len(self.words) - 1)
        place = np.where(self.words[place] == words.hashes, place, -1)
        found = np.zeros(len(place), np.int32)
        size = np.diff(words.first)
        order = np.argsort(-size, kind="stable")  # texts in step, the longest first
        state, length = np.zeros(len(order), np.int64), np.zeros(len(order), np.int32)
        for step in range(int(size.max(initial=0))):
            live = order[: int(np.searchsorted(-size[order], -step, "left"))]
            at = words.first[live] + step
            symbol, todo = place[at], np.arange(len(live))
            unknown = symbol < 0
            state[live[unknown]] = 0
            length[live[unknown]] = 0
            todo = todo[~unknown]
            while len(todo):
                own = live[todo]
                key = (state[own] << 24) | symbol[todo]
                hit = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                good = self.keys[hit] == key
                moved = own[good]
                state[moved] = self.targets[hit[good]]
                length[moved] += 1
                stuck = own[~good]
                root = state[stuck] == 0
                length[stuck[root]] = 0
                back = stuck[~root]
                state[back] = self.link[state[back]]
                length[back] = self.longest[state[back]]
                todo = todo[~good][~root]
            found[at] = length[live]
        return found


def build(texts: list[np.ndarray]) -> Automaton:
    """The automaton of texts given as word hashes."""
    known = np.unique(np.concatenate([np.empty(0, np.uint64), *texts]))
    longest, link, after = [0], [-1], [{}]
    for text in texts:
        last = 0
        for c in np.searchsorted(known, text).tolist():
            q = after[last].get(c)
            if q is not None and longest[q] == longest[last] + 1:
                last = q  # known already
                continue
            clone_only = q is not None
            if not clone_only:
                cur = len(longest)
                longest.append(longest[last] + 1)
                link.append(0)
                after.append({})
                p = last
                while p >= 0 and c not in after[p]:
                    after[p][c] = cur
                    p = link[p]
                if p < 0:
                    last = cur
                    continue
                q = after[p][c]
                if longest[q] == longest[p] + 1:
                    link[cur] = q
                    last = cur
                    continue
            else:
                p = last
            clone = len(longest)
            longest.append(longest[p] + 1)
            link.append(link[q])
            after.append(dict(after[q]))
            while p >= 0 and after[p].get(c) == q:
                after[p][c] = clone
                p = link[p]
            link[q] = clone
            if clone_only:
                last = clone
            else:
                link[cur] = clone
                last = cur
    keys = np.array([(s << 24) | c for s, own in enumerate(after) for c in own], np.int64)
    targets = np.array([t for own in after for t in own.values()], np.int32)
    order = np.argsort(keys)
    return Automaton(known, np.array(longest, np.int32), np.array(link, np.int32), keys[order], targets[order])


def shards(reference: DataFrame, *, size: int, words: int = SHARD_WORDS) -> Iterator[list[np.ndarray]]:
    """Word hashes of the reference's distinct texts, in groups of at most ``words`` words (a small table)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in chunks(batch.column(0)):
                rows = [found.hashes[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["words"])

    group: list[np.ndarray] = []
    held = 0
    for row in reference.select("text").where("text is not null").distinct().mapInArrow(hashed, "words binary").toLocalIterator():
        text = np.frombuffer(row.words, np.uint64)
        for begin in range(0, max(1, len(text) - size + 1), max(1, words - size + 1)):
            part = text[begin : begin + words]
            if len(part) < size:
                continue
            if held + len(part) > words and group:
                yield group
                group, held = [], 0
            group.append(part)
            held += len(part)
    if group:
        yield group


def remove_referenced(docs: DataFrame, reference: DataFrame, *, size: int = 20, words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each document: its words without the spans of ``size`` words or more
    that occur in the reference, a table small enough to be sent to all tasks shard by shard."""
    context = docs.sparkSession.sparkContext
    sent = [context.broadcast(build(group)) for group in shards(reference, size=size, words=words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, found in chunks(batch.column(1)):
                ends = np.zeros(len(found.hashes), bool)
                for shard in sent:
                    ends |= shard.value.statistics(found) >= size
                steps = np.zeros(len(ends) + 1, np.int64)
                last = np.flatnonzero(ends)
                np.add.at(steps, last - size + 1, 1)
                np.add.at(steps, last + 1, -1)
                gone = np.cumsum(steps)[:-1] > 0
                raw, kept, removed = found.data.tobytes(), [], []
                for a, b in zip(found.first[:-1], found.first[1:], strict=True):
                    kept.append(b" ".join(raw[found.starts[k] : found.ends[k]] for k in range(a, b) if not gone[k]).decode())
                    removed.append(int(gone[a:b].sum()))
                columns = [batch.column(0).slice(at, found.rows), pa.array(np.diff(found.first)), pa.array(removed, pa.int64()), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")
