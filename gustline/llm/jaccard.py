"""Documents whose sets of word shingles overlap, by a join on rare-first prefixes.

A document's set holds its distinct shingles of ``size`` words (A-Z lower-cased); a shorter text is one
shingle of all its words, a text without words has an empty set and links with nothing. Two documents
link when the Jaccard similarity of their sets is at least ``percent`` / 100.

1. One pass gives each document its set size and a 128-bit signature of its set, and counts shingles
   in ``CELLS`` cells. Shingles are ordered by the count of their cell, rare first, then by hash. The
   order is the same for all documents, which is all that the filters need to be exact; the counts, taken
   over all rows, only keep frequent shingles out of the prefixes.
2. Documents with equal signatures have equal sets and form a class at once.
3. The first n - ceil(t n) + 1 shingles of each set are its prefix. Sets that link share a shingle
   between their prefixes; ``repeats`` finds the documents whose prefix has one that is not theirs alone.
4. Among those documents all shingles are looked up, so it is known which are unique. Unique shingles
   come first in the order now, and the prefix is taken again: a document with more of them than its
   prefix holds links with nothing and leaves. The number of shingles that are not unique bounds the
   overlap with any other set (a filter on what lies behind the prefix, by counts).
5. Documents that share a prefix shingle are compared in rounds. In the first ``STAR_ROUNDS`` every
   shingle has one hub, the set with the fewest unique shingles, ties by a hash that changes with the
   round; the others are compared with the hub only, if not yet connected with it. So a large group of
   near copies takes pairs in proportion to its size. Then the pairs that remain unconnected and
   uncompared are compared: in groups of up to ``PAIR_BLOCK`` sets by a join, so a set meets a bounded
   number of others; larger groups are dealt into blocks of that size, and each two blocks are compared in
   a task of their own, which sends on only the pairs that pass. Pairs pass length, count and positional
   filters, in blocks also a bound on the overlap by bitmaps of the sets' shared shingles; each pair is
   verified once, after a suffix filter, on the whole sets.
6. Links are contracted to components after each round; links inside a component cannot change it.

Nulls: a null text has no words. Rows without id form no links and get no component. Rows with one id
and different texts count as one node. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.functions.signals import quoted
from gustline.llm.components import components
from gustline.llm.names import fresh
from gustline.llm.repeats import repeated, text_bytes
from gustline.llm.words import Words, chunks, in_small_batches, lean, mix
from gustline.session import stage

SIZE = 5
PERCENT = 80
CELLS = 1 << 17
STAR_ROUNDS = 2
PAIR_BLOCK = 512  # sets of one shingle that are joined with each other, at most; more are compared by blocks
BITMAP = 1024  # bits of a set's bitmap
BROADCAST_ROWS = 1 << 21  # ids sent to all tasks at most; more are joined by a shuffle

_PASS = "cell long, amount long, doc_id long, n_shingles long, sig long, sig2 long"


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    hashes, at = words.windows(size)
    cut = np.searchsorted(at, words.first)
    for k in range(words.rows):
        a, b = cut[k], cut[k + 1]
        first, last = words.first[k], words.first[k + 1]
        if a == b and first < last:  # fewer words than a shingle has
            with np.errstate(over="ignore"):
                total = np.uint64(last - first)
                for x in words.hashes[first:last]:
                    total = total * np.uint64(0x9E3779B97F4A7C15) + x
            yield mix(np.array([total], np.uint64))
        else:
            yield np.unique(hashes[a:b])


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """Set size and signature of each document, and the counts of the cells of each task."""

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        names = ["cell", "amount", "doc_id", "n_shingles", "sig", "sig2"]
        for batch in batches:
            n, sig, sig2 = [], [], []
            for _, words in chunks(batch.column(1), lower=True):
                sets = list(shingle_sets(words, size))
                for own in sets:
                    n.append(len(own))
                    sig.append(int(own.sum(dtype=np.uint64).view(np.int64)))
                    sig2.append(int(mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                cells += np.bincount((np.concatenate(sets) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, batch.column(0), *(pa.array(x, pa.int64()) for x in (n, sig, sig2))], names)
        used = np.flatnonzero(cells)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used]), none, none, none, none], names)

    return docs.mapInArrow(scan, _PASS)


def prefix(own: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a sorted set, as many as a linked set must share one of."""
    length = len(own) - -(-percent * len(own) // 100) + 1 if len(own) else 0
    rank = np.argsort(counts[(own % np.uint64(len(counts))).astype(np.int64)], kind="stable")
    return own[rank[:length]]


def _prefixes(docs: DataFrame, counts: Broadcast, size: int, percent: int, volume: int) -> DataFrame:
    def emit(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy()
        for at, words in chunks(batch.column(1), lower=True):
            parts = [prefix(own, counts.value, percent) for own in shingle_sets(words, size)]
            yield _entries(ids[at : at + words.rows], parts)

    return repeated(docs, emit, size=volume)


def _entries(ids: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes = np.concatenate(parts)
    none = np.zeros(len(hashes), np.uint32)
    return hashes, none, np.repeat(ids, [len(x) for x in parts]), none.astype(np.int64)


def _second_prefixes(texts: DataFrame, sizes: DataFrame, counts: Broadcast, size: int, percent: int, volume: int) -> DataFrame:
    """Prefix shingles (h, rep, n, shared, at, bits) with unique ones, which are left out, in front; the set's
    bitmap stands in its first row only."""

    def emit(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy()
        for at, words in chunks(batch.column(1), lower=True):
            yield _entries(ids[at : at + words.rows], list(shingle_sets(words, size)))

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            maps: list[bytes | None] = []
            for rep, n, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = np.sort(row.values.to_numpy().view(np.uint64))
                unique = n - len(own)
                length = n - -(-percent * n // 100) + 1 - unique
                if length > 0:
                    rank = np.argsort(counts.value[(own % np.uint64(len(counts.value))).astype(np.int64)], kind="stable")
                    first = own[rank[:length]].view(np.int64)
                    same = np.ones(len(first), np.int64)
                    out.append((first, rep * same, n * same, len(own) * same, unique + np.arange(len(first))))
                    maps += [bitmap(own), *[None] * (len(first) - 1)]
            if out:
                columns = [*(pa.array(np.concatenate(x)) for x in zip(*out, strict=True)), pa.array(maps, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["h", "rep", "n", "shared", "at", "bits"])

    lists = repeated(texts, emit, size=volume).groupBy("doc_id").agg(F.collect_list("h").alias("hashes"))
    rows = lists.join(sizes, "doc_id").select(F.col("doc_id").alias("rep"), "n", "hashes")
    return rows.mapInArrow(cut, "h long, rep long, n long, shared long, at long, bits binary")


def bitmap(own: np.ndarray) -> bytes:
    """One bit for each hashed value of a set. Two sets of a and b values whose bitmaps differ in d places have
    at most (a + b - d) / 2 values in common: each place that differs has a value that only one of them has."""
    bits = np.zeros(BITMAP, bool)
    bits[(mix(own) % np.uint64(BITMAP)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _overlap(n: str, m: str, percent: int) -> str:
    """SQL for the least common part of two sets of n and m that link, times 100 + percent."""
    return f"{percent} * ({n} + {m})"


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 4) -> int:
    """At most so many values are in both sorted sets: cut one at its middle and the other there too."""
    if not depth or not len(a) or not len(b):
        return min(len(a), len(b))
    middle = a[len(a) // 2]
    cut, there = len(a) // 2, int(np.searchsorted(b, middle))
    return suffix_bound(a[:cut], b[:there], depth - 1) + suffix_bound(a[cut:], b[there:], depth - 1)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    needed = percent * (len(a) + len(b))
    if (100 + percent) * suffix_bound(a, b) < needed:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common) and common > 0


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, each compared once on the whole texts."""
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for _, words in chunks(column, lower=True):
            yield from shingle_sets(words, size)

    @lean
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(x, y, percent) for x, y in zip(sets(batch.column(2)), sets(batch.column(3)), strict=True)]
            if any(good):
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row of each document whose id is in ``ids`` (a staged frame)."""
    few = ids.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def groups(docs: DataFrame, *, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document; a component's id is its least document id."""
    docs = in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scanned = stage(_scan(docs, size), "shingle-scan")
    counts = np.zeros(CELLS, np.int64)
    cells = scanned.where("cell is not null").groupBy("cell").agg(F.sum("amount").alias("amount")).toPandas()
    counts[cells["cell"]] = cells["amount"]
    members = scanned.where("cell is null").select("doc_id", "n_shingles", "sig", "sig2")

    classes = members.where("n_shingles > 0 and doc_id is not null").groupBy("sig", "sig2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = stage(classes, "classes")
    keyed = members.where("n_shingles > 0 and doc_id is not null")
    keyed = stage(keyed.join(classes, ["sig", "sig2", "n_shingles"]).select("doc_id", "n_shingles", "rep").distinct(), "members")

    shared = docs.sparkSession.sparkContext.broadcast(counts)
    volume = text_bytes(docs)
    found = _prefixes(docs.where("doc_id is not null"), shared, size, percent, volume).select("doc_id").distinct()
    ids = stage(keyed.join(found, "doc_id").select(F.col("rep").alias("doc_id")).distinct(), "candidate-ids")
    texts = stage(_chosen(docs, ids), "candidate-texts")
    if texts.count() > ids.count():  # ids are repeated
        texts = stage(texts.dropDuplicates(["doc_id"]), "candidate-texts")
    sizes = keyed.where("doc_id = rep").groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    entries = stage(_second_prefixes(texts, sizes, shared, size, percent, volume), "entries")
    ids = stage(entries.select(F.col("rep").alias("doc_id")).distinct(), "compared-ids")
    texts = stage(_chosen(texts, ids), "compared-texts")

    component = keyed.select(F.col("rep").alias("node"), F.col("rep").alias("comp")).distinct()
    tested = None
    for number in range(STAR_ROUNDS + 1):
        placed = entries.join(component, F.col("rep") == F.col("node")).drop("node") if number else entries.withColumn("comp", F.col("rep"))
        hub = F.struct((F.col("n") - F.col("shared")).alias("unique"), F.xxhash64("rep", F.lit(number)), "rep", "n", "shared", "at", "comp")
        spread = placed.groupBy("h").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("least_n"), F.min(hub).alias("hub"), F.count(F.lit(1)).alias("sets")
        )
        # only shingles that more than one component has go on, and sets large enough for some other there
        hubs = stage(spread.where("low < high").select("h", "least_n", "hub", "sets"), "hubs")
        open_entries = placed.join(hubs, "h").where(f"{100 + percent} * shared >= {_overlap('n', 'least_n', percent)}")
        if number < STAR_ROUNDS:
            pairs = _filtered(
                open_entries.where("comp <> hub.comp").selectExpr(
                    "rep", "n", "shared", "at", "hub.rep as rep2", "hub.n as n2", "hub.shared as shared2", "hub.at as at2"
                ), percent,
            )
        else:
            last = open_entries.select("h", "rep", "n", "shared", "at", "comp", "sets")
            maps = entries.where("bits is not null").select(F.col("rep").alias("of"), "bits")
            pairs = _remaining_pairs(stage(last, "open-entries"), maps, percent)
        pairs = pairs.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = stage(_verified(pairs, texts, size, percent), "links")
        if not links.isEmpty():
            edges = links.join(component.withColumnsRenamed({"node": "a", "comp": "ca"}), "a")
            edges = edges.join(component.withColumnsRenamed({"node": "b", "comp": "cb"}), "b")
            joined = components(edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            joined = joined.select(F.col("node").alias("comp"), "component")
            component = stage(
                component.join(joined, "comp", "left").select("node", F.coalesce("component", "comp").alias("comp")), "component"
            )

    named = keyed.join(component, F.col("rep") == F.col("node")).select("doc_id", F.col("comp")).groupBy("doc_id").agg(F.min("comp").alias("comp"))
    return members.join(named, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))


def _filtered(pairs: DataFrame, percent: int) -> DataFrame:
    """Length filter, count filter and positional filter: what can follow the shared shingle in both sets
    must do.

    The last bound holds at the first shingle that both prefixes have, which is enough: a linked pair
    passes there.
    """
    needed = _overlap("n", "n2", percent)
    return pairs.where(
        f"100 * least(n, n2) >= {percent} * greatest(n, n2) and {100 + percent} * least(shared, shared2) >= {needed} "
        f"and {100 + percent} * least(n - at, n2 - at2) >= {needed}"
    )


_COMPARED = ("rep", "n", "shared", "at", "comp")


def _remaining_pairs(entries: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs (rep, rep2) of one shingle that are in different components and pass the filters."""
    left = entries.where(F.col("sets") <= PAIR_BLOCK).select("h", *_COMPARED)
    right = left.select("h", *(F.col(c).alias(f"{c}2") for c in _COMPARED))
    pairs = _filtered(left.join(right, "h").where("rep < rep2 and comp <> comp2"), percent).select("rep", "rep2")
    large = entries.where(F.col("sets") > PAIR_BLOCK)
    if large.isEmpty():
        return pairs
    blocks = F.ceil(F.col("sets") / PAIR_BLOCK).cast("long")
    own = F.pmod(F.xxhash64("rep", "h"), blocks)
    held = large.join(maps, F.col("rep") == F.col("of")).select("h", *_COMPARED, "bits", own.alias("own"), blocks.alias("blocks"))
    held = held.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    held = held.select("h", *_COMPARED, "bits", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        return _block_pairs(table, key[1].as_py(), key[2].as_py(), percent)

    return pairs.unionByName(held.groupBy("h", "low", "high").applyInArrow(compare, "rep long, rep2 long"))


def _block_pairs(table: pa.Table, low: int, high: int, percent: int) -> pa.Table:
    """The pairs of two blocks of one shingle (or within one) that pass the filters."""
    rep, n, shared, at, comp, own = (table.column(c).to_numpy() for c in (*_COMPARED, "own"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(rep), -1)
    first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
    found: list[np.ndarray] = []
    for k in first:
        needed = percent * (n[k] + n[second])
        good = (comp[k] != comp[second]) & (rep[k] != rep[second]) & (100 * np.minimum(n[k], n[second]) >= percent * np.maximum(n[k], n[second]))
        good &= (100 + percent) * np.minimum(shared[k], shared[second]) >= needed
        good &= (100 + percent) * np.minimum(n[k] - at[k], n[second] - at[second]) >= needed
        if low == high:
            good &= second > k
        near = second[good]
        apart = np.bitwise_count(bits[k] ^ bits[near]).sum(axis=1, dtype=np.int64)
        near = near[(100 + percent) * (shared[k] + shared[near] - apart) >= 2 * needed[good]]
        found.append(np.stack([np.full(len(near), rep[k]), rep[near]]))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    return pa.table([pa.array(pairs.min(axis=0)), pa.array(pairs.max(axis=0))], ["rep", "rep2"])


def keep_one(docs: DataFrame, *, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents with all their columns, one of each group: that with the least id, rows without id last.

    Rows of one id and different texts are documents of their own: where there are such rows, or rows without
    id, documents are known by a 64-bit hash of id and text. Of equal rows one stays.
    """
    mark = fresh("row_mark", docs.columns)
    text = F.xxhash64(F.lit(0), F.col("text").isNull(), "text")
    held = docs.select("doc_id", text.alias("h")).groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    own = held.where("doc_id is null or low <> high").isEmpty()  # then ids tell all texts apart, and pack better than hashes
    marked = docs.withColumn(mark, F.col("doc_id").cast("long") if own else F.xxhash64(F.lit(0), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    found = stage(groups(marked.select(F.col(mark).alias("doc_id"), "text"), size=size, percent=percent), "groups")
    members = found.groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("times"))
    members = stage(members, "group-members")
    large = members.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    several = stage(members.join(large, "component_id").select(F.col("doc_id").alias("m"), "component_id"), "copies")
    ids = marked.select(F.col(mark).alias("m"), F.col("doc_id").alias("id"))
    rank = F.struct(F.col("id").isNull().alias("unknown"), "id", "m")
    named = _few(several).join(ids, "m").groupBy("component_id").agg(F.min(rank).alias("least"))
    kept = stage(named.select(F.col("least.m").alias("m")), "kept-copies")
    gone = stage(several.select("m").join(kept, "m", "left_anti").select(F.col("m").alias(mark)), "left-out")
    rest = marked.join(_few(gone), mark, "left_anti")
    twice = stage(members.where("times > 1").select(F.col("doc_id").alias(mark)), "equal-rows")
    if not twice.isEmpty():
        few = _few(twice)
        rest = rest.join(few, mark, "left_anti").unionByName(rest.join(few, mark, "left_semi").dropDuplicates([mark]))
    return rest.select(*(F.col(quoted(c)) for c in docs.columns))


def _few(frame: DataFrame) -> DataFrame:
    """The (staged) frame, to be sent to all tasks if it is small."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame
