"""Matching statistics and removed spans against plain search."""

import random

import numpy as np
import pyarrow as pa
from conftest_llm import words as plain_words

from gustline.llm import automaton
from gustline.llm.words import chunks


def hashed(texts):
    return [w for _, w in chunks(pa.array(texts, pa.string()))]


def parts(texts):
    (found,) = hashed(texts)
    return [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]


def test_statistics_equal_search():
    random.seed(1)
    for alphabet in (2, 3, 9):
        reference = [" ".join(random.choices("abcdefghi"[:alphabet], k=random.randint(0, 40))) for _ in range(8)]
        built = automaton.build(parts(reference))
        docs = [" ".join(random.choices("abcdefghiz"[: alphabet + 1], k=random.randint(0, 50))) for _ in range(30)] + ["", None, reference[0]]
        (found,) = hashed(docs)
        told = built.statistics(found)
        runs = {tuple(w[i:j]) for w in map(plain_words, reference) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        for k, doc in enumerate(docs):
            w = plain_words(doc)
            want = [next((n for n in range(i + 1, 0, -1) if tuple(w[i + 1 - n : i + 1]) in runs), 0) for i in range(len(w))]
            assert told[found.first[k] : found.first[k + 1]].tolist() == want
    longest = max(len(w) for w in map(plain_words, reference))
    assert built.longest.max() == longest and len(built.longest) <= 2 * sum(len(plain_words(r)) for r in reference) + 1


def plain(docs, reference, size):
    runs = {tuple(w[i : i + size]) for w in map(plain_words, reference) for i in range(len(w) - size + 1)}
    out = {}
    for doc, text in docs:
        w = plain_words(text)
        gone = {k for i in range(len(w) - size + 1) if tuple(w[i : i + size]) in runs for k in range(i, i + size)}
        out.setdefault(doc, []).append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_spans_of_a_reference_are_removed(rows, spark):
    random.seed(2)
    prose = lambda n: " ".join(random.choices([f"w{k}" for k in range(40)], k=n))
    reference = [prose(random.randint(0, 90)) for _ in range(12)] + [None, "", "a b c d e f", prose(700)]
    pieces = [plain_words(r) for r in reference]
    docs = [(k, prose(random.randint(0, 30)) + " " + " ".join((p := random.choice(pieces))[random.randint(0, len(p)) :]) + "\n" + prose(5)) for k in range(40)]
    docs += [(100, None), (101, ""), (None, reference[0]), (3, reference[15]), (102, "x " * 3000 + reference[15])]
    table = spark.createDataFrame([(r,) for r in reference], "text string")
    for limit in (1 << 18, 50):  # a text longer than a shard is cut without losing a passage
        got = automaton.remove_referenced(rows(docs).repartition(3), table, size=6, words=limit).collect()
        want = plain(docs, reference, 6)
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((doc, *x)) for doc, found in want.items() for x in found)
    assert automaton.remove_referenced(rows([]), table).count() == 0
    assert {r.n_removed for r in automaton.remove_referenced(rows(docs), table.limit(0)).collect()} == {0}
    assert all(len(g) and sum(map(len, g)) <= 50 for g in automaton.shards(table, size=6, words=50))
