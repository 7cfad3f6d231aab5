"""Groups of similar documents against comparing all pairs."""

import random

import numpy as np
import pytest
from conftest_llm import words

from gustline.llm import jaccard
from gustline.llm.components import components

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def least(ids, edges):
    root = {i: i for i in ids}
    while True:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
        if not changed:
            return root


def brute(pairs):
    sets = {i: shingles(t) for i, t in pairs}
    ids = sorted(sets)
    edges = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[a] & sets[b]
    ]
    root = least(ids, edges)
    return {i: (len(sets[i]), root[i]) for i in ids}


def corpus(seed):
    random.seed(seed)
    texts = []
    for _ in range(12):
        base = random.choices([f"w{k}" for k in range(400)], k=random.randint(1, 120))
        for _ in range(random.randint(1, 9)):
            copy = list(base)
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = random.choice(["x", "Y", "z"])
            texts.append(random.choice([" ", "\n", "\t "]).join(copy))
    texts += ["", None, "  \n", "one", "One", "one two three four", "ONE two three FOUR", "é É", "é é"]
    ids = random.sample(range(1000), len(texts))
    return list(zip(ids, texts, strict=True))


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_groups(rows):
    for seed in (1, 2):
        pairs = corpus(seed)
        assert result(jaccard.groups(rows(pairs).repartition(3))) == brute(pairs)


def test_repeated_rows_nulls_and_empty(rows):
    pairs = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b c d e f"), (9, None)]
    got = sorted(jaccard.groups(rows([*pairs, (None, "a b c d e f")])).collect(), key=str)
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == [(3, 2, 3), (5, 2, 3), (5, 2, 3), (9, 0, 9)]
    assert [tuple(r) for r in got if r.doc_id is None] == [(None, 2, None)]
    assert jaccard.groups(rows([])).count() == 0


def test_chain_of_near_copies_needs_more_than_one_round(rows):
    base = [f"w{k}" for k in range(100)]
    pairs = [(k, " ".join(base[k * 3 : 100] + [f"v{j}" for j in range(k * 3)])) for k in range(14)]
    assert result(jaccard.groups(rows(pairs))) == brute(pairs)


@pytest.mark.parametrize("block", [1, 2, 7])
def test_large_groups_are_compared_by_blocks(rows, monkeypatch, block):
    monkeypatch.setattr(jaccard, "PAIR_BLOCK", block)
    random.seed(block)
    template = [f"w{k}" for k in range(60)]
    pairs = []
    for doc in range(70):  # a family of texts around the threshold, half of them in twos
        own = list(template)
        for place in random.sample(range(60), random.randint(0, 3)):
            own[place] = f"v{random.randrange(6)}"
        pairs.append((doc, " ".join(own)))
    pairs += corpus(block)
    pairs = list({i + 1000 * (k >= 70): (i + 1000 * (k >= 70), t) for k, (i, t) in enumerate(pairs)}.values())
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    assert result(jaccard.groups(rows(pairs).repartition(3))) == brute(pairs)


def test_bitmaps_bound_the_overlap():
    random.seed(6)
    for _ in range(200):
        a, b = (np.array(sorted(random.sample(range(5000), random.randint(1, 900))), np.uint64) for _ in "ab")
        maps = [np.frombuffer(jaccard.bitmap(x), np.uint64) for x in (a, b)]
        apart = int(np.bitwise_count(maps[0] ^ maps[1]).sum())
        assert 2 * len(set(a.tolist()) & set(b.tolist())) <= len(a) + len(b) - apart


def test_suffix_bound_is_never_too_low():
    random.seed(3)
    for _ in range(300):
        a, b = (np.array(sorted(random.sample(range(60), random.randint(0, 40)))) for _ in "ab")
        assert jaccard.suffix_bound(a, b) >= len(set(a.tolist()) & set(b.tolist()))


def test_components(spark):
    random.seed(4)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(100, k) for k in range(200, 300)] + [(k, k + 1) for k in range(400, 440)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    root = least(nodes, edges=[e for e in edges if e[0] != e[1]])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == root and len(got) == len(root)


def test_one_of_each_group_stays_whatever_the_ids(rows):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    near = a + " extra"
    pairs = [(1, a), (1, b), (2, b), (3, near), (4, c), (4, c), (None, c), (None, "z " * 3 + "lone text here"), (None, None), (None, None), (6, None), (7, "")]
    docs = rows(pairs).selectExpr("*", "1 as row_mark", "2 as component_id", "'t' as m", "3 as `a.b`").repartition(3)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (4, c), (None, pairs[7][1]), (None, None), (6, None), (7, "")], key=str)
    assert jaccard.keep_one(rows([])).count() == 0
    plain = rows([(9, a), (4, near), (5, b), (5, b), (6, ""), (7, None)])  # ids that tell all texts apart
    assert sorted(r.doc_id for r in jaccard.keep_one(plain).collect()) == [4, 5, 6, 7]


def test_no_text_is_lost_by_its_id(rows):
    pairs = corpus(5)
    docs = [(i % 7 if i % 3 else None, t) for i, t in pairs]
    kept = [r.text for r in jaccard.keep_one(rows(docs).repartition(4)).collect()]
    sets = [shingles(t) for t in kept]
    by_group = {}
    for k, (_, t) in enumerate(docs):
        by_group[k] = t
    root = brute(list(by_group.items()))
    groups_with_words = {r for k, (n, r) in root.items() if n}
    assert len([s for s in sets if s]) == len(groups_with_words)
    # what went has a copy or near copy among what stays, directly or by others
    left = {root[k][1] for k, t in by_group.items() if t in kept and root[k][0]}
    assert left == groups_with_words
