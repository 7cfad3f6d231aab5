"""Repeated passages against plain Python."""

import random

from conftest_llm import sha, words

from gustline.llm import substring


def plain(pairs, size):
    seen, found = set(), {}
    for doc, text in sorted(pairs, key=lambda p: p[0]):
        w = words(text)
        gone = set()
        for k in range(len(w) - size + 1):
            own = tuple(w[k : k + size])
            if own in seen:
                gone.update(range(k, k + size))
            seen.add(own)
        kept = [x for k, x in enumerate(w) if k not in gone]
        found[doc] = (len(w), len(gone), sha(" ".join(kept)))
    return found


def corpus(seed):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(50)] + ["é", "漢", "A", "a"]
    passages = [random.choices(vocabulary, k=random.randint(15, 60)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [random.choices(vocabulary, k=random.randint(0, 40))]
        for _ in range(random.randint(0, 3)):
            p = random.choice(passages)
            a = random.randint(0, 5)
            parts += [p[a : random.randint(a, len(p))], random.choices(vocabulary, k=random.randint(0, 30))]
        texts.append(random.choice([" ", "\n", " \t"]).join(x for p in parts for x in p))
    texts += [texts[3], texts[4], "", None, " ", "w w " * 40, "w " * 19, "w " * 20, "a b c " * 30, "x " * 3000]
    ids = random.sample(range(-50, 1000), len(texts))
    return list(zip(ids, texts, strict=True))


def test_dedup(rows):
    for seed, size in ((1, 20), (2, 20), (3, 5), (4, 31)):
        pairs = corpus(seed)
        got = substring.dedup(rows(pairs).repartition(3), size=size).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == plain(pairs, size)


def test_shuffled_ranges_give_the_same(rows, monkeypatch):
    monkeypatch.setattr(substring, "BROADCAST_ROWS", -1)
    pairs = corpus(5)
    got = substring.dedup(rows(pairs)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain(pairs, 20)


def test_repeated_rows_nulls_and_empty(rows):
    text = " ".join(f"w{k}" for k in range(30))
    got = substring.dedup(rows([(7, text), (7, text), (None, text), (8, text)])).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in got), key=str) == [(7, 0), (7, 0), (8, 30), (None, 0)]
    assert substring.dedup(rows([])).count() == 0


def test_texts_keep_their_columns(rows):
    text = " ".join(f"w{k}" for k in range(30))
    docs = rows([(1, text), (2, f"a\n {text} b"), (3, "x  y")])
    got = substring.dedup_texts(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: text, 2: "a b", 3: "x  y"}


def test_names_that_clash(rows):
    text = " ".join(f"w{k}" for k in range(30))
    docs = rows([(1, text), (2, text)]).selectExpr("*", "1 as begins", "2 as ends", "3 as _begins", "4 as _ends", "5 as `a.b`")
    kept = substring.dedup_texts(docs)
    assert kept.columns == docs.columns and {r.doc_id: r.text for r in kept.collect()} == {1: text, 2: ""}
