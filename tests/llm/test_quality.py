"""Counts, scores and verdicts against plain Python."""

import random
from collections import Counter
from math import log

from conftest_llm import words

from gustline.llm import quality
from gustline.llm.words import chunks


def plain_counts(text):
    w = words(text)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
    lines = (text or "").split("\n")
    dup = sum(1 for k, x in enumerate(lines) if words(x) and x in lines[:k])
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def corpus():
    random.seed(7)
    good = [" ".join(random.choices("the of and to in that".split() + [f"w{k}" for k in range(30)], k=random.randint(1, 200))) for _ in range(60)]
    bad = [" ".join(random.choices("### $$ buy | now".split(), k=random.randint(5, 80))) for _ in range(30)]
    odd = ["", None, "a b c d e f g h " * 30, "é漢 <x>\n\n é漢 <x>\né漢 <x>", "x\n \nx\n \n", "one two\x0bthree\x1cfour five", " ".join(good), "w " * 5000]
    return list(enumerate(good + bad + odd))


def kind(byte):
    if byte >= 128:
        return 5
    for k, group in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?")):
        if byte in group:
            return k
    return 4


def cells_of(text, known):
    """Cells of all n-grams: themselves where they are known, else their shapes."""
    w = words(text)
    found = []
    for word in w:
        raw = word.encode()
        found.append(word if word in known else ("word", kind(raw[0]), kind(raw[max(0, len(raw) - 2)]), kind(raw[-1])))
    for a, b in zip(w, w[1:], strict=False):
        found.append((a, b) if (a, b) in known else ("pair", kind(a.encode()[-1]), kind(b.encode()[0]), a == b))
    return found


def labelled_corpus():
    pairs = corpus()
    labels = [(k, int(k < 60)) for k in range(0, 90)] + [(None, 1), (0, 1), (10_000, 1), (3, None), (5, 0)]
    return pairs, labels


def test_judge(rows, spark):
    pairs, labels = labelled_corpus()
    every = [*pairs, (None, "no id " * 30), (3, pairs[3][1]), (4, "another text of one id " * 9)]
    docs = rows(every).repartition(3)
    known_labels = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "1 as good", "2 as second", "3 as n")
    ratios = quality.fit(docs, known_labels)
    again = quality.fit(docs.repartition(7), known_labels)
    assert (ratios.hashes == again.hashes).all() and (ratios.values == again.values).all()
    chosen = {r.doc_id: r for r in quality.labelled(known_labels).collect()}
    assert set(chosen) == set(range(90)) | {10_000} and not chosen[5].good and chosen[0].good

    first = {}
    for doc, text in every:
        if doc in chosen and not chosen[doc].second:
            first[doc] = min(first.get(doc, text) or "", text or "") if doc in first else text
    held = Counter(g for text in first.values() for g in set(words(text)) | set(zip(words(text), words(text)[1:], strict=False)))
    vocabulary = {g for g, n in held.items() if n >= 2}
    assert len(ratios.hashes) == len(vocabulary) > 50
    raw, good = Counter(), Counter()
    for doc, text in every:
        raw.update(cells_of(text, vocabulary))
        if doc in chosen and chosen[doc].good and chosen[doc].second:
            good.update(cells_of(text, vocabulary))
    scale = good.total() / raw.total()

    got = quality.judge(docs, ratios).collect()
    assert len(got) == len(every)
    texts = {}
    for doc, text in every:
        own = cells_of(text, vocabulary)
        score = sum(log(good[g] + 1) - log(raw[g] * scale + 1) for g in own) / len(own) if own else 0
        texts.setdefault(doc, []).append((*plain_counts(text), round(score, 6)))
    for r in got:
        assert (*tuple(r)[1:7], round(r.score, 6)) in texts[r.doc_id]
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)
    kept = quality.keep_good(docs, ratios)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    odd = docs.selectExpr("*", "1 as key_1", "2 as ngram_score", "3 as score", "4 as cell", "5 as `a.b`")
    assert quality.keep_good(odd, ratios).columns == odd.columns and quality.keep_good(odd, ratios).count() == kept.count()


def test_the_threshold_itself_is_kept(rows):
    import numpy as np

    docs = rows([(1, "word " * 5 + " ".join(f"other{k}" for k in range(30)))])
    flat = quality.Ratios(np.empty(0, np.uint64), np.full(quality.SHAPES, quality.THRESHOLD))
    assert abs(quality.judge(docs, flat).first().score - quality.THRESHOLD) < 1e-12
    score = quality.judge(docs, flat).first().score
    assert quality.judge(docs, flat, threshold=score).first().kept and not quality.judge(docs, flat, threshold=score + 1e-9).first().kept


def test_empty_tables(rows, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for docs in (rows([]), rows([(1, "a " * 40), (2, " ".join(f"w{k}" for k in range(40)))])):
        ratios = quality.fit(docs, none)
        assert {r.score for r in quality.judge(docs, ratios).collect()} <= {0.0}
        assert len(ratios.hashes) == 0
    assert {r.doc_id: r.kept for r in quality.judge(docs, ratios).collect()} == {1: False, 2: True}
    assert quality.keep_good(rows([]), ratios).count() == 0


def test_verdicts_do_not_follow_the_size(rows, spark):
    random.seed(8)
    some, marks = [f"v{k}" for k in range(2000)], ["###", "$$$", "&&&"]
    prose = lambda n: " ".join(random.choices(some, k=n))
    junk = lambda n: " ".join(w + random.choice(marks) for w in random.choices(some, k=n))
    bad = set(range(0, 3000, 10))
    pairs = [(k, junk(60) if k in bad else prose(80)) for k in range(3000)]
    labels = spark.createDataFrame([(k, int(k not in bad)) for k in range(0, 3000, 3)], "doc_id long, quality int")
    scores = []
    for size in (600, 3000):
        docs = rows(pairs[:size])
        ratios = quality.fit(docs, labels, sample=200)
        result = {r.doc_id: r for r in quality.judge(docs, ratios).collect()}
        assert all(r.kept == (k not in bad) for k, r in result.items())
        assert len(ratios.hashes) < 12_000
        scores.append([sum(result[k].score for k in range(600) if (k in bad) == junky) / 600 for junky in (False, True)])
    assert abs(scores[0][1] - scores[1][1]) < 0.3 * abs(scores[0][1])


def test_words_of_long_and_short_texts():
    import pyarrow as pa

    texts = ["", "a", None, " a  b ", "x" * (3 << 20), "é " * 10, "漢字 字"]
    found = []
    for at, w in chunks(pa.array(texts)):
        raw = bytes(w.data)
        for k in range(w.rows):
            a, b = w.first[k], w.first[k + 1]
            found.append((at + k, [raw[s:e].decode() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)]))
    assert found == [(k, words(t)) for k, t in enumerate(texts)]
