"""Encoding against a plain one, gradients against differences, accuracy on rows held out."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import words as plain_words

from gustline.llm import passages
from gustline.llm.queries import QUERIES
from gustline.llm.words import chunks


def bags_of(texts):
    return [passages.encode(words) for _, words in chunks(pa.array(texts, pa.string()))]


def test_passages_are_consecutive_words():
    random.seed(1)
    texts = ["", None, " \n ", "one", "two words", "é漢 " * 70, " ".join(f"w{k % 7}" for k in range(64)), " ".join(f"w{k}" for k in range(65)) + " \n", "A B!\t###", "x" * 9]
    (bags,) = bags_of(texts)
    at = 0
    for k, text in enumerate(texts):
        own = plain_words(text)
        parts = [own[i : i + 64] for i in range(0, len(own), 64)] or [[]]
        assert bags.first[k + 1] - bags.first[k] == len(parts)
        for part in parts:
            assert bags.first_word[at + 1] - bags.first_word[at] == len(part)
            figures = bags.figures[at]
            some = max(1, len(part))
            n = len(passages._CLASSES)
            assert figures[n:] == pytest.approx(
                [sum(a == b for a, b in zip(part, part[1:], strict=False)) / some, len(set(part)) / some, sum(len(w.encode()) for w in part) / some / 8, sum(len(w.encode()) == 1 for w in part) / some, len(part) / 64]
            )
            at += 1
    assert at == bags.first[-1] == len(bags.figures)
    last = bags.figures[bags.first[8]]
    assert last[0] == pytest.approx(3 / 8) and last[1] == pytest.approx(1 / 8) and last[4] == pytest.approx(2 / 8)


def test_a_score_does_not_depend_on_its_neighbours():
    random.seed(2)
    texts = [" ".join(random.choices(["a", "b", "C!", "##"], k=random.randint(0, 300))) for _ in range(12)]
    model = passages.Model.fresh()
    together = model.forward(bags_of(texts)[0])["score"]
    assert np.allclose(together, [model.forward(bags_of([t])[0])["score"][0] for t in texts], atol=1e-12)
    weights = model.forward(bags_of(texts)[0])
    assert np.allclose(passages._per_group(weights["a"], bags_of(texts)[0].first), 1)


def test_gradients_equal_differences():
    random.seed(3)
    (bags,) = bags_of([" ".join(random.choices(["a", "b", "C!", "##", "longer"], k=n)) for n in (0, 5, 64, 150, 200)])
    wanted = np.array([0, 1, 0.25, 1, 0])
    model = passages.Model.fresh()
    model["bias"] += 0.1

    def loss():
        s = model.forward(bags)["score"]
        return -(wanted * np.log(s) + (1 - wanted) * np.log(1 - s)).mean()

    for name, slope in model.gradients(bags, wanted).items():
        if name == "words":
            used, slope = slope
            places = [(int(used[0]), 0), (int(used[-1]), passages.VECTOR - 1)]
            told = [slope[0, 0], slope[-1, -1]]
        else:
            places = [np.unravel_index(k, model[name].shape) for k in (0, model[name].size // 2, model[name].size - 1)]
            told = [slope[p] for p in places]
        for place, value in zip(places, told, strict=True):
            old = model[name][place]
            model[name][place] = old + 1e-5
            up = loss()
            model[name][place] = old - 1e-5
            down = loss()
            model[name][place] = old
            assert value == pytest.approx((up - down) / 2e-5, abs=1e-7), name


def test_attention_finds_the_passage_that_decides():
    random.seed(4)
    prose = lambda n: " ".join(random.choices([f"w{k}" for k in range(300)], k=n))
    texts, labels = [], []
    for k in range(300):
        bad = k % 2
        texts.append(prose(64 * random.randint(1, 4)) + (" " + " ".join(random.choices([f"z{j}#" for j in range(50)], k=64)) if bad else "") + " " + prose(64))
        labels.append(1.0 - bad)
    documents = [(bags_of([t])[0], label) for t, label in zip(texts, labels, strict=True)]
    model = passages.train(documents[:200])
    told = [model.forward(bag)["score"][0] for bag, _ in documents[200:]]
    assert np.mean([(s > 0.5) == (label > 0.5) for s, (_, label) in zip(told, documents[200:], strict=True)]) >= 0.97
    again = passages.train(documents[:200])
    assert all((model[name] == again[name]).all() for name in model)


def labelled_scores(spark, folder):
    rows = {r.doc_id: r for r in QUERIES["op13_attention_quality"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    return rows, labels


def test_query_on_rows_held_out(spark):
    rows, labels = labelled_scores(spark, "/root/testdata/sf0.01")
    for doc, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    out = [doc for doc in labels if doc in rows and rows[doc].held_out]
    assert len(out) > 50 and np.mean([rows[doc].predicted == labels[doc] for doc in out]) >= 0.95


def test_odd_rows(rows, spark):
    random.seed(5)
    prose = lambda n: " ".join(random.choices([f"w{k}" for k in range(300)], k=n))
    pairs = [(k, prose(100)) for k in range(60)] + [(100 + k, "## $$ " * 40) for k in range(60)]
    pairs += [(200, None), (201, ""), (202, prose(64 * 300)), (None, prose(50)), (5, "another text"), (5, prose(100)), (3, pairs[3][1])]
    labels = [(k, int(k < 100)) for k, _ in pairs[:120]] + [(None, 1), (1, None), (200, 1), (202, 0), (4, 0), (9999, 1)]
    docs = rows(pairs).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "0.5 as wanted", "1 as toxic")
    model = passages.fit(docs, known)
    result = passages.score(docs, model).collect()
    assert len(result) == len(pairs)
    same = [r.score for r in passages.score(docs.repartition(7), passages.fit(docs.repartition(2), known)).collect()]
    assert sorted(same) == pytest.approx(sorted(r.score for r in result), abs=1e-6)
    assert all(r.score > 0.5 for r in result if r.doc_id is not None and r.doc_id < 60 and r.doc_id not in (4, 5))
    assert all(r.score < 0.3 for r in result if r.doc_id is not None and 100 <= r.doc_id < 160)
    # what is held out is never learned from
    used = {r.doc_id for r in passages.sample(docs, known).collect()}
    assert used and all(zlib.crc32(str(k).encode()) % 5 for k in used) and 202 not in used
    assert len(passages.sample(docs, known, rows=10).collect()) <= 10
    assert passages.score(rows([]), model).count() == 0
    nothing = passages.fit(docs, known.limit(0))
    assert {r.score for r in passages.score(docs, nothing).collect()} == {0.5}
    assert {r.score for r in passages.score(docs, passages.fit(rows([]), known)).collect()} == {0.5}
    flags = docs.select("doc_id", passages.held_out(docs["doc_id"]).alias("h")).collect()
    assert all(r.h for r in flags if r.doc_id is None)
