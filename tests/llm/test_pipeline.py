"""The corpus pipeline against plain Python on a small corpus."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gustline.llm import packing

SECRET = re.compile(r"(token|password) = ([A-Za-z0-9]{6,})")


def corpus():
    random.seed(21)
    vocabulary = [f"{a}{b}" for a in ("the", "and", "of", "wor", "lan", "ti") for b in ("na", "re", "si", "lo", "mu", "ke", "da")]
    prose = lambda n: " ".join(random.choices(vocabulary, k=n))
    docs, gone = {}, set()
    for doc in range(0, 40):
        docs[doc] = prose(random.randint(40, 200))
    for doc in range(40, 46):  # junk
        docs[doc] = " ".join(random.choices(["@@x", "^^q", "~z", "}}w", "{{v"], k=60)) + prose(2)
        gone.add(doc)
    docs[46], docs[47] = "too short", None
    gone |= {46, 47}
    for doc, of in ((50, 3), (51, 3), (52, 7)):  # copies and near copies
        docs[doc] = docs[of] + (" extra" if doc == 51 else "")
        gone.add(doc)
    items = [(k, prose(30)) for k in range(4)]
    for doc, item in ((55, 1), (56, 2)):
        docs[doc] = f"{prose(50)} {items[item][1]} {prose(20)}"
        gone.add(doc)
    docs[60] = f"{prose(40)} token = abcDEF123456 {prose(40)}"
    return docs, items, gone


@pytest.fixture
def tables(spark, tmp_path):
    docs, items, gone = corpus()
    rows = [(doc, text, "en", f"s{doc % 4}", len(text or "")) for doc, text in docs.items()]
    save = lambda df, name: df.write.parquet(str(tmp_path / f"{name}.parquet"))
    save(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "documents")
    save(spark.createDataFrame([(doc, 1, 0) for doc in docs if not 40 <= doc < 50], "doc_id long, quality int, toxic int"), "labels")
    save(spark.createDataFrame(items, "item_id long, text string"), "benchmark")
    return str(tmp_path), docs, gone


def test_pipeline(spark, tables):
    folder, docs, gone = tables
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == set(docs) - gone
    for doc in set(docs) - gone:
        ids = tokenizer.encode(SECRET.sub("[SECRET]", docs[doc]), add_special_tokens=False).ids + [0]
        pieces = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert [(r.start, r.length) for r in pieces] == list(zip(np.cumsum([0, *packing.cuts(len(ids), 1024)])[:-1].tolist(), packing.cuts(len(ids), 1024), strict=True))
        assert all(r.ids_crc32 == zlib.crc32(np.asarray(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in pieces)


def test_stages_keep_the_columns(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert [f.simpleString() for f in out.schema] == [f.simpleString() for f in docs.schema]
        assert step(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.packed(spark, docs.limit(0), folder).count() == 0
