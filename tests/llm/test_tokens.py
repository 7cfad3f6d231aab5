"""Token files and packing against plain encodings."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from gustline.llm import binary, packing
from gustline.llm.tokens import Encoder

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
LETTERS = [" ", "  ", "\n", "\t", "\r", "a", "B", "é", "É", "́", "1", "!", ".", ",", "'s", "\xa0", "\x1c", "Σ", "ſ", "İ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "\x85", "漢", "ß", "word", "µ"]
TEXTS = [(1, "One two, three."), (2, None), (3, ""), (4, "a b " * 3000), (5, "One two, three."), (5, "again"), (-7, " x\n\ny "), (8, "a <|endoftext|>b <|startoftext|> c")]


def plain(path, names_as_text=False):
    tokenizer = Tokenizer.from_file(path)
    if names_as_text:
        tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("names_as_text", [False, True])
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_ids_of_the_whole_text(path, names_as_text):
    random.seed(5)
    encoder, whole = Encoder(path, names_as_text), plain(path, names_as_text)
    for _ in range(4000):
        text = "".join(random.choices(LETTERS, k=random.randint(0, 20)))
        assert encoder.encode(text).tolist() == whole(text), ascii(text)


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bits(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = binary.pack_bits(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert (binary.unpack_bits(data, len(ids), bits) == ids).all()


def test_random_access(tmp_path):
    system = fs.LocalFileSystem()
    ids = np.random.default_rng(1).integers(0, 1 << 17, 3 * binary.BLOCK + 77).astype(np.uint32)
    with system.open_output_stream(str(tmp_path / "x")) as out:
        writer = binary.ShardWriter(out, 17)
        for k, part in enumerate(np.array_split(ids, 40)):
            writer.add(k, part)
        writer.close()
    with system.open_input_file(str(tmp_path / "x")) as file:
        reader = binary.ShardReader(file)
        for a, b in [(0, 5), (binary.BLOCK - 2, binary.BLOCK + 9), (77, len(ids)), (9, 9)]:
            assert (reader.ids(a, b) == ids[a:b]).all()
        assert (np.concatenate([x for _, _, x in reader.documents(1000)]) == ids).all()


def test_files(rows):
    whole = plain(WORD)
    got = [tuple(r)[:4] for r in binary.round_trip(rows(TEXTS + [(None, "lost")]), tokenizer=WORD, end_id=2).collect()]
    start, want = 0, []
    for doc in sorted({d for d, _ in TEXTS}):
        same = [whole(t) + [2] for d, t in TEXTS if d == doc]
        found = sorted((r for r in got if r[0] == doc), key=lambda r: r[1])
        assert sorted((len(x), crc(x)) for x in same) == sorted(r[2:] for r in found)
        for r in found:
            assert r[1] == start
            start += r[2]
        want += same
    assert len(got) == len(want)
    assert binary.round_trip(rows([]), tokenizer=WORD, end_id=2).count() == 0


@pytest.mark.parametrize("workers", [1, 3, 70])
def test_packing(rows, workers):
    random.seed(workers)
    texts = TEXTS + [(k, "word " * random.randint(0, 700)) for k in range(10, 400)]
    whole = plain(BYTE)
    got = packing.pack(rows(texts).repartition(workers), tokenizer=BYTE, end_id=0, capacity=64).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc in {d for d, _ in texts}:
        same = [whole(t) + [0] for d, t in texts if d == doc]
        if len(same) == 1:
            ids, at = same[0], 0
            for r in sorted(pieces[doc], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids))
                assert r.ids_crc32 == crc(ids[at : at + r.length])
                at += r.length
            assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    tokens = sum(r.length for r in got)
    assert 64 * len(sequences) < 1.06 * tokens + 64 * 64


def test_cuts():
    for n in range(1, 5000):
        lengths = packing.cuts(n, 1024)
        assert sum(lengths) == n and max(lengths) <= 1024 and len(lengths) <= n // 1024 + 6


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_marks_behind_words(path):
    random.seed(8)
    encoder, whole = Encoder(path), plain(path)
    for _ in range(3000):
        words = ("".join(random.choices("aBéßÀſ1", k=random.randint(0, 4))) + "".join(random.choices("!#$'*.,-<>|_~", k=random.randint(0, 4))) for _ in range(6))
        text = random.choice([" ", "\n", "  "]).join(words) + random.choice(["", "", " <|endoftext|>", "'s"])
        assert encoder.encode(text).tolist() == whole(text), ascii(text)


def test_a_word_is_known_once_it_stood_before_marks():
    encoder = Encoder(BYTE)
    assert encoder.encode("a zebrawood!! quaggasé.***").tolist() == plain(BYTE)("a zebrawood!! quaggasé.***")
    assert {"zebrawood", "quaggasé"} <= set(encoder._inner)


def test_one_vocabulary_a_worker(monkeypatch):
    import tokenizers

    class Counted:
        loads = 0

        @staticmethod
        def from_file(path):
            Counted.loads += 1
            return Tokenizer.from_file(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    text = "a <|endoftext|>b c"
    encoder = Encoder(BYTE)
    assert [encoder.encode(x).tolist() for x in (text, "b", text, "b")] == [plain(BYTE)(x) for x in (text, "b", text, "b")]
    assert Counted.loads == 1


def test_workers_that_fill_bins_keep_no_encoder(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(packing, "TaskContext", Task)
    packing.encoder(BYTE)
    batch = pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (1, 0, 5, 9, 5)], packing._NAMES)
    assert sum(x.num_rows for x in packing._fill(0, True, 64)(iter([batch]))) == 1
    assert packing.encoder.cache_info().currsize == 0
