"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, and only the bag has a label. Every passage is
encoded: the mean of learned vectors of its hashed words beside plain figures of its characters and
repetitions go through a layer to ``WIDTH`` numbers h. Gated attention gives each passage a weight,

    a = softmax over the passages of  w . (tanh(V h) * sigmoid(U h)),

and the document's score is the sigmoid of a linear function of the weighted sum of its passages. All
parameters, the word vectors and the attention included, are learned together from document labels.

Learning takes at most ``ROWS`` labelled documents, half of each label where there are enough, those with
the least hashes of their ids, and none of more than ``MOST_PASSAGES`` passages. Their hashed words come
to the driver; texts do not. Scoring reads all passages of all documents, in one pass without a shuffle.
A score depends on the document's own text alone (and on the model), not on how rows are dealt out.

Nulls: a null text is an empty one, which is one passage without words. Rows without an id are never
learned from and count as held out. Labels that are null are left out; of contradicting labels of one id
the mean is learned. Of rows with one id and different texts, one is learned from and all are scored.
Other columns are ignored. An empty table gives no rows; without usable labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.llm.words import Words, chunks, in_small_batches, lean
from gustline.session import stage

PASSAGE = 64  # words
BUCKETS = 1 << 13  # hashed words with a learned vector
VECTOR = 16
WIDTH = 16
GATES = 8
ROWS = 4096  # labelled documents to learn from, at most
MOST_PASSAGES = 256  # of a document to learn from
EPOCHS = 14
BATCH = 64
STEP = 0.05
THRESHOLD = 0.3

_CLASSES = [b"#*$%&|<>", b"!", b".,;:?", b"0123456789", bytes(range(ord("A"), ord("Z") + 1)), bytes(range(0x80, 0x100)), b"\n\t\r"]
_CLASS = np.zeros((len(_CLASSES), 256), bool)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS[_k, list(_bytes)] = True
FIGURES = len(_CLASSES) + 5


@dataclass
class Bags:
    """Passages of some documents: hashed words with the first of each passage, figures, and the first
    passage of each document (one more than documents)."""

    buckets: np.ndarray
    first_word: np.ndarray  # one more than passages
    figures: np.ndarray
    first: np.ndarray


def encode(words: Words) -> Bags:
    """Passages of a chunk of texts; a text without words is one passage without words."""
    n = np.diff(words.first)
    count = np.maximum(1, -(-n // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(words.rows), count)
    begin = words.first[doc] + PASSAGE * (np.arange(first[-1]) - first[doc])
    end = np.minimum(begin + PASSAGE, words.first[doc + 1])
    first_word = np.append(begin, words.first[-1])
    size = end - begin

    # bytes from the first word of a passage to the next passage (or the text's end)
    at = np.append(words.starts, len(words.data))
    low = np.where(size > 0, at[begin], words.offsets[doc])
    high = np.where(end < words.first[doc + 1], at[end], words.offsets[doc + 1])
    length = np.maximum(1, high - low)
    columns = []
    for flags in _CLASS:
        total = np.concatenate([[0], np.cumsum(flags[words.data])])
        columns.append((total[high] - total[low]) / length)
    some = np.maximum(1, size)
    same = np.concatenate([[0], np.cumsum(np.append(False, words.hashes[1:] == words.hashes[:-1]))]) if len(words.hashes) else np.zeros(1, int)
    inner = np.minimum(begin + 1, end)
    columns.append((same[end] - same[inner]) / some)
    passage = np.repeat(np.arange(len(begin)), size)
    order = np.lexsort((words.hashes, passage))
    hashes, place = words.hashes[order], passage[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (place[1:] != place[:-1])) if len(order) else np.empty(0, bool)
    columns.append(np.bincount(place[fresh], minlength=len(begin)) / some)
    columns.append(np.bincount(passage, (words.ends - words.starts), minlength=len(begin)) / some / 8)
    columns.append(np.bincount(passage, (words.ends - words.starts) == 1, minlength=len(begin)) / some)
    columns.append(size / PASSAGE)
    buckets = (words.hashes % np.uint64(BUCKETS)).astype(np.uint16)
    return Bags(buckets, first_word, np.stack(columns, axis=1).astype(np.float32), first)


def _per_group(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, from first[k] to first[k + 1]; empty groups are zero."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model(dict):
    """Parameters by name."""

    @classmethod
    def fresh(cls) -> Model:
        random = np.random.default_rng(13)
        shape = {"words": (BUCKETS, VECTOR), "layer": (VECTOR + FIGURES, WIDTH), "tanh": (WIDTH, GATES), "gate": (WIDTH, GATES)}
        model = cls({name: random.normal(0, 1 / np.sqrt(size[0]) if name != "words" else 0.1, size) for name, size in shape.items()})
        model |= {"bias": np.zeros(WIDTH), "attend": random.normal(0, 0.1, GATES), "last": random.normal(0, 0.1, WIDTH), "offset": np.zeros(1)}
        return cls(model | {"mean": np.zeros(FIGURES), "spread": np.ones(FIGURES), "documents": np.zeros(1)})

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        counts = np.diff(bags.first_word)
        mean = _per_group(self["words"][bags.buckets], bags.first_word) / np.maximum(1, counts)[:, None]
        x = np.concatenate([mean, (bags.figures - self["mean"]) / self["spread"]], axis=1)
        h = np.tanh(x @ self["layer"] + self["bias"])
        t, g = np.tanh(h @ self["tanh"]), _sigmoid(h @ self["gate"])
        e = (t * g) @ self["attend"]
        doc = np.repeat(np.arange(len(bags.first) - 1), np.diff(bags.first))
        top = np.maximum.reduceat(e, bags.first[:-1]) if len(e) else e
        e = np.exp(e - top[doc])
        a = e / _per_group(e, bags.first)[doc]
        z = _per_group(a[:, None] * h, bags.first)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "doc": doc, "counts": counts, "score": _sigmoid(z @ self["last"] + self["offset"])}

    def gradients(self, bags: Bags, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy, by parameter; of the word vectors, (buckets, gradients)."""
        f = self.forward(bags)
        err = (f["score"] - wanted) / len(wanted)
        dz = err[:, None] * self["last"]
        h, a, doc = f["h"], f["a"], f["doc"]
        da = (h * dz[doc]).sum(axis=1)
        de = a * (da - _per_group(a * da, bags.first)[doc])
        dt, dg = de[:, None] * self["attend"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * self["attend"] * f["t"] * f["g"] * (1 - f["g"])
        dh = a[:, None] * dz[doc] + dt @ self["tanh"].T + dg @ self["gate"].T
        dx = dh * (1 - h * h)
        per_word = np.repeat((dx @ self["layer"][:VECTOR].T) / np.maximum(1, f["counts"])[:, None], f["counts"], axis=0)
        order = np.argsort(bags.buckets, kind="stable")
        used, begin = np.unique(bags.buckets[order], return_index=True)
        words = np.add.reduceat(per_word[order], begin, axis=0) if len(used) else per_word[:0]
        return {
            "last": f["z"].T @ err, "offset": np.array([err.sum()]), "attend": (f["t"] * f["g"]).T @ de, "tanh": h.T @ dt, "gate": h.T @ dg,
            "layer": f["x"].T @ dx, "bias": dx.sum(axis=0), "words": (used, words),
        }


def train(documents: list[tuple[Bags, float]], epochs: int = EPOCHS) -> Model:
    """The model of labelled documents; the same for the same documents in the same order."""
    model = Model.fresh()
    if not documents:
        return model
    figures = np.concatenate([bag.figures for bag, _ in documents]).astype(float)
    model["mean"], model["spread"] = figures.mean(axis=0), np.maximum(figures.std(axis=0), 1e-3)
    model["documents"] = np.full(1, len(documents))
    squares = {name: np.full_like(value, 1e-6) for name, value in model.items()}
    random = np.random.default_rng(7)
    for _ in range(epochs):
        order = random.permutation(len(documents))
        for at in range(0, len(order), BATCH):
            chosen = [documents[k] for k in order[at : at + BATCH]]
            for name, slope in model.gradients(_joined([bag for bag, _ in chosen]), np.array([label for _, label in chosen])).items():
                rows = slice(None)
                if name == "words":
                    rows, slope = slope
                squares[name][rows] += slope * slope
                model[name][rows] -= STEP * slope / np.sqrt(squares[name][rows])
    return model


def _joined(bags: list[Bags]) -> Bags:
    words = np.cumsum([0, *(len(b.buckets) for b in bags)])
    passages = np.cumsum([0, *(len(b.figures) for b in bags)])
    return Bags(
        np.concatenate([b.buckets for b in bags]),
        np.append(np.concatenate([b.first_word[:-1] + w for b, w in zip(bags, words, strict=False)]), words[-1]),
        np.concatenate([b.figures for b in bags]),
        np.append(np.concatenate([b.first[:-1] + p for b, p in zip(bags, passages, strict=False)]), passages[-1]),
    )


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: a fifth by id, and rows without one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, *, label: str = "quality", rows: int = ROWS) -> DataFrame:
    """(doc_id, wanted, buckets, first_word, figures) of the documents to learn from."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg(label).alias("wanted"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = known.limit(0)
    for part in (known.where("wanted >= 0.5"), known.where("wanted < 0.5")):
        few = few.unionByName(part.orderBy(*order).limit(rows // 2))
    few = stage(few, "labelled")  # at most ``rows``
    texts = docs.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.first("wanted").alias("wanted"), F.min("text").alias("text"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in chunks(batch.column(2)):
                bags, out = encode(words), []
                for k in range(words.rows):
                    a, b = bags.first[k], bags.first[k + 1]
                    if b - a > MOST_PASSAGES:
                        continue
                    own = bags.first_word[a : b + 1].copy()
                    own[-1] = words.first[k + 1]
                    part = bags.buckets[own[0] : own[-1]]
                    out.append((at + k, part.tobytes(), (own - own[0]).astype(np.int32).tobytes(), bags.figures[a:b].tobytes()))
                if out:
                    index, *blobs = zip(*out, strict=True)
                    columns = [batch.column(c).take(pa.array(index)) for c in (0, 1)] + [pa.array(x, pa.binary()) for x in blobs]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "wanted", "buckets", "first_word", "figures"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "wanted", "text").mapInArrow(run, f"doc_id {kind}, wanted double, buckets binary, first_word binary, figures binary")


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", rows: int = ROWS) -> Model:
    """The model of a bounded number of labelled documents."""
    documents = []
    for r in sorted(sample(docs.select("doc_id", "text"), labels, label=label, rows=rows).collect(), key=lambda r: r.doc_id):
        first_word = np.frombuffer(r.first_word, np.int32).astype(np.int64)
        figures = np.frombuffer(r.figures, np.float32).reshape(-1, FIGURES)
        bags = Bags(np.frombuffer(r.buckets, np.uint16), first_word, figures, np.array([0, len(figures)]))
        documents.append((bags, r.wanted))
    return train(documents)


def score(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, n_passages, most_weight) of every document; ``most_weight`` is the
    attention that its weightiest passage gets."""
    untrained = not model["documents"].any()
    shared = docs.sparkSession.sparkContext.broadcast({name: value.astype(np.float32) for name, value in model.items()})
    kind = docs.schema["doc_id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value)
        for batch in batches:
            for at, words in chunks(batch.column(1)):
                bags = encode(words)
                found = own.forward(bags)
                scores = np.full(words.rows, 0.5) if untrained else found["score"].astype(float)
                columns = [
                    batch.column(0).slice(at, words.rows), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)),
                    pa.array(np.diff(bags.first), pa.int64()), pa.array(np.maximum.reduceat(found["a"], bags.first[:-1]).astype(float)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "n_passages", "most_weight"])

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_passages long, most_weight double")
