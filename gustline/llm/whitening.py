"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become whole numbers, floor(256 c). The fit list holds each distinct vector once. Its sums and,
with the mean taken off before anything is multiplied, its scatter matrix are added up by the tasks; only
sums over all rows reach the driver: as many numbers as a vector has entries, and their square. There,

1. the scatter matrix (over n) is factored with pivoting, V = P L L' P', which stops at its rank;
2. the columns of L are rotated pairwise until all are orthogonal. Since V is never formed again, small
   eigenvalues keep their digits. The squared norms of the rotated columns are the eigenvalues of V, the
   columns over their norms (rows put back in order) the eigenvectors.

Rows are then centred and projected in one pass. A vector that a third of all rows hold is one row of the
fit list, counted before the shuffle.

Left out: rows whose vector is null, empty, or holds null or non-finite entries, and rows whose vector
has another length than most have (ties: the longer). Numbers beyond 64 bits stop at their limit, and a
deviation beyond them is null. Ids may be null or repeated; each row is whitened. Eigenvalues of zero have
no component, so of vectors that are all alike, no component is left. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.session import stage

SCALE = 256
SWEEPS = 60
_LONGEST = (1 << 63) - 1
_SAFE = 1 << 52


def _reach(x: np.ndarray) -> int:
    """The largest absolute entry; that of the least 64-bit number is no 64-bit number."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


@dataclass(frozen=True)
class Whitening:
    """What was learned from the fit list; ``components`` has one unit vector per row."""

    rows: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, the whole part of the mean taken off first."""
        whole = np.array([s // self.rows for s in self.sums], float)
        part = np.array([(s % self.rows) / self.rows for s in self.sums])
        return (x - whole) - part if _reach(x) < _SAFE else x - (whole + part)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exactly."""
        furthest = self.rows * _reach(x) + max(map(abs, self.sums), default=0)
        if len(self.sums) * furthest**2 <= _LONGEST:
            apart = self.rows * x - np.array(self.sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        found = [sum((self.rows * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v <= _LONGEST else None for v in found]


def whole_vectors(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows with a usable vector of the usual length."""
    vector = F.col(vector_col)
    usable = vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    kept = table.where(usable).select(F.col(id_col).alias("vec_id"), x.alias("x")).where(F.size("x") > 0)
    usual = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return kept if usual is None else kept.where(F.size("x") == usual["size"])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            far = _reach(x) * len(x) >= _LONGEST
            own = [sum(c) for c in zip(*x.tolist(), strict=True)] if far else x.sum(axis=0).tolist()
            n += len(x)
            total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total is not None:
            values = pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values, pa.array([n] * len(total), pa.int64())], ["k", "total", "n"])

    found = fit.mapInArrow(add, "k int, total decimal(38,0), n long").groupBy("k").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    rows = sorted(found.collect())
    return (rows[0].n if rows else 0), [int(r.total) for r in rows]


def _scatter(fit: DataFrame, model: Whitening) -> np.ndarray:
    """Sum of the products of centred entries, over the fit list."""
    size = len(model.sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                apart = model.centred(_matrix(batch.column(0)))
                total += apart.T @ apart
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["k", "entries"])

    def add(table: pa.Table) -> pa.Table:
        entries = np.sort(_floats(table.column("entries")), axis=0).sum(axis=0)  # in an order of its own: the same for any tasks
        return pa.table([table.column("k").slice(0, 1).combine_chunks(), pa.array([entries], pa.list_(pa.float64()))], ["k", "entries"])

    parts = fit.mapInArrow(multiply, "k int, entries array<double>")
    rows = parts.groupBy("k").applyInArrow(add, "k int, entries array<double>").orderBy("k").collect()
    return np.array([r.entries for r in rows])


def _floats(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.combine_chunks().flatten()).reshape(len(column), -1)


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): matrix[order][:, order] = L L', as many columns as the rank."""
    size = len(matrix)
    order, left, factor = np.arange(size), matrix.diagonal().copy(), np.zeros((size, size))
    enough = size * np.finfo(float).eps * left.max(initial=0)
    for k in range(size):
        p = k + int(left[k:].argmax())
        if left[p] <= enough:
            return factor[:, :k], order
        for swapped in (order, left, factor):
            swapped[[k, p]] = swapped[[p, k]]
        root = np.sqrt(left[k])
        factor[k, k] = root
        below = matrix[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / root
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns, in rounds of disjoint ones."""
    even = size + size % 2
    ring = list(range(1, even))
    for _ in range(even - 1):
        seats = [0, *ring]
        pairs = [(min(p, q), max(p, q)) for p, q in zip(seats[: even // 2], seats[: even // 2 - 1 : -1], strict=True)]
        pairs = [(p, q) for p, q in pairs if q < size]
        if pairs:
            yield np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])
        ring = ring[-1:] + ring[:-1]


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns rotated in pairs until none has a part along another."""
    rotated = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in _rounds(rotated.shape[1]):
            a, b = rotated[:, p], rotated[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            with np.errstate(divide="ignore", invalid="ignore"):
                share = np.where(gamma == 0, 0.0, np.abs(gamma) / np.sqrt(alpha * beta))
                worst = max(worst, float(share.max()))
                zeta = (beta - alpha) / (2 * gamma)
                tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            tangent = np.where(share > 1e-16, tangent, 0.0)
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            rotated[:, p], rotated[:, q] = cosine * a - sine * b, sine * a + cosine * b
        if worst < 1e-15:
            break
    return rotated


def principal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(components, eigenvalues) of a covariance by falling eigenvalue; the largest entry is positive."""
    if not len(matrix):
        return np.empty((0, 0)), np.empty(0)
    factor, order = pivoted_cholesky(matrix)
    rotated = np.empty_like(factor)
    rotated[order] = orthogonal_columns(factor)
    values = (rotated * rotated).sum(axis=0)
    rotated, values = rotated[:, values > 0], values[values > 0]
    place = np.argsort(-values, kind="stable")
    components = (rotated / np.sqrt(values))[:, place].T
    if len(components):
        largest = np.abs(components).argmax(axis=1)
        components *= np.sign(components[np.arange(len(components)), largest])[:, None]
    return components, values[place]


def learn(vectors: DataFrame, *, components: int | None = None) -> tuple[Whitening, DataFrame]:
    """The whitening of vectors (vec_id, x), and the staged fit list. ``components`` of the first only."""
    fit = stage(vectors.select("x").distinct(), "fit-list")
    n, sums = _sums(fit)
    model = Whitening(n, sums, np.empty((0, len(sums))), np.empty(0), np.empty(0))
    if not n:
        return model, fit
    covariance = _scatter(fit, model) / n
    axes, values = principal((covariance + covariance.T) / 2)
    share = values / covariance.trace() if len(values) else values
    kept = slice(None, components)
    return Whitening(n, sums, axes[kept], values[kept], share[kept]), fit


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, whitened, deviation) of each vector (vec_id, x)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            columns = [batch.column(0), pa.array(list(model.whiten(x)), pa.list_(pa.float64())), pa.array(model.deviations(x), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "whitened", "deviation"])

    if not model.rows:
        return vectors.select("vec_id", F.array().cast("array<double>").alias("whitened"), F.lit(None).cast("long").alias("deviation")).limit(0)
    return vectors.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, whitened array<double>, deviation long")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, as measured on its rows."""
    size = len(model.eigenvalues)
    if not size:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w = model.whiten(_matrix(batch.column(0)))
                total += w.sum(axis=0)
                products += w.T @ w
        every = [*total, *products.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(every)), pa.int32()), pa.array(every, pa.float64())], ["k", "v"])

    sums = fit.mapInArrow(add, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    values = np.array([r.v for r in sums]) / model.rows
    mean, products = values[:size], values[size:].reshape(size, size)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(size)).max())
