"""Whitening against an eigenvalue decomposition of exact covariances."""

import math
from fractions import Fraction

import numpy as np
import pytest

from gustline.llm import whitening
from gustline.llm.queries import QUERIES


def whole(rows):
    """(vec_id, x) of the rows that count"""
    good = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    usual = max(set(sizes), key=lambda n: (sizes.count(n), n), default=0)
    return [(k, tuple(math.floor(256 * float(c)) for c in v)) for k, v in good if len(v) == usual]


def plain(rows):
    kept = whole(rows)
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    apart = np.array([[float(Fraction(v) - Fraction(s, n)) for v, s in zip(x, sums, strict=True)] for x in fit])
    covariance = apart.T @ apart / n
    values, vectors = np.linalg.eigh(covariance)
    return kept, n, sums, values[::-1], vectors.T[::-1], covariance.trace()


def check(spark, df, rows, result):
    kept, n, sums, values, vectors, trace = plain(rows)
    got = {}
    for r in result:
        got.setdefault((r.vec_id, r.component), []).append(r)
    size = min(4, int((values > 1e-9 * max(values.max(), 1e-300)).sum()))
    assert len(result) == size * len(kept)
    for j in range(size):
        own = [(k, x, sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))) for k, x in kept]
        want = [np.dot([float(Fraction(v) - Fraction(s, n)) for v, s in zip(x, sums, strict=True)], vectors[j]) / math.sqrt(values[j]) for _, x, _ in own]
        for sign in (1, -1):
            left = sorted((str(k), round(sign * w, 6) + 0.0, d) for (k, _, d), w in zip(own, want, strict=True))
            right = sorted((str(r.vec_id), round(r.whitened, 6) + 0.0, r.deviation) for key, rs in got.items() if key[1] == j + 1 for r in rs)
            if all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-5 and a[2] == b[2] for a, b in zip(left, right, strict=True)):
                break
        else:
            raise AssertionError(f"component {j + 1}")
    for r in result:
        assert r.n == n and abs(r.explained - values[r.component - 1] / trace) < 1e-9 and 0 <= r.identity_error < 1e-9


def table(spark, path, rows, kind="float"):
    rows = [(k, v and [None if c is None else float(c) for c in v]) for k, v in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    df = df.selectExpr("*", "1 as n", "'q' as x", "2.0 as whitened", "3 as deviation", "4 as label")
    df.repartition(4).write.parquet(f"{path}/embeddings.parquet")
    return df


def test_query_on_the_given_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(spark, None, rows, QUERIES["op12_embedding_whitening"](spark, folder).collect())


def test_query_on_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 6)).astype(np.float32).astype(float) * [9, 5, 3, 2, 1, 0.5]
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(100 + k, base[3].tolist()) for k in range(80)]  # one vector many times
    rows += [(1, None), (2, []), (3, [1.0] * 5), (4, [1.0, None, 1, 1, 1, 1]), (5, [math.nan] * 6), (6, [math.inf, *[1.0] * 5]), (None, base[5].tolist()), (7, base[7].tolist())]
    table(spark, tmp_path, rows)
    check(spark, None, rows, QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    table(spark, tmp_path, rows)
    assert QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).count() == 0


def test_vectors_that_depend_on_each_other(spark, tmp_path):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-9, 9, (2, 40)).astype(float)
    rows = [(k, [x, y, x + y, -x, 2.0]) for k, (x, y) in enumerate(zip(a, b, strict=True))]
    table(spark, tmp_path, rows)
    result = QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect()
    assert {r.component for r in result} == {1, 2}
    check(spark, None, rows, result)


def test_far_from_the_origin(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(k, (1e9 + v).tolist()) for k, v in enumerate(rng.normal(size=(50, 3)) * [3, 2, 1])]
    table(spark, tmp_path, rows, "double")
    check(spark, None, rows, QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect())


def test_numbers_beyond_64_bits(spark, tmp_path):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 5.0])]
    table(spark, tmp_path, rows)
    result = QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect()
    assert {r.vec_id for r in result} == {1, 2, 3} and all((r.deviation is None) == (r.vec_id < 3) for r in result)


def test_factors():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 7, 16):
        a = rng.normal(size=(size + 4, size)) * 10.0 ** rng.integers(-6, 6, size)
        matrix = a.T @ a
        factor, order = whitening.pivoted_cholesky(matrix)
        assert np.abs(factor @ factor.T - matrix[np.ix_(order, order)]).max() <= 1e-14 * size * matrix.max()
        rotated = whitening.orthogonal_columns(factor)
        axes, values = whitening.principal(matrix)
        # nothing is lost by the scale of the entries
        true = np.sort(np.linalg.svd(a, compute_uv=False) ** 2)[::-1][: len(values)]
        assert np.allclose(values[true > 1e-10 * true[0]], true[true > 1e-10 * true[0]], rtol=1e-5)
        assert np.allclose(axes @ axes.T, np.eye(len(values)), atol=1e-12)
        assert np.abs((rotated.T @ rotated) - np.diag((rotated**2).sum(0))).max() <= 1e-12 * (rotated**2).sum()


def test_every_pair_is_rotated_once():
    for size in (1, 2, 3, 6, 7):
        pairs = [(int(a), int(b)) for p, q in whitening._rounds(size) for a, b in zip(p, q, strict=True)]
        assert sorted(pairs) == [(a, b) for a in range(size) for b in range(a + 1, size)]
