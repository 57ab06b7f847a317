"""Embedding whitening against a dense eigensolver, exact deviations, edges."""

from fractions import Fraction

import numpy as np
import pytest

from pricewright.llm import whitening as wh
from pricewright.llm.common import table

SHAPE = "vec_id long, embedding array<float>"


def dense(vectors):
    x = np.floor(1024 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    y = x - x.mean(axis=0)
    values, u = np.linalg.eigh(y.T @ y / len(y))
    return x, y, values[::-1], u[:, ::-1]


def check(rows, vectors, components=8):
    """``rows``: of the digest, for the vectors in order of vec_id."""
    x, y, values, u = dense(vectors)
    n = len(x)
    k = min(components, x.shape[1])
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * k
    sums = [int(s) for s in x.sum(axis=0)]
    for i in range(n):
        exact = sum((n * int(v) - s) ** 2 for v, s in zip(x[i], sums))
        assert all(got[i, c + 1]["deviation"] == exact and got[i, c + 1]["n"] == n for c in range(k))
    for c in range(k):
        mine, want = np.array([got[i, c + 1]["whitened"] for i in range(n)]), y @ u[:, c] / np.sqrt(values[c])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
        assert abs(got[0, c + 1]["explained"] / (values[c] / values.sum()) - 1) < 1e-9
    assert rows[0]["identity_error"] < 1e-9


def test_query_equals_dense(spark):
    emb = table(spark, "/root/testdata/sf0.001", "embeddings")
    vectors = [r["embedding"] for r in emb.orderBy("vec_id").collect()]
    check(wh.whitening_digest(emb).collect(), vectors)


@pytest.mark.parametrize("dim,n", [(1, 30), (3, 40), (9, 60), (20, 200)])
def test_small_dimensions(spark, dim, n):
    v = np.random.default_rng(dim).standard_normal((n, dim)).astype(np.float32) * (1 + np.arange(dim, dtype=np.float32))
    rows = wh.whitening_digest(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SHAPE)).collect()
    check(rows, v)


def test_dropped_vectors_and_repeats(spark):
    rng = np.random.default_rng(0)
    good = rng.standard_normal((50, 4)).astype(np.float32).tolist()
    good += good[:3]
    bad = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [float("nan")] * 4), (93, [1.0, float("inf"), 0.0, 0.0]), (94, []),
           (95, [1.0]), (96, [1e30, 0.0, 0.0, 0.0])]
    rows = [(i, v) for i, v in enumerate(good)]
    check(wh.whitening_digest(spark.createDataFrame(rows + bad, SHAPE).repartition(5)).collect(), good)


def test_without_components(spark):
    assert wh.whitening_digest(spark.createDataFrame([], SHAPE)).collect() == []
    assert wh.whitening_digest(spark.createDataFrame([(1, None), (2, [])], SHAPE)).collect() == []
    assert wh.whitening_digest(spark.createDataFrame([(1, [1.0, 2.0])] * 5, SHAPE)).collect() == []


def test_fewer_directions_than_components(spark):
    """Vectors on a plane have two components."""
    rng = np.random.default_rng(2)
    a = rng.integers(-50, 50, (80, 2)).astype(np.float32)
    v = np.concatenate([a, a, a[:, :1] - a[:, 1:]], axis=1)
    rows = wh.whitening_digest(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SHAPE)).collect()
    assert {r["component"] for r in rows} == {1, 2} and rows[0]["identity_error"] < 1e-9


def test_clashing_names(spark):
    v = np.random.default_rng(3).standard_normal((40, 3)).tolist()
    rows = spark.createDataFrame([(i, x, "mine", "own") for i, x in enumerate(v)], SHAPE + ", row string, w string")
    out = wh.whiten(rows, wh.fit(rows))
    assert out.columns == ["vec_id", "embedding", "row", "w", "deviation", "whitened"]
    assert {(r["row"], r["w"]) for r in out.collect()} == {("mine", "own")}


def test_deviations_past_a_long():
    x = np.array([[2**40, 0], [0, 2**40], [5, 5]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert wh.deviations(x, 3, sums) == [e if e < 2**63 else None for e in exact]
    assert wh.deviations(x[:, :1] % 1000, 3, [7]) == [(3 * int(v) - 7) ** 2 for v in x[:, 0] % 1000]


@pytest.mark.parametrize("dim", [2, 8, 30, 120])
def test_jacobi_davidson(dim):
    rng = np.random.default_rng(dim)
    a = rng.standard_normal((4 * dim, dim)) * np.linspace(3, 1, dim)
    v = a.T @ a
    got = wh.jacobi_davidson(lambda b: v @ b, dim, 8)
    values, u = np.linalg.eigh(v)
    k = min(8, dim)
    assert np.allclose(got.values, values[::-1][:k], rtol=1e-12)
    assert np.abs(np.abs((got.vectors * u[:, ::-1][:, :k]).sum(axis=0)) - 1).max() < 1e-10
    assert (got.residuals <= 256 * wh.EPS * values[-1]).all()


def test_equal_eigenvalues():
    v = np.diag([5.0, 5.0, 5.0, 5.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.5, 0.25])
    got = wh.jacobi_davidson(lambda b: v @ b, 12, 8)
    assert np.allclose(got.values, [5] * 4 + [1] * 4) and np.allclose(got.vectors.T @ got.vectors, np.eye(8))


def test_minres_solves_each_column():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((30, 30))
    a = a + a.T  # not definite
    b = rng.standard_normal((30, 3))
    b[:, 1] = 0
    x = wh.minres(lambda t: a @ t, b, 200, 1e-12)
    assert np.abs(a @ x - b).max() < 1e-8 and np.abs(x[:, 1]).max() == 0


def test_residuals_by_exact_numbers(spark):
    """The mean and the sums are exact, whatever the blocks."""
    v = np.random.default_rng(6).standard_normal((500, 5)).astype(np.float32)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SHAPE).repartition(7)
    data = wh.Centred(rows, "embedding", 5)
    x = dense(v)[0]
    assert data.sums == [int(s) for s in x.sum(axis=0)] and data.n == 500
    assert all(abs(Fraction(m) - Fraction(s, 500)) < Fraction(1, 2**30) for m, s in zip(data.mean, data.sums))
