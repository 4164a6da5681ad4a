import math

import numpy as np
import pytest
from starforge.llm import whitening


def brute(rows, dim, scale=256):
    """By the eigenvectors that LAPACK finds."""
    fine = [(i, tuple(int(math.floor(scale * x)) for x in v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, v) for i, v in fine if len(v) == dim]
    fit = sorted({v for _, v in fine})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, dtype=float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return fine, n, sums, values[::-1], vectors[:, ::-1]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, n int, whitened double")


def some(n, dim, seed):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim)) * np.linspace(3, 0.5, dim) + 5
    return [(k, r.tolist()) for k, r in enumerate(v)]


ODD = [(900, None), (901, []), (902, [1.0]), (903, [float("nan")] * 6), (904, [None] * 6), (905, [float("inf")] * 6)]


@pytest.mark.parametrize("hot", [0, 60])
def test_against_lapack(spark, hot):
    rows = some(120, 6, 1)
    rows += [(1000 + k, rows[7][1]) for k in range(hot)] + ODD + [(None, rows[3][1]), (5, rows[5][1])]
    out, found = whitening.whitened(table(spark, rows).repartition(4))
    fine, n, sums, values, vectors = brute(rows, 6)
    got = out.collect()
    assert n == 120 and len(got) == 4 * len(fine)
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    signs = None
    for i, v in fine:
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums))
        parts = by_row[(i, deviation)]
        assert sorted(parts) == [1, 2, 3, 4] and {p["n"] for p in parts.values()} == {n}
        want = ((np.array(v) - np.array(sums) / n) @ vectors / np.sqrt(values))[:4]
        mine = np.array([parts[c]["whitened"] for c in (1, 2, 3, 4)])
        if signs is None:
            signs = np.sign(mine * want)
        assert np.allclose(mine, want * signs, rtol=1e-9, atol=1e-11)
        assert np.allclose([parts[c]["explained"] for c in (1, 2, 3, 4)], values[:4] / values.sum(), rtol=1e-12)
        assert parts[1]["identity_error"] < 1e-12


@pytest.mark.parametrize("kind", range(5))
def test_divide_and_conquer(kind):
    rng = np.random.default_rng(kind)
    n = 40
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = [np.sort(rng.random(n)), np.logspace(-12, 3, n), np.r_[np.ones(n - 5), np.full(5, 7.0)], np.r_[np.zeros(n - 2), 1, 2], np.full(n, 3.0)][kind]
    a = q * values @ q.T
    a = (a + a.T) / 2
    got, vectors = whitening.leading(a, 6)
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1][:6], rtol=1e-13, atol=1e-13 * values.max())
    assert np.allclose(a @ vectors, vectors * got, atol=1e-13 * n * values.max())
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-13)


def test_polar_factor():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    w, v = np.linalg.eigh(a)
    assert np.allclose(whitening.polar(a), v * np.sign(w) @ v.T, atol=1e-13)


def test_few_distinct_vectors(spark):
    # two vectors: one component; one vector: none
    out, found = whitening.whitened(table(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0])]))
    assert sorted((r["vec_id"], r["component"], abs(r["whitened"]), r["deviation"]) for r in out.collect()) == [
        (1, 1, 1.0, 256**2), (2, 1, 1.0, 256**2), (3, 1, 1.0, 256**2)
    ]
    assert whitening.whitened(table(spark, [(1, [0.5, 0.5])] * 3))[0].collect() == []


def test_deviation_is_exact_or_null():
    rows = np.array([[3_000_000, -5], [0, 2]])
    n, sums = 10**6, [7, 11]
    assert whitening.deviations(rows, n, sums) == [None, sum((n * x - s) ** 2 for x, s in zip([0, 2], sums))]


def test_empty(spark):
    assert whitening.whitened(table(spark, ODD[:2]))[0].collect() == []
    assert whitening.whitened(table(spark, []))[0].columns[:2] == ["vec_id", "component"]
