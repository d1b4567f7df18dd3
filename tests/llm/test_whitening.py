from fractions import Fraction

import numpy as np
import pytest

from voxscope.llm.whitening import by_component, leading_components, tridiagonal, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, k):
    x = [[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(v[d] for v in x) for d in range(dims)]
    off = [[n * v[d] - sums[d] for d in range(dims)] for v in x]
    cov = np.array([[float(Fraction(sum(o[i] * o[j] for o in off), n ** 3)) for j in range(dims)] for i in range(dims)])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, [sum(a * a for a in o) for o in off], np.array(off) / n @ basis / np.sqrt(values), values / np.trace(cov)


@pytest.mark.parametrize("dims,k", [(5, 3), (12, 32)])
def test_against_brute_force(spark, dims, k):
    rng = np.random.default_rng(dims)
    rows = rng.standard_normal((300, dims)) * np.linspace(4, 1, dims) + rng.standard_normal(dims) * 50
    table = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(rows)], SCHEMA).repartition(5)
    n, deviation, white, shares = brute(rows, k)
    got = by_component(whiten(table, components=k), "vec_id").collect()
    assert len(got) == n * min(k, dims) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert 0 <= got[0].identity_error < 1e-9
    signs = {r.component: np.sign(r.whitened * white[0, r.component - 1]) for r in got if r.vec_id == 0}
    for r in got:
        assert r.deviation == deviation[r.vec_id]
        assert abs(r.whitened * signs[r.component] - white[r.vec_id, r.component - 1]) < 1e-8
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-10


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [3, 3 - 1e-9, 3 - 2e-9, 1, 0, 0], [1] * 6, [9, 4, 0, 0, 0, 0]])
def test_eigenvectors_of_clusters(values):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))
    for matrix in ((q * values) @ q.T, np.diag(np.array(values, dtype=float))):
        matrix = (matrix + matrix.T) / 2
        found, vectors = leading_components(matrix, 4)
        assert np.allclose(found, [v for v in values[:4] if v], atol=1e-12)
        assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-10)
        assert np.allclose(matrix @ vectors, vectors * found, atol=1e-10)
        d, e, basis = tridiagonal(matrix)
        assert np.allclose(basis @ (np.diag(d) + np.diag(e, 1) + np.diag(e, -1)) @ basis.T, matrix)


def test_large_matrix_against_the_library():
    a = np.random.default_rng(1).standard_normal((400, 150))
    cov = a.T @ a
    values, vectors = leading_components(cov, 32)
    want, basis = np.linalg.eigh(cov)
    assert np.allclose(values, want[::-1][:32], rtol=1e-12)
    assert np.allclose(np.abs((vectors * basis[:, ::-1][:, :32]).sum(axis=0)), 1, atol=1e-9)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0, 2.0], [1.0, -1.0, 0.25], [3.0, 0.5, 1.0], [3.0, 0.5, 1.0], [2.0, 2.0, -4.0]]
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, 1, "x", 7) for i, v in enumerate(good + odd)] + [(None, [1.0, 1.0, 1.0], None, None, 1), (0, good[0], 1, "x", 7)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened string, v int").repartition(3)
    got = whiten(table).collect()
    assert sorted((r.row.vec_id is None, r.row.vec_id) for r in got) == [(False, 0), (False, 0), (False, 1), (False, 2), (False, 3), (False, 4), (True, None)]
    fit = [v for i, v, *_ in rows if v and len(v) == 3 and None not in v and all(abs(c) < inf for c in v)]
    n, deviation, white, _ = brute(fit, 3)
    assert {r.n for r in got} == {7} and sorted(int(r.deviation) for r in got) == sorted(deviation)
    assert np.allclose(sorted(abs(r.whitened[0]) for r in got), sorted(np.abs(white[:, 0])))
    assert {r.row.v for r in got} == {7, 1}


def test_very_large_entries_stay_exact(spark):
    rows = [[1e30, 0.0], [-1e30, 1.0], [1e12, 2.0]]
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    x = [[max(-2 ** 50, min(2 ** 50, int(64 * c))) + 1_000_000 for c in v] for v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert [int(r.deviation) for r in whiten(table).orderBy("row.vec_id").collect()] == want
    assert by_component(whiten(table), "vec_id").where("deviation IS NOT NULL").count() == 0  # beyond a long


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 4])
def test_nothing_to_whiten(spark, vectors):
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)
    found = whiten(table)
    assert by_component(found, "vec_id").collect() == []
    assert all(r.deviation == 0 and r.whitened == [] for r in found.collect())
