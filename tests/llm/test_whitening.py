import math

import numpy as np
import pytest

from farebox.llm import charpoly
from farebox.llm.vectors import exact_gram, exact_sums
from farebox.llm.whitening import fitted, whitened
from vector_cases import edge_rows, frame, vector


def kept(rows, dim):
    out = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(np.float32(x)) for x in v):
            out.append((i, [math.floor(64 * float(np.float32(x))) + 1000000 for x in v]))
    return out


def check(spark, rows, dim, most=32):
    """The result against numpy on the same whole numbers; returns the model."""
    fit = kept(rows, dim)
    n, x = len(fit), np.array([v for _, v in fit], dtype=np.int64)
    sums = [sum(c) for c in zip(*[v for _, v in fit])]
    df = frame(spark, rows).repartition(4)
    model = fitted(df, most=most)
    centred = x - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(model.components) == k
    assert np.allclose(model.eigenvalues, values[:k], rtol=1e-9)
    assert np.allclose(model.shares, values[:k] / np.trace(cov), rtol=1e-9)
    assert np.abs(model.components @ model.components.T - np.eye(k)).max() < 1e-14
    assert np.abs(cov @ model.components.T - model.components.T * values[:k]).max() < 1e-9 * values[0]
    found = whitened(df, most=most).collect()
    assert len(found) == n * k and {r.component for r in found} == set(range(1, k + 1))
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-9
    wanted = sorted(
        (str(i), j + 1, sum((n * a - s) ** 2 for a, s in zip(v, sums)), round(float(w), 6) + 0.0)
        for (i, v), row in zip(fit, centred @ model.components.T / np.sqrt(model.eigenvalues))
        for j, w in enumerate(row)
    )
    assert sorted((str(r.vec_id), r.component, r.deviation, round(r.whitened, 6) + 0.0) for r in found) == wanted
    return model


def test_edges(spark):
    check(spark, edge_rows(12), 12)


def test_more_dimensions_than_components(spark):
    check(spark, [(i, vector(i, 40)) for i in range(300)], 40)


def test_low_rank(spark):
    check(spark, [(i, vector(i, 10)) for i in range(4)], 10)


def test_repeated_eigenvalues(spark):
    axes = [[float(s * (j == i)) for j in range(6)] for i in range(6) for s in (1, -1)]
    model = check(spark, list(enumerate(axes)), 6)
    assert np.allclose(model.shares, 1 / 6, rtol=1e-15)
    check(spark, list(enumerate(axes + [[s, 0.0, 0.0, 0.0, 0.0, 0.0] for s in (3.0, -3.0)])), 6, most=3)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, vector(1))], [(i, vector(1)) for i in range(5)]):
        assert whitened(frame(spark, rows)).collect() == []
    assert whitened(frame(spark, [])).columns == whitened(frame(spark, [(i, vector(i)) for i in range(5)])).columns


def test_sums_are_exact_at_every_size():
    rng = np.random.default_rng(3)
    for places in (4, 19, 20, 21, 45, 60):
        y = rng.integers(-(1 << places), (1 << places) + 1, (5000, 3))
        wide = y.astype(object)
        assert (exact_gram(y) == wide.T @ wide).all()
        assert (exact_sums(y) == wide.sum(axis=0)).all()


@pytest.mark.parametrize("d", [1, 2, 3, 7, 12])
def test_polynomial_of_known_roots(d):
    rng = np.random.default_rng(d)
    a = rng.integers(-9, 10, (d, d)).astype(object)
    matrix = (a @ a.T).tolist()
    trace = sum(matrix[i][i] for i in range(d))
    primes = charpoly.primes_beyond(2 * charpoly.coefficient_bound(trace, d))
    residues = [charpoly.polynomial_mod(np.array([[v % p for v in r] for r in matrix], dtype=np.int64), p).tolist() for p in primes]
    polynomial = charpoly.from_residues(primes, residues)
    # Newton's identities over the traces of powers, in whole numbers.
    power, traces, wanted = np.eye(d, dtype=object), [], [1]
    for k in range(1, d + 1):
        power = power @ (a @ a.T)
        traces.append(np.trace(power))
        wanted.append(-sum(wanted[k - i] * traces[i - 1] for i in range(1, k + 1)) // k)
    assert polynomial == wanted[::-1]
    roots, places = charpoly.largest_roots(polynomial, d, [])
    values = [v for v in np.sort(np.linalg.eigvalsh(np.array(matrix, dtype=float)))[::-1] if v > 1e-9]
    assert np.allclose([r / 2**places for r, m in roots for _ in range(m)], values, rtol=1e-9)


def test_roots_in_clusters_and_at_zero():
    # (x - 5)**3 (x - 7) x**2
    polynomial = [1]
    for root in (5, 5, 5, 7, 0, 0):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    roots, places = charpoly.largest_roots(polynomial, 6, [])
    assert [(r / 2**places, m) for r, m in roots] == [(7, 1), (5, 3)]
    assert [charpoly.roots_above(polynomial, a) for a in (-1, 0, 4, 5, 6, 7)] == [6, 4, 4, 1, 1, 0]
