"""Exact derivatives of the probabilistic models, and the fit that uses them."""

import math

import numpy as np
import pytest

from patronage.functions.special import digamma, log_gamma, trigamma
from patronage.operators import likelihood as LK
from test_models import customers

BG = [(0.8, 10.0, 1.7, 2.5), (0.05, 300.0, 0.02, 0.4), (4.0, 1.0, 30.0, 2.0)]
GG = [(6.0, 3.7, 15.0), (0.3, 0.7, 900.0), (20.0, 1.5, 2.0)]


def rows_of(rng, n=40):
    x = rng.integers(0, 30, n).astype(float)
    T = rng.uniform(10, 500, n)
    return x, np.where(x > 0, T * rng.uniform(0, 1, n), 0.0), T


def differences(f, theta):
    """Gradient of the sums of ``f`` and of its gradient by central differences."""
    out = []
    for i, t in enumerate(theta):
        h = 1e-5 * t
        hi, lo = list(theta), list(theta)
        hi[i], lo[i] = t + h, t - h
        a, b = f(hi), f(lo)
        out.append(((a[0] - b[0]) / (2 * h), (a[1] - b[1]) / (2 * h)))
    return np.array([o[0] for o in out]), np.array([o[1] for o in out])


@pytest.mark.parametrize("terms, thetas, gamma", [(LK.bgnbd_terms, BG, False), (LK.gamma_gamma_terms, GG, True)])
def test_derivatives_equal_finite_differences(terms, thetas, gamma):
    rng = np.random.default_rng(5)
    x, tx, T = rows_of(rng)
    cols = (x + 1, rng.uniform(5, 400, len(x))) if gamma else (x, tx, T)

    def sums(theta):
        ll, grad, _ = terms(*cols, *theta)
        return ll.sum(), np.array([np.sum(g) for g in grad])
    for theta in thetas:
        d = len(theta)
        _, grad, hess = terms(*cols, *theta)
        g, h = differences(sums, theta)
        scale = np.array(theta)       # derivatives in ln θ, so that units do not matter
        exact = np.array([np.sum(v) for v in grad])
        assert np.allclose(exact * scale, g * scale, rtol=1e-6, atol=1e-6 * np.abs(exact * scale).max())
        full = np.zeros((d, d))
        for (i, j), v in zip(LK._upper(d), hess, strict=True):
            full[i, j] = full[j, i] = np.sum(v)
        by = np.outer(scale, scale)
        assert np.allclose(full * by, h * by, rtol=1e-6, atol=1e-6 * np.abs(full * by).max())


def test_digamma_and_trigamma():
    assert digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-13)
    assert digamma(np.array([0.5]))[0] == pytest.approx(-0.5772156649015329 - 2 * math.log(2), abs=1e-13)
    assert trigamma(np.array([1.0]))[0] == pytest.approx(math.pi ** 2 / 6, abs=1e-12)
    x = np.array([1e-3, 0.2, 3.0, 50.0, 1e6])
    assert np.allclose(digamma(x + 1), digamma(x) + 1 / x, rtol=1e-12)
    h = 1e-4 * x
    assert np.allclose((log_gamma(x + h) - log_gamma(x - h)) / (2 * h), digamma(x), rtol=1e-5, atol=1e-6)


def test_sums_add_up_over_tasks_and_weights(spark):
    rows = [(2, 10.0, 50.0, 3), (0, 0.0, 30.0, 5), (7, 80.0, 90.0, 1)] * 40
    df = spark.createDataFrame(rows, "x long, tx double, T double, w long")
    points = [list(BG[0]), list(BG[1])]
    one = LK.sums_at(df.coalesce(1), LK.bgnbd_terms, ["x", "tx", "T"], "w", points)
    many = LK.sums_at(df.repartition(7), LK.bgnbd_terms, ["x", "tx", "T"], "w", points)
    for a, b in zip(one, many, strict=True):
        assert a.n == b.n == 360
        assert a.ll == pytest.approx(b.ll) and np.allclose(a.grad, b.grad) and np.allclose(a.hess, b.hess)
    ll = LK.bgnbd_terms(np.array([2.0, 0, 7]), np.array([10.0, 0, 80]), np.array([50.0, 30, 90]), *BG[1])[0]
    assert one[1].ll == pytest.approx(40 * float(ll @ [3, 5, 1]))


def test_the_fit_ends_at_a_stationary_point_in_few_passes_with_errors(spark):
    df = spark.createDataFrame([(x, t / 500, T / 500, 1) for _, x, t, T in customers(8000)],
                               "x long, tx double, T double, w long").repartition(4).cache()
    found = LK.fit(df, LK.bgnbd_terms, ["x", "tx", "T"], "w", 4)
    end = LK.sums_at(df, LK.bgnbd_terms, ["x", "tx", "T"], "w", [list(found.theta)])[0]
    assert np.abs(end.grad * found.theta).max() / end.n < 1e-7
    assert found.passes <= 12
    true = np.array([0.9, 60 / 500, 0.9, 2.5])
    assert np.all(found.errors > 0) and np.all(np.abs(found.theta - true) < 4 * found.errors)
    # a quarter of the rows: errors twice as large
    less = LK.fit(df.where("hash(x, tx, T) % 4 = 0"), LK.bgnbd_terms, ["x", "tx", "T"], "w", 4)
    assert 1.2 < (less.errors / found.errors)[0] < 3.5
    df.unpersist()


def test_gamma_gamma_is_recovered(spark):
    rng = np.random.default_rng(3)
    p, q, v = 6.0, 4.0, 15.0
    x = rng.integers(1, 8, 8000)
    m = rng.gamma(p * x, 1 / rng.gamma(q, 1 / v, 8000)) / x
    df = spark.createDataFrame([(int(a), float(b), 1) for a, b in zip(x, m, strict=True)], "x long, m double, w long")
    found = LK.fit(df, LK.gamma_gamma_terms, ["x", "m"], "w", 3)
    assert np.all(np.abs(found.theta - [p, q, v]) < 4 * found.errors)


def test_tables_that_allow_no_fit(spark):
    empty = spark.createDataFrame([], "x long, tx double, T double, w long")
    found = LK.fit(empty, LK.bgnbd_terms, ["x", "tx", "T"], "w", 4)
    assert list(found.theta) == [1.0] * 4 and np.all(np.isnan(found.errors)) and found.passes == 1
    once = spark.createDataFrame([(0, 0.0, 5.0, 1)], "x long, tx double, T double, w long")
    assert np.all(np.isfinite(LK.fit(once, LK.bgnbd_terms, ["x", "tx", "T"], "w", 4, penalizer=0.01).theta))
