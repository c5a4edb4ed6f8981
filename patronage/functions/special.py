"""Special functions: log-gamma and its finite differences as Catalyst
expressions, and the array forms that the model tasks use (log-gamma, the Gauss
hypergeometric function)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def lgamma(z) -> Column:
    """ln Γ(z) for z > 0: shift by 8 (recurrence), then the Stirling series
    (absolute error below 1e-10)."""
    z = _c(z)
    w = z + 8.0
    stirling = ((w - 0.5) * F.log(w) - w + _HALF_LOG_2PI + 1.0 / (12.0 * w) - 1.0 / (360.0 * F.pow(w, 3))
                + 1.0 / (1260.0 * F.pow(w, 5)) - 1.0 / (1680.0 * F.pow(w, 7)))
    shift = F.log(z)
    for i in range(1, 8):
        shift = shift + F.log(z + float(i))
    return stirling - shift


def rising_log_sum(n: Column, *offsets: tuple[float, float]) -> Column:
    """Σ_{i<n} Σ_k sign_k · ln(base_k + i), for integer n ≥ 0 — i.e. sums of
    finite log-gamma differences lnΓ(base+n) − lnΓ(base). ``offsets`` are
    (base, sign) pairs. Zero when n = 0 (``sequence(0, -1)`` is guarded)."""
    seq = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)).cast("int"))

    def step(acc, i):
        out = acc
        for base, sign in offsets:
            out = out + F.lit(float(sign)) * F.log(F.lit(float(base)) + i)
        return out
    return F.when(n > 0, F.aggregate(seq, F.lit(0.0), step)).otherwise(F.lit(0.0))


def hyp2f1(a, b, c, z, tol: float = 1e-14) -> np.ndarray:
    """₂F₁(a, b; c; z) for arrays with 0 ≤ z < 1.

    Euler's transformation first, (1 − z)^(c−a−b) · ₂F₁(c−a, c−b; c; z), whose
    terms fall faster for the arguments met here; then the power series. A row
    is summed until what is left of it (a geometric tail) is below ``tol`` of
    its sum: there is no fixed number of terms.
    """
    a, b, c, z = (np.array(x, dtype=float) for x in np.broadcast_arrays(a, b, c, z))
    p, q = c - a, c - b
    total = np.ones_like(z)
    live = np.arange(z.size)
    term = np.ones(z.size)
    lp, lq, lc, lz = p.ravel(), q.ravel(), c.ravel(), z.ravel()
    flat, n = total.ravel(), 0
    while live.size:
        term = term * (lp + n) * (lq + n) / ((lc + n) * (n + 1)) * lz
        flat[live] += term
        n += 1
        settled = n > np.maximum(np.abs(lp), np.abs(lq))
        on = ~settled | (np.abs(term) > tol * np.abs(flat[live]) * (1 - lz))
        on &= term != 0
        if not on.all():
            live, term, lp, lq, lc, lz = (x[on] for x in (live, term, lp, lq, lc, lz))
    return np.power(1 - z, c - a - b) * flat.reshape(z.shape)


def log_gamma(x) -> np.ndarray:
    """ln Γ(x) for an array of x > 0 (the numpy form of ``lgamma``)."""
    x = np.asarray(x, dtype=float)
    w = x + 8.0
    out = (w - 0.5) * np.log(w) - w + _HALF_LOG_2PI + 1 / (12 * w) - 1 / (360 * w ** 3) + 1 / (1260 * w ** 5) \
        - 1 / (1680 * w ** 7)
    for i in range(8):
        out = out - np.log(x + i)
    return out


#: Bernoulli numbers B2, B4, ... of the asymptotic series.
_BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730)


def digamma(x) -> np.ndarray:
    """ψ(x), the derivative of ln Γ, for an array of x > 0: shift by 8, then the asymptotic series."""
    x = np.asarray(x, dtype=float)
    w = x + 8.0
    out = np.log(w) - 1 / (2 * w) - sum(b / (2 * k * w ** (2 * k)) for k, b in enumerate(_BERNOULLI, 1))
    for i in range(8):
        out = out - 1 / (x + i)
    return out


def trigamma(x) -> np.ndarray:
    """ψ'(x), the derivative of ``digamma``, for an array of x > 0."""
    x = np.asarray(x, dtype=float)
    w = x + 8.0
    out = 1 / w + 1 / (2 * w * w) + sum(b / w ** (2 * k + 1) for k, b in enumerate(_BERNOULLI, 1))
    for i in range(8):
        out = out + 1 / (x + i) ** 2
    return out
