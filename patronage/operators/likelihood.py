"""Maximum likelihood with exact derivatives: BG/NBD (Fader, Hardie & Lee 2005)
and Gamma-Gamma (Fader & Hardie 2013).

A pass is one Spark job: each task adds up, over its weighted rows, the
log-likelihood, its gradient and its Hessian at a few trial points, and only
the sums of these reach the driver, so a pass costs the same driver memory at
every size of the table. The parameters are positive; steps are taken in their
logarithms.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.special import digamma, log_gamma, trigamma
from patronage.session import ship_package

#: Lengths of the trial steps of a pass, as parts of the trust radius.
TRIALS = (1.0, 0.25, 4.0)


def _upper(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


def bgnbd_terms(x, tx, T, r, alpha, a, b):
    """Per row: log-likelihood, gradient in (r, α, a, b), and the upper triangle of the Hessian.

    The likelihood is a mixture over whether the customer is still active (A) or
    has left after the last purchase (L, only with x > 0); ``p`` is the share of L.
    """
    zero, again = np.zeros_like(x), x > 0
    s, at, ax = r + x, alpha + T, alpha + tx
    before = np.where(again, b + x - 1, 1.0)
    alive = -s * np.log(at)
    left = np.where(again, math.log(a) - np.log(before) - s * np.log(ax), -np.inf)
    top = np.maximum(alive, left)
    mixed = top + np.log(np.exp(alive - top) + np.exp(left - top))
    p = np.exp(left - mixed)
    common = log_gamma(s) - math.lgamma(r) + r * math.log(alpha) + math.lgamma(a + b) + log_gamma(b + x) \
        - math.lgamma(b) - log_gamma(a + b + x)

    g_alive = (-np.log(at), -s / at, zero, zero)
    g_left = (-np.log(ax), -s / ax, zero + 1 / a, -1 / before)
    h_alive = {(0, 1): -1 / at, (1, 1): s / at ** 2}
    h_left = {(0, 1): -1 / ax, (1, 1): s / ax ** 2, (2, 2): zero - 1 / a ** 2, (3, 3): 1 / before ** 2}
    whole, share = digamma(a + b) - digamma(a + b + x), trigamma(a + b) - trigamma(a + b + x)
    g_common = (digamma(s) - digamma(r) + math.log(alpha), zero + r / alpha, whole,
                whole + digamma(b + x) - digamma(b))
    h_common = {(0, 0): trigamma(s) - trigamma(r), (0, 1): zero + 1 / alpha, (1, 1): zero - r / alpha ** 2,
                (2, 2): share, (2, 3): share, (3, 3): share + trigamma(b + x) - trigamma(b)}

    gap = [u - v for u, v in zip(g_left, g_alive, strict=True)]
    grad = [c + v + p * e for c, v, e in zip(g_common, g_alive, gap, strict=True)]
    hess = [h_common.get(k, 0.0) + (1 - p) * h_alive.get(k, 0.0) + p * h_left.get(k, 0.0)
            + p * (1 - p) * gap[k[0]] * gap[k[1]] for k in _upper(4)]
    return common + mixed, grad, hess


def gamma_gamma_terms(x, m, p, q, v):
    """Per row: log-likelihood, gradient in (p, q, v), and the upper triangle of the Hessian."""
    px = p * x
    s, whole = px + q, x * m + v
    ll = log_gamma(s) - log_gamma(px) - math.lgamma(q) + q * math.log(v) + (px - 1) * np.log(m) + px * np.log(x) \
        - s * np.log(whole)
    grad = [x * (digamma(s) - digamma(px) + np.log(m) + np.log(x) - np.log(whole)),
            digamma(s) - digamma(q) + math.log(v) - np.log(whole), q / v - s / whole]
    hess = [x * x * (trigamma(s) - trigamma(px)), x * trigamma(s), -x / whole,
            trigamma(s) - trigamma(q), 1 / v - 1 / whole, s / whole ** 2 - q / v ** 2]
    return ll, grad, hess


@dataclass
class Sums:
    """Weighted sums over the table at one point: rows, log-likelihood, gradient, Hessian."""
    n: float
    ll: float
    grad: np.ndarray
    hess: np.ndarray


def sums_at(table: DataFrame, terms: Callable, columns: list[str], weight: str, points: list) -> list[Sums]:
    """The sums at each point, in one job."""
    d = len(points[0])
    width = 1 + d + len(_upper(d))
    points = [[float(v) for v in p] for p in points]

    def part(batches):
        import pandas as pd
        total = np.zeros(1 + width * len(points))
        for pdf in batches:
            w = pdf[weight].to_numpy(dtype=float)
            cols = [pdf[c].to_numpy(dtype=float) for c in columns]
            total[0] += w.sum()
            for k, theta in enumerate(points):
                with np.errstate(all="ignore"):
                    ll, grad, hess = terms(*cols, *theta)
                    total[1 + k * width:1 + (k + 1) * width] += [float(np.dot(w, c)) for c in (ll, *grad, *hess)]
        yield pd.DataFrame([total], columns=names)

    names = [f"s{i}" for i in range(1 + width * len(points))]
    ship_package(table.sparkSession)
    row = table.select(weight, *columns).mapInPandas(part, ", ".join(f"{c} double" for c in names)) \
        .agg(*[F.sum(c).alias(c) for c in names]).first()
    flat = np.array([math.nan if v is None else v for v in row])
    out = []
    for k in range(len(points)):
        s = flat[1 + k * width:1 + (k + 1) * width]
        hess = np.zeros((d, d))
        for (i, j), h in zip(_upper(d), s[1 + d:], strict=True):
            hess[i, j] = hess[j, i] = h
        out.append(Sums(flat[0], s[0], s[1:1 + d], hess))
    return out


def _objective(theta: np.ndarray, s: Sums, penalizer: float):
    """−mean log-likelihood + penalizer · Σθ², with its gradient and Hessian in ln θ."""
    value = -s.ll / s.n + penalizer * float(theta @ theta)
    slope = -s.grad / s.n + 2 * penalizer * theta
    curve = -s.hess / s.n + 2 * penalizer * np.eye(len(theta))
    return value, slope * theta, curve * np.outer(theta, theta) + np.diag(slope * theta)


def _step(slope: np.ndarray, curve: np.ndarray, radius: float) -> np.ndarray:
    """The damped Newton step of a length up to ``radius``."""
    low = float(np.linalg.eigvalsh(curve).min())
    damp = max(0.0, 1e-8 - low)
    delta = -np.linalg.solve(curve + damp * np.eye(len(slope)), slope)
    norm = float(np.linalg.norm(delta))
    return delta * (radius / norm) if norm > radius else delta


@dataclass
class Fit:
    """Parameters, their standard errors (NaN where the information matrix is not
    positive definite), the weighted log-likelihood and the passes taken."""
    theta: np.ndarray
    errors: np.ndarray
    ll: float
    passes: int


def fit(table: DataFrame, terms: Callable, columns: list[str], weight: str, d: int, penalizer: float = 0.0,
        most_passes: int = 60, tol: float = 1e-7) -> Fit:
    """Newton's method within a trust radius, one job a pass.

    A pass looks at steps of several lengths at once and goes on from the best;
    the derivatives there are already known. An empty table, or one whose
    log-likelihood is not finite at the start, keeps all parameters at 1 with
    errors NaN.
    """
    u, radius = np.zeros(d), 2.0
    s = sums_at(table, terms, columns, weight, [np.exp(u)])[0]
    value, slope, curve = _objective(np.exp(u), s, penalizer) if s.n > 0 else (math.nan, None, None)
    passes = 1
    while math.isfinite(value) and passes < most_passes and float(np.linalg.norm(slope)) > tol:
        steps = list(dict.fromkeys(tuple(_step(slope, curve, radius * t)) for t in TRIALS))
        passes += 1
        found = []
        for delta, z in zip(steps, sums_at(table, terms, columns, weight, [np.exp(u + np.array(x)) for x in steps]),
                            strict=True):
            there = _objective(np.exp(u + np.array(delta)), z, penalizer)
            if all(np.all(np.isfinite(x)) for x in there):
                found.append((there[0], delta, z, there))
        best = min(found, key=lambda f: f[0], default=None)
        if best is not None and best[0] < value:
            gained, u, s = value - best[0], u + np.array(best[1]), best[2]
            radius = min(max(float(np.linalg.norm(best[1])), radius / 4), 8.0)
            value, slope, curve = best[3]
            if gained < 1e-14 * max(1.0, abs(value)):
                break
        else:
            radius *= min(TRIALS) / 4
            if radius < 1e-8:
                break
    theta = np.exp(u)
    return Fit(theta, standard_errors(s), s.ll, passes)


def standard_errors(s: Sums) -> np.ndarray:
    """Roots of the diagonal of the inverse observed information (without the penalty)."""
    d = len(s.grad)
    if not np.all(np.isfinite(s.hess)) or float(np.linalg.eigvalsh(-s.hess).min()) <= 0:
        return np.full(d, math.nan)
    return np.sqrt(np.diag(np.linalg.inv(-s.hess)))
