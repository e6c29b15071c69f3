"""Tail probabilities of the t and F distributions, for whole batches of fits at once."""

from __future__ import annotations

import math

import numpy as np

TERMS = 500
TINY = 1e-300


def _continued_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), all elements together; NaN where it does not
    settle within ``TERMS`` terms."""

    def away(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) > TINY, v, TINY)

    c = np.ones_like(x)
    d = 1.0 / away(1.0 - (a + b) * x / (a + 1.0))
    h, open_ = d.copy(), np.ones(x.shape, bool)
    for m in range(1, TERMS):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / away(1.0 + num * d)
            c = away(1.0 + num / c)
            h = np.where(open_, h * d * c, h)
        open_ &= np.abs(d * c - 1.0) >= 1e-15
        if not open_.any():
            return h
    return np.where(open_ & (np.abs(d * c - 1.0) > 1e-12), np.nan, h)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Degrees of freedom take few different values, so each is looked at once."""
    values, where = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) if v > 0 else math.nan for v in values.tolist()])[where].reshape(x.shape)


def beta_inc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b), element by element."""
    a, b, x = (np.array(v, float) for v in np.broadcast_arrays(a, b, x))
    out = np.where(x >= 1.0, 1.0, np.where(x <= 0.0, 0.0, np.nan))
    ok = (x > 0.0) & (x < 1.0) & (a > 0) & (b > 0)
    if ok.any():
        p, q, v = a[ok], b[ok], x[ok]
        front = np.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(v) + q * np.log1p(-v))
        low = v < (p + 1.0) / (p + q + 2.0)
        s, t, w = np.where(low, p, q), np.where(low, q, p), np.where(low, v, 1.0 - v)
        part = front * _continued_fraction(s, t, w) / s
        out[ok] = np.where(low, part, 1.0 - part)
    return out


def t_two_sided(t, df) -> np.ndarray:
    """P(|T| > |t|); NaN without degrees of freedom."""
    t, df = (np.array(v, float) for v in np.broadcast_arrays(t, df))
    with np.errstate(all="ignore"):
        p = beta_inc(df / 2.0, 0.5, df / (df + t * t))
    return np.where(np.isfinite(t) & (df > 0), p, np.nan)


def f_upper(f, d1, d2) -> np.ndarray:
    """P(F > f); NaN without degrees of freedom."""
    f, d1, d2 = (np.array(v, float) for v in np.broadcast_arrays(f, d1, d2))
    with np.errstate(all="ignore"):
        p = beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * np.maximum(f, 0.0)))
    return np.where(np.isfinite(f) & (d2 > 0), p, np.nan)
