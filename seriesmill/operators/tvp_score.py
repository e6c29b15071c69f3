"""Maximum likelihood of the random-walk regression by its exact score, for all series of a batch at once.

The smoothed disturbances of one backward pass give the derivative of the log likelihood by both variances. A coarse
grid finds the right hill, EM steps climb it, Newton steps on the score (its differences give the curvature) finish.
All series of a batch take each step together; a series that has settled drops out. The curvature at the optimum is
the observed information, so standard errors come with it.

Variances are searched within ``REACH`` decades around a start from the sample. ``at_bound``: the likelihood gains
nothing over a variance at the lower end, usually because the betas do not move; then the end is reported, without error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from seriesmill.operators.tvp import KEYS, PRIOR_VARIANCE, _by_series, _with_intercept

#: Decades searched below and above the start.
REACH = (9.0, 6.0)
GRID = (7, 11)
EM_STEPS, NEWTON_STEPS = 4, 40
#: Score per row at which a series has settled, the gain in log likelihood that counts as none, and the digits it is known to.
SETTLED, NO_GAIN, NOISE = 1e-8, 1e-6, 1e-10
#: Rows that are searched together at most; a longer series comes by itself.
BATCH_ROWS = 50_000


class Batch:
    """Several series, the longest first, so that those still running at a step are a prefix."""

    def __init__(self, y: np.ndarray, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.y, self.x, self.starts, self.lengths = y, x, starts, lengths
        self.k = x.shape[1]

    def some(self, at: np.ndarray) -> Batch:
        """The chosen series, in the order of ``at``, which keeps the longest first."""
        return Batch(self.y, self.x, self.starts[at], self.lengths[at])

    def _rows(self) -> Iterator[tuple[int, int, np.ndarray]]:
        for t in range(int(self.lengths[0])):
            m = int(np.searchsorted(-self.lengths, -t, side="left"))
            yield t, m, self.starts[:m] + t

    def loglik(self, h: np.ndarray, q: np.ndarray) -> np.ndarray:
        return self._pass(h, q, False)[0]

    def _pass(self, h: np.ndarray, q: np.ndarray, keep: bool):
        s, k = len(self.starts), self.k
        b, p = np.zeros((s, k)), np.tile(np.eye(k) * PRIOR_VARIANCE, (s, 1, 1))
        noise, total, steps = q[:, None, None] * np.eye(k), np.zeros(s), []
        for t, m, rows in self._rows():
            if t:
                p[:m] += noise[:m]
            x = self.x[rows]
            px = np.einsum("mij,mj->mi", p[:m], x)
            f = np.maximum(np.einsum("mi,mi->m", x, px), 0.0) + h[:m]  # rounding under the wide prior
            v = self.y[rows] - np.einsum("mi,mi->m", x, b[:m])
            gain = px / f[:, None]
            b[:m] += gain * v[:, None]
            p[:m] -= gain[:, :, None] * px[:, None, :]
            total[:m] -= 0.5 * (np.log(2 * np.pi * f) + v * v / f)
            if keep:
                steps.append((x, v / f, 1.0 / f, gain))
        return total, steps

    def score(self, h: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood, and twice its derivatives by h and by q."""
        total, steps = self._pass(h, q, True)
        s, k = len(self.starts), self.k
        r, n, dh, dq = np.zeros((s, k)), np.zeros((s, k, k)), np.zeros(s), np.zeros(s)
        for t in range(len(steps) - 1, -1, -1):
            x, e, w, gain = steps[t]
            m = len(x)
            later = self.lengths[:m] > t + 1  # a step of the betas follows this row
            dq[:m] += np.where(later, np.einsum("mi,mi->m", r[:m], r[:m]) - np.einsum("mii->m", n[:m]), 0.0)
            nk = np.einsum("mij,mj->mi", n[:m], gain)
            knk = np.einsum("mi,mi->m", gain, nk)
            u = e - np.einsum("mi,mi->m", gain, r[:m])
            dh[:m] += u * u - (w + knk)
            r[:m] += x * u[:, None]
            cross = nk[:, :, None] * x[:, None, :]
            n[:m] += x[:, :, None] * x[:, None, :] * (w + knk)[:, None, None] - cross - np.swapaxes(cross, 1, 2)
        return total, dh, dq


def maximise_all(batch: Batch) -> dict[str, np.ndarray]:
    """Variances, likelihood, errors and what is left of the score, for every series of the batch."""
    s, k = len(batch.starts), batch.k
    ends = batch.starts + batch.lengths
    var = np.array([np.var(batch.y[a:b]) for a, b in zip(batch.starts, ends)])
    xvar = np.array([np.mean(batch.x[a:b] ** 2) for a, b in zip(batch.starts, ends)])
    var, xvar = np.where(var > 0, var, 1.0), np.where(xvar > 0, xvar, 1.0)
    middle = np.log(np.column_stack([var / 10.0, var / xvar / 1e4]))
    low, high = middle - REACH[0] * np.log(10), middle + REACH[1] * np.log(10)

    best, theta = np.full(s, -np.inf), middle.copy()
    for dh in np.linspace(-2.0, 2.0, GRID[0]) * np.log(10):
        for dq in np.linspace(-6.0, 4.0, GRID[1]) * np.log(10):
            at = middle + (dh, dq)
            ll = batch.loglik(np.exp(at[:, 0]), np.exp(at[:, 1]))
            better = ll > best
            best, theta = np.where(better, ll, best), np.where(better[:, None], at, theta)

    n, moves = batch.lengths.astype(float), np.maximum((batch.lengths - 1) * k, 1).astype(float)
    for _ in range(EM_STEPS):
        h, q = np.exp(theta).T
        _, dh, dq = batch.score(h, q)
        grown = np.column_stack([np.log(np.maximum(h + h * h * dh / n, h * 1e-3)), np.log(np.maximum(q + q * q * dq / moves, q * 1e-3))])
        theta = np.clip(grown, low, high)

    def slope(part: Batch, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, q = np.exp(at).T
        ll, dh, dq = part.score(h, q)
        return ll, 0.5 * np.column_stack([h * dh, q * dq])

    def curvature(part: Batch, at: np.ndarray) -> np.ndarray:
        out = np.empty((len(at), 2, 2))
        for i in range(2):
            d = np.zeros(2)
            d[i] = 1e-4
            out[:, :, i] = (slope(part, at + d)[1] - slope(part, at - d)[1]) / 2e-4
        return (out + np.swapaxes(out, 1, 2)) / 2.0

    ll, g = slope(batch, theta)
    done = np.zeros(s, bool)
    for _ in range(NEWTON_STEPS):
        free = ~((theta <= low) & (g < 0) | (theta >= high) & (g > 0))
        open_ = np.flatnonzero(~done & (np.abs(g * free) > SETTLED * n[:, None]).any(1))
        if not len(open_):
            break
        part, at, ascent = batch.some(open_), theta[open_], (g * free)[open_]
        value, vec = np.linalg.eigh(-curvature(part, at))
        value = np.maximum(np.abs(value), 1e-3 * np.abs(value).max(1, keepdims=True) + 1e-12)
        step = np.einsum("mij,mj->mi", vec, np.einsum("mji,mj->mi", vec, ascent) / value)
        step = np.clip(step * free[open_], -3.0, 3.0)
        scale, left = np.ones(len(open_)), np.arange(len(open_))
        for _ in range(8):
            trial = np.clip(at[left] + scale[left, None] * step[left], low[open_[left]], high[open_[left]])
            found, slopes = slope(part.some(left), trial)
            good = found >= ll[open_[left]] - NOISE * np.abs(ll[open_[left]])
            won = open_[left[good]]
            theta[won], ll[won], g[won] = trial[good], found[good], slopes[good]
            left = left[~good]
            if not len(left):
                break
            scale[left] /= 4.0
        done[open_[left]] = True  # no step gains any more: the precision of the likelihood is reached

    # A variance that could as well be at its lower end has no optimum of its own.
    bound = np.zeros((s, 2), bool)
    for i in (1, 0):
        down = theta.copy()
        down[:, i] = low[:, i]
        ll_down = batch.loglik(*np.exp(down).T)
        bound[:, i] = ll_down >= ll - NO_GAIN
        theta[bound[:, i], i], ll = low[bound[:, i], i], np.where(bound[:, i], ll_down, ll)
    bound |= theta >= high
    h, q = np.exp(theta).T
    ll, g = slope(batch, theta)
    information = -curvature(batch, theta)
    for i in range(2):  # the error of the other variance alone
        information[bound[:, i], i, :] = information[bound[:, i], :, i] = 0.0
        information[bound[:, i], i, i] = 1.0
    with np.errstate(all="ignore"):
        inverse = np.linalg.pinv(information)
        errors = np.sqrt(np.where(np.einsum("mii->mi", inverse) > 0, np.einsum("mii->mi", inverse), np.nan))
    errors[bound] = np.nan
    return {"sigma2_obs": h, "sigma2_state": q, "loglik": ll, "at_bound": bound.any(1), "se_obs": h * errors[:, 0], "se_state": q * errors[:, 1],
            "score_obs": np.where(bound[:, 0], 0.0, g[:, 0]), "score_state": np.where(bound[:, 1], 0.0, g[:, 1])}


def tvp_mle(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS, order: str = "date", intercept: bool = False, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """(keys, n, sigma2_obs, sigma2_state, loglik, at_bound, se_obs, se_state, score_obs, score_state) per series.

    Tasks walk through their sorted series and search whole batches of them together; a series must fit a task, which
    series at date grain do. The scores are the derivatives by the logarithms of the variances: about zero, or zero by
    definition where the variance is at its bound.
    """
    df, xs = _with_intercept(df, xs, intercept)
    keys, k = list(keys), len(xs)
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)
    names = ["sigma2_obs", "sigma2_state", "loglik", "at_bound", "se_obs", "se_state", "score_obs", "score_state"]

    def search(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        lengths = np.diff(np.append(starts, len(pdf)))
        by_size = np.argsort(-lengths, kind="stable")
        found = maximise_all(Batch(pdf["_y"].to_numpy(float), np.array(pdf["_x"].tolist(), float).reshape(-1, k), starts[by_size], lengths[by_size]))
        out = pdf.iloc[starts[by_size]][keys].reset_index(drop=True)
        return out.assign(n=lengths[by_size], **{c: found[c] for c in names})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            starts = first_rows(held, keys, order)
            if len(held) >= batch_rows and len(starts) > 1:  # the last series may go on in the next batch
                yield search(held.iloc[: starts[-1]], starts[:-1])
                held = held.iloc[starts[-1] :].reset_index(drop=True)
        if held is not None and len(held):
            yield search(held, first_rows(held, keys, order))

    schema = f"{types}, n bigint, sigma2_obs double, sigma2_state double, loglik double, at_bound boolean, se_obs double, se_state double, score_obs double, score_state double"
    return _by_series(df, y, xs, keys, order).mapInPandas(run, schema)


def first_rows(pdf: pd.DataFrame, keys: Sequence[str], order: str) -> np.ndarray:
    """First row of each series in sorted rows; two rows of one date have no order, so they are refused."""
    new = np.zeros(len(pdf), bool)
    new[:1] = True
    for c in keys:
        codes = pd.factorize(pdf[c], use_na_sentinel=False)[0]
        new[1:] |= codes[1:] != codes[:-1]
    days = pdf[order].to_numpy()
    if (~new[1:] & (days[1:] == days[:-1])).any():
        raise ValueError("dates of a series must be unique")
    return np.flatnonzero(new)
