"""Moving co-moments equal a plain computation of every window, for any window, batch and chunk."""

import numpy as np
import pandas as pd
import pytest

from seriesmill.operators import moving as M

KEYS, ORDER = ["asset"], ["ts", "event_id"]


@pytest.fixture(scope="module")
def ticks():
    rng = np.random.default_rng(8)
    n = 2400
    asset = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b"], n)).astype(object)
    asset[:5] = ["one", "two", "two", None, None]
    x = rng.normal(0, 1, (n, 2))
    # A level of a million beside steps of a hundredth: plain sums of squares would keep no digit.
    y = 1e6 + 0.01 * (x[:, 0] - 2 * x[:, 1] + rng.normal(0, 0.5, n))
    d = pd.DataFrame({"asset": asset, "ts": rng.integers(0, 300, n), "event_id": np.arange(n), "y": y, "x1": x[:, 0], "x2": x[:, 1]})
    d.loc[rng.choice(n, 6, replace=False), "x2"] = np.nan
    return d


@pytest.fixture(scope="module")
def df(spark, ticks):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in ticks.itertuples(index=False)]
    return spark.createDataFrame(rows, "asset string, ts int, event_id int, y double, x1 double, x2 double").repartition(4)


def plain(ticks, n, lag, what):
    """``what`` of the exact rows of every window, by event."""
    out = {}
    for _, own in ticks.sort_values(ORDER).groupby("asset", dropna=False):
        v = own[["y", "x1", "x2"]].to_numpy()
        for i, event in enumerate(own["event_id"]):
            lo, hi = i - n + 1 - lag, i + 1 - lag
            out[event] = what(v[lo:hi], v[i]) if lo >= 0 else None
    return out


def check(df, want, cols, rtol=1e-10):
    got = {r.event_id: [r[c] for c in cols] for r in df.collect()}
    assert got.keys() == want.keys()
    for event, values in want.items():
        values = [None] * len(cols) if values is None else values
        for a, b in zip(got[event], values):
            assert (a is None) == (b is None or not np.isfinite(b)), (event, a, b)
            if a is not None:
                assert a == pytest.approx(b, rel=rtol, abs=rtol), event


@pytest.mark.parametrize("n, chunk", [(2, None), (7, 20), (52, None), (52, 60), (52, 100_000), (900, None), (900, 1000), (2500, None)])
def test_stats(spark, df, ticks, n, chunk):
    def what(w, row):
        std = (w[:, 0] - w[:, 0].mean()).std(ddof=1)
        return [w[:, 0].mean(), std, (row[0] - w[:, 0].mean()) / std]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        check(M.moving_stats(df, n, "y", KEYS, ORDER, rows_per_chunk=chunk), plain(ticks, n, 0, what), ["roll_mean", "roll_std", "z"], 1e-4 if n == 2 else 1e-7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("n, chunk", [(20, None), (20, 33), (300, 400)])
def test_correlations_hide_only_their_own_pair(df, ticks, n, chunk):
    def what(w, _):
        c = w - w.mean(0)
        return [float((c[:, 0] * c[:, k]).sum() / np.sqrt((c[:, 0] ** 2).sum() * (c[:, k] ** 2).sum())) for k in (1, 2)]

    check(M.moving_corr(df, n, "y", ["x1", "x2"], KEYS, ORDER, chunk), plain(ticks, n, 0, what), ["corr_x1", "corr_x2"], 1e-7)


@pytest.mark.parametrize("n, chunk", [(30, None), (30, 45), (400, 500)])
def test_regressions(df, ticks, n, chunk):
    def what(w, row):
        if np.isnan(w).any():
            return None
        mean = w.mean(0)
        c = w - mean
        b = np.linalg.lstsq(c[:, 1:], c[:, 0], rcond=None)[0]
        r2 = 1 - ((c[:, 0] - c[:, 1:] @ b) ** 2).sum() / (c[:, 0] ** 2).sum()
        return [mean[0] - mean[1:] @ b, *b, r2, row[0] - (mean[0] - mean[1:] @ b) - row[1:] @ b]

    check(M.moving_ols(df, n, "y", ["x1", "x2"], KEYS, ORDER, chunk), plain(ticks, n, 1, what), ["intercept", "beta_x1", "beta_x2", "r2", "oos_resid"], 1e-7)


def test_empty(df):
    assert M.moving_stats(df.limit(0), 5, "y", KEYS, ORDER).count() == 0
    assert M.moving_ols(df.limit(0), 5, "y", ["x1"], KEYS, ORDER, 100).count() == 0


def test_exact_to_ten_digits_without_a_large_level():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (5000, 3)).cumsum(0)
    for n in (1, 2, 52, 1000, 4999, 5000, 6000):
        ends, mean, s = M.windows(x, np.array([0, 700]), n)
        some = rng.choice(len(ends), min(len(ends), 60), replace=False) if len(ends) else []
        i, j = np.triu_indices(3)
        for k in some:
            w = x[ends[k] - n + 1 : ends[k] + 1]
            c = w - w.mean(0)
            np.testing.assert_allclose(mean[k], w.mean(0), rtol=1e-10, atol=1e-10)
            np.testing.assert_allclose(s[k], (c.T @ c)[i, j], rtol=1e-10, atol=1e-9)
        assert len(ends) == max(0, 700 - n + 1) + max(0, 4300 - n + 1)
