"""The exact score and the search that follows it."""

import numpy as np
import pytest

from seriesmill.operators import tvp as K
from seriesmill.operators import tvp_score as S

LENGTHS = [300, 120, 83, 60, 40, 12, 5, 2, 1]


@pytest.fixture(scope="module")
def batch():
    rng = np.random.default_rng(11)
    ys, xs = [], []
    for n in LENGTHS:
        x = rng.normal(1, 1, (n, 2))
        b = np.cumsum(rng.normal(0, 0.0 if n == 60 else 0.2, (n, 2)), 0) + 1
        xs.append(x), ys.append((x * b).sum(1) + rng.normal(0, 0.5, n))
    n = np.array(LENGTHS)
    return S.Batch(np.concatenate(ys), np.concatenate(xs), np.cumsum(n) - n, n)


def own(batch, i):
    a = batch.starts[i]
    return batch.y[a : a + batch.lengths[i]], batch.x[a : a + batch.lengths[i]]


@pytest.mark.parametrize("h, q", [(0.3, 0.02), (0.3, 1e-4), (0.05, 0.5)])
def test_score_is_the_derivative_of_the_likelihood(batch, h, q):
    many = np.ones(len(LENGTHS))
    ll, dh, dq = batch.score(h * many, q * many)
    d = 1e-4
    for i in range(len(LENGTHS)):
        assert ll[i] == pytest.approx(K.loglik(*own(batch, i), np.array([h]), np.array([q]))[0], rel=1e-9)
    by_h = (batch.loglik(h * (1 + d) * many, q * many) - batch.loglik(h * (1 - d) * many, q * many)) / (2 * d)
    by_q = (batch.loglik(h * many, q * (1 + d) * many) - batch.loglik(h * many, q * (1 - d) * many)) / (2 * d)
    np.testing.assert_allclose(h * dh / 2, by_h, rtol=1e-3, atol=1e-4)
    np.testing.assert_allclose(q * dq / 2, by_q, rtol=1e-3, atol=1e-4)


def test_no_grid_finds_more_and_the_score_is_zero(batch):
    got = S.maximise_all(batch)
    for i, n in enumerate(LENGTHS):
        y, x = own(batch, i)
        for width in (3.0, 0.3, 0.03):
            gh, gq = (g.ravel() for g in np.meshgrid(*[np.log10(got[c][i]) + np.linspace(-width, width, 15) for c in ("sigma2_obs", "sigma2_state")]))
            assert K.loglik(y, x, 10**gh, 10**gq).max() <= got["loglik"][i] + 1e-4, n
        assert abs(got["score_obs"][i]) < 1e-5 and abs(got["score_state"][i]) < 1e-5
        if n <= 2 or n >= 40 and n != 60:
            assert got["at_bound"][i] == (n <= 2)
    free = ~got["at_bound"]
    assert np.isfinite(got["se_obs"][free]).all() and np.isfinite(got["se_state"][free]).all() and np.isnan(got["se_state"][~free]).all()


def test_errors_come_from_the_observed_information(batch):
    got = S.maximise_all(batch.some(np.array([0])))
    y, x = own(batch, 0)
    h, q = got["sigma2_obs"][0], got["sigma2_state"][0]
    f = lambda a, b: K.loglik(y, x, np.array([h * np.exp(a)]), np.array([q * np.exp(b)]))[0]
    e = 1e-2
    hh, qq = (f(e, 0) - 2 * f(0, 0) + f(-e, 0)) / e**2, (f(0, e) - 2 * f(0, 0) + f(0, -e)) / e**2
    hq = (f(e, e) - f(e, -e) - f(-e, e) + f(-e, -e)) / (4 * e**2)
    errors = np.sqrt(np.diag(np.linalg.inv(-np.array([[hh, hq], [hq, qq]]))))
    np.testing.assert_allclose([got["se_obs"][0] / h, got["se_state"][0] / q], errors, rtol=1e-2)


def test_batches_and_partitions_do_not_matter(spark, batch):
    rows = [(f"s{i}" if i else None, t, float(a), float(b[0]), float(b[1])) for i in range(len(LENGTHS)) for t, (a, b) in enumerate(zip(*own(batch, i)))]
    df = spark.createDataFrame(rows, "series_id string, date int, y double, x1 double, x2 double").repartition(6)
    want = S.maximise_all(batch)
    for size in (1, 150, 50_000):
        got = {r.series_id: r for r in S.tvp_mle(df, "y", ["x1", "x2"], batch_rows=size).collect()}
        assert {r.n for r in got.values()} == set(LENGTHS)
        for i, n in enumerate(LENGTHS):
            r = got[f"s{i}" if i else None]
            assert r.n == n and r.at_bound == want["at_bound"][i]
            assert r.loglik == pytest.approx(want["loglik"][i], abs=1e-6) and r.sigma2_obs == pytest.approx(want["sigma2_obs"][i], rel=1e-4)
    with pytest.raises(Exception, match="must be unique"):
        S.tvp_mle(df.unionByName(df.filter("series_id = 's3' and date = 7")), "y", ["x1", "x2"]).count()
    assert S.tvp_mle(df.limit(0), "y", ["x1", "x2"]).count() == 0
