"""The exact LASSO path: optimal at every penalty, equal to coordinate descent."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import sparse as L


def problems():
    rng = np.random.default_rng(5)
    for n, k, mix in ((200, 5, 0.0), (60, 8, 0.9), (40, 12, 0.5), (30, 3, 0.99), (500, 1, 0.0)):
        z = rng.normal(0, 1, (n, 1))
        x = np.sqrt(1 - mix) * rng.normal(0, 1, (n, k)) + np.sqrt(mix) * z
        x = (x - x.mean(0)) / x.std(0)
        y = x @ rng.normal(0, 1, k) + rng.normal(0, 1, n)
        yield x.T @ x / n, x.T @ (y - y.mean()) / n


def at(knots, a):
    alphas = np.array([q[0] for q in knots])[::-1]
    w = np.array([q[3] for q in knots])[::-1]
    return np.array([np.interp(a, alphas, w[:, j], right=0.0) for j in range(w.shape[1])])


@pytest.mark.parametrize("number", range(5))
def test_every_point_is_optimal(number):
    g, c = list(problems())[number]
    knots = L.homotopy(g, c)
    alphas = [q[0] for q in knots]
    assert alphas == sorted(alphas, reverse=True) and knots[-1][1] == "end" and alphas[-1] == 0.0
    np.testing.assert_allclose(knots[-1][3], np.linalg.solve(g, c), rtol=1e-8, atol=1e-10)
    for a in [*np.logspace(-4, 1, 60), *alphas[1:-1]]:
        w = at(knots, a)
        slope = c - g @ w
        assert np.all(np.abs(slope) <= a + 1e-9)
        moved = np.abs(w) > 1e-9
        np.testing.assert_allclose(slope[moved], a * np.sign(w[moved]), atol=1e-9)


@pytest.mark.parametrize("number", range(5))
def test_equal_to_coordinate_descent(number):
    g, c = list(problems())[number]
    grid = L.alpha_grid()[::-1]
    want, settled = L.path(g[None], c[None], grid, 1.0, tol=1e-13)
    got = np.array([at(L.homotopy(g, c), a) for a in grid])
    assert settled
    np.testing.assert_allclose(got, want[:, 0], atol=1e-8)


def test_ties_and_factors_without_news():
    g = np.eye(3)
    knots = L.homotopy(g, np.array([1.0, 1.0, -1.0]))
    assert {q[2] for q in knots if q[1] == "enter"} == {0, 1, 2}
    np.testing.assert_allclose(at(knots, 0.25), [0.75, 0.75, -0.75])
    twin = np.array([[1.0, 1.0], [1.0, 1.0]])
    assert [q[1] for q in L.homotopy(twin, np.array([0.5, 0.5]))] == ["enter", "end"]
    assert [q[1] for q in L.homotopy(np.zeros((2, 2)), np.zeros(2))] == ["end"]


def test_on_panels(spark):
    rng = np.random.default_rng(2)
    rows = []
    for p, n in (("a", 90), (None, 60), ("short", 1)):
        x = rng.normal(0, 1, (n, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.5], [0, 0, 1.0]])
        y = x @ [1.0, -0.5, 0.2] + rng.normal(0, 0.5, n)
        rows += [(p, f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "panel_id string, date string, y double, x1 double, x2 double, x3 double")
    knots = L.lasso_knots(df, "y", ["x1", "x2", "x3"])
    first = knots.where("panel_id = 'a'").orderBy("step", "term").toPandas()
    assert first.event.iloc[0] == "enter" and first.event.iloc[-1] == "end" and (first[first.step == 0].coef_std == 0).all()
    got = {(r.panel_id, round(r.alpha, 12), r.term): r.coef_std for r in L.at_penalties(knots).collect()}
    assert len(got) == 2 * 200 * 3
    for p in ("a", None):
        own = df.where(F.col("panel_id").eqNullSafe(F.lit(p))).withColumn("panel_id", F.lit("z"))
        for r in L.lasso_path(own, "y", ["x1", "x2", "x3"]).collect():
            assert got[p, round(r.alpha, 12), r.term] == pytest.approx(r.coef_std, abs=1e-8)
