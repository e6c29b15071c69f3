"""Models against independent computations and by their defining properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import PCA as MLPCA
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from seriesmill.functions.tails import f_upper, t_two_sided
from seriesmill.operators import pca as P
from seriesmill.operators import regression as R
from seriesmill.operators import signals as G
from seriesmill.operators import sparse as L
from seriesmill.operators import moving as MV
from seriesmill.operators import tvp as K
from seriesmill.operators import tvp_score as KS

XS = ["x1", "x2", "x3", "x4", "x5"]
COLS = ["y", *XS]


def make_panel(seed: int, n: int = 160) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) * [1, 2, 0.5, 3, 1] + rng.normal(size=(n, 1))
    y = 0.3 + x @ [2.0, -1.0, 0.0, 0.5, 0.0] + rng.normal(size=n)
    d = pd.DataFrame(x, columns=XS).assign(y=y, panel_id=f"p{seed}", date=pd.date_range("2020-01-06", periods=n, freq="7D").date)
    return d


@pytest.fixture(scope="module")
def panels():
    short = make_panel(3, 40)
    hole = make_panel(4)
    hole.loc[10, "x2"] = np.nan
    const = make_panel(5)
    const["x3"] = 1.0
    return {p.panel_id.iloc[0]: p for p in (make_panel(1), make_panel(2), short, hole, const)}


@pytest.fixture(scope="module")
def df(spark, panels):
    d = spark.createDataFrame(pd.concat(panels.values()))
    return d.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in COLS}).repartition(7).cache()


def design(p: pd.DataFrame):
    p = p.dropna().sort_values("date")
    return p["y"].to_numpy(), np.column_stack([np.ones(len(p)), p[XS].to_numpy()])


def test_tails():
    assert t_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert t_two_sided(1.959963985, 1e7) == pytest.approx(0.05, abs=1e-6)
    assert t_two_sided(12.7062047, 1) == pytest.approx(0.05, abs=1e-8)
    assert f_upper(4.0, 1, 10) == pytest.approx(t_two_sided(2.0, 10), rel=1e-10)
    assert f_upper(3.3258345, 5, 10) == pytest.approx(0.05, abs=1e-6)


def test_ols(df, panels):
    out = R.ols(df, "y", XS).toPandas().set_index(["panel_id", "term"])
    diag = R.ols_diag(df, "y", XS).toPandas().set_index("panel_id")
    for name in ("p1", "p2", "p3", "p4"):
        y, x = design(panels[name])
        b, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
        s2 = rss[0] / (len(y) - 6)
        se = np.sqrt(s2 * np.diag(np.linalg.inv(x.T @ x)))
        terms = ["intercept", *XS]
        np.testing.assert_allclose([out.loc[(name, t), "coef"] for t in terms], b, atol=1e-9)
        np.testing.assert_allclose([out.loc[(name, t), "se"] for t in terms], se, rtol=1e-9)
        np.testing.assert_allclose([out.loc[(name, t), "p"] for t in terms], [t_two_sided(v, len(y) - 6) for v in b / se], atol=1e-12)
        e = y - x @ b
        r2 = 1 - rss[0] / ((y - y.mean()) ** 2).sum()
        d = diag.loc[name]
        assert (d.n, d.r2) == (len(y), pytest.approx(r2))
        assert d.adj_r2 == pytest.approx(1 - (1 - r2) * (len(y) - 1) / (len(y) - 6))
        assert d.dw == pytest.approx((np.diff(e) ** 2).sum() / (e @ e))
        assert d.f == pytest.approx((r2 / 5) / ((1 - r2) / (len(y) - 6)), rel=1e-8)
    # A constant factor is absorbed by the intercept; the fit stays that of the other factors.
    y, x = design(panels["p5"])
    keep = [0, 1, 2, 4, 5]
    b, *_ = np.linalg.lstsq(x[:, keep], y, rcond=None)
    got = [out.loc[("p5", t), "coef"] for t in ["intercept", "x1", "x2", "x4", "x5"]]
    np.testing.assert_allclose(got, b, atol=1e-9)
    assert out.loc[("p5", "x3"), "coef"] == pytest.approx(0.0, abs=1e-12)


def test_residuals_are_orthogonal(df):
    res = R.ols_apply(df, R.ols_fit(df, "y", XS), "y", XS)
    s = res.groupBy("panel_id").agg(F.sum("resid").alias("s"), *[F.sum(F.col("resid") * F.col(x)).alias(x) for x in XS]).toPandas()
    assert np.abs(s[["s", *XS]].to_numpy()).max() < 1e-8


def test_ols_agrees_with_ml(df):
    one = VectorAssembler(inputCols=XS, outputCol="f").transform(df.filter("panel_id = 'p1'"))
    m = LinearRegression(featuresCol="f", labelCol="y", solver="normal").fit(one)
    got = {r.term: r for r in R.ols(df.filter("panel_id = 'p1'"), "y", XS).collect()}
    np.testing.assert_allclose([got[x].coef for x in XS], m.coefficients.toArray(), atol=1e-8)
    np.testing.assert_allclose([got[t].p for t in [*XS, "intercept"]], m.summary.pValues, atol=1e-9)


def test_rolling_ols_is_a_direct_fit(df, panels):
    clean = df.filter(R.complete(COLS))
    out = MV.moving_ols(clean, 52, "y", XS).toPandas().set_index(["panel_id", "date"])
    y, x = design(panels["p1"])
    dates = sorted(panels["p1"]["date"])
    assert out.loc["p1"]["r2"].notna().sum() == len(y) - 52
    assert out.loc["p3"]["r2"].isna().all(), "fewer rows than the window"
    for i in (52, 53, 90, 159):
        b, rss, *_ = np.linalg.lstsq(x[i - 52 : i], y[i - 52 : i], rcond=None)
        r = out.loc[("p1", dates[i])]
        np.testing.assert_allclose([r.intercept, *[r[f"beta_{c}"] for c in XS]], b, atol=1e-9)
        assert r.oos_resid == pytest.approx(y[i] - x[i] @ b, abs=1e-9)
        assert r.r2 == pytest.approx(1 - rss[0] / ((y[i - 52 : i] - y[i - 52 : i].mean()) ** 2).sum())


def _scaled(p):
    y, x = design(p)
    x = x[:, 1:]
    return y - y.mean(), (x - x.mean(0)) / x.std(0)


@pytest.mark.parametrize("ratio", [1.0, 0.5])
def test_lasso_optimality(df, panels, ratio):
    path = L.lasso_path(df.filter("panel_id in ('p1', 'p4')"), "y", XS, l1_ratio=ratio).toPandas()
    for name in ("p1", "p4"):
        y, x = _scaled(panels[name])
        table = path[path.panel_id == name].pivot(index="alpha", columns="term", values="coef_std")[XS]
        assert len(table) == 200
        for a in table.index[::23]:
            w = table.loc[a].to_numpy()
            grad = x.T @ (y - x @ w) / len(y) - a * (1 - ratio) * w
            active = np.abs(w) > 0
            np.testing.assert_allclose(grad[active], a * ratio * np.sign(w[active]), atol=1e-7)
            assert (np.abs(grad[~active]) <= a * ratio + 1e-7).all()
        if ratio == 1.0:
            top = np.abs(x.T @ y / len(y)).max()
            assert (table[table.index > top] == 0).all().all()
            ols = np.linalg.lstsq(x, y, rcond=None)[0]
            np.testing.assert_allclose(table.iloc[0], ols, atol=2e-3)


def test_lasso_cv_is_contiguous_cross_validation(df, panels):
    cv = L.lasso_cv(df.filter("panel_id = 'p4'"), "y", XS).toPandas().set_index("term")
    p = panels["p4"].dropna().sort_values("date")
    y, x = p["y"].to_numpy(), p[XS].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    alphas = np.logspace(-4, 1, 200)[::-1]
    err = np.zeros(200)
    for test in np.array_split(np.arange(len(y)), 10):
        train = np.setdiff1d(np.arange(len(y)), test)
        zt, yt = z[train], y[train]
        zm, ym = zt.mean(0), yt.mean()
        w = L.path(np.array([(zt - zm).T @ (zt - zm) / len(yt)]), np.array([(zt - zm).T @ (yt - ym) / len(yt)]), alphas, 1.0)[0][:, 0]
        pred = ym + (z[test] - zm) @ w.T
        err += ((y[test][:, None] - pred) ** 2).mean(0) / 10
    assert cv["alpha"].iloc[0] == pytest.approx(alphas[err.argmin()])
    assert bool(cv.loc["x1", "selected"]) and cv.loc["x1", "coef"] == pytest.approx(cv.loc["x1", "coef_std"] / x[:, 0].std())
    fit = cv.loc["intercept", "coef"] + x @ cv.loc[XS, "coef"].to_numpy()
    assert cv["r2"].iloc[0] == pytest.approx(1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_lasso_agrees_with_ml(spark, df, panels):
    p = panels["p1"]
    x = p[XS].to_numpy()
    z = pd.DataFrame((x - x.mean(0)) / x.std(0), columns=XS).assign(y=p["y"].to_numpy())
    f = VectorAssembler(inputCols=XS, outputCol="f").transform(spark.createDataFrame(z))
    m = LinearRegression(featuresCol="f", labelCol="y", elasticNetParam=1.0, regParam=0.1, standardization=False, tol=1e-12, maxIter=1000).fit(f)
    got = L.lasso_path(df.filter("panel_id = 'p1'"), "y", XS, alphas=[0.1]).toPandas().set_index("term")
    # The library divides the penalty by the standard deviation of the label only when it standardises.
    np.testing.assert_allclose(got.loc[XS, "coef_std"], m.coefficients.toArray(), atol=1e-5)


def test_lasso_drops_and_names(df):
    s = L.selection_summary(L.lasso_cv(df.filter("panel_id = 'p1'"), "y", XS, alphas=[1e3])).first()
    assert (s.selected, s.dropped) == ("None", "x1, x2, x3, x4, x5")


def test_pca(spark, df, panels):
    good = df.filter("panel_id <> 'p5'")
    fit = P.pca_fit(good, COLS)
    ld = P.loadings(fit, COLS).toPandas()
    ex = P.explained(fit).toPandas()
    sc = P.scores(good, fit, COLS).toPandas()
    for name in ("p1", "p4"):
        v = ld[ld.panel_id == name].pivot(index="series", columns="pc", values="loading").loc[COLS].to_numpy()
        np.testing.assert_allclose(v.T @ v, np.eye(6), atol=1e-10)
        assert (np.take_along_axis(v, np.abs(v).argmax(0)[None], 0) > 0).all()
        e = ex[ex.panel_id == name].sort_values("pc")
        assert e.cum_share.iloc[-1] == pytest.approx(100) and e.share.is_monotonic_decreasing
        x = panels[name].dropna().sort_values("date")[COLS].to_numpy()
        z = (x - x.mean(0)) / x.std(0)
        got = sc[sc.panel_id == name].sort_values("date")[[f"pc{i}" for i in range(1, 7)]].to_numpy()
        np.testing.assert_allclose(got, z @ v, atol=1e-8)
        np.testing.assert_allclose(got.var(0) / 6 * 100, e.share, atol=1e-8)
    x = panels["p1"][COLS].to_numpy()
    f = VectorAssembler(inputCols=COLS, outputCol="f").transform(spark.createDataFrame(pd.DataFrame((x - x.mean(0)) / x.std(0), columns=COLS)))
    m = MLPCA(k=6, inputCol="f", outputCol="o").fit(f)
    np.testing.assert_allclose(ex[ex.panel_id == "p1"].sort_values("pc").share, m.explainedVariance.toArray() * 100, atol=1e-8)


@pytest.fixture(scope="module")
def walk():
    rng = np.random.default_rng(8)
    n, k = 300, 2
    beta = np.cumsum(rng.normal(scale=0.1, size=(n, k)), 0) + [1.0, -0.5]
    x = rng.normal(size=(n, k)) * 2
    y = (x * beta).sum(1) + rng.normal(scale=0.5, size=n)
    d = pd.DataFrame(x, columns=["x1", "x2"]).assign(y=y, series_id="w", date=pd.date_range("2020-01-01", periods=n).date)
    return d, beta


@pytest.fixture(scope="module")
def wdf(spark, walk):
    a = walk[0]
    return spark.createDataFrame(pd.concat([a, a.assign(series_id="v", y=a.y * 2)])).repartition(5).cache()


def dense_posterior(d, q, h, upto=None):
    """Posterior of all betas of a series by one large least-squares problem."""
    n = upto or len(d)
    y, x = d["y"].to_numpy()[:n], d[["x1", "x2"]].to_numpy()[:n]
    k = 2
    prec = np.zeros((n * k, n * k))
    rhs = np.zeros(n * k)
    for t in range(n):
        s = slice(t * k, (t + 1) * k)
        prec[s, s] += np.outer(x[t], x[t]) / h
        rhs[s] += x[t] * y[t] / h
        if t == 0:
            prec[s, s] += np.eye(k) / K.PRIOR_VARIANCE
        else:
            b = slice((t - 1) * k, t * k)
            prec[s, s] += np.eye(k) / q
            prec[b, b] += np.eye(k) / q
            prec[s, b] -= np.eye(k) / q
            prec[b, s] -= np.eye(k) / q
    cov = np.linalg.inv(prec)
    return (cov @ rhs).reshape(n, k), np.sqrt(np.diag(cov)).reshape(n, k)


def test_filter_and_smoother(wdf, walk):
    d, beta = walk
    q, h = 0.01, 0.25
    f = K.tvp_filter(wdf, "y", ["x1", "x2"], q, h).toPandas()
    w = f[f.series_id == "w"].sort_values("date")
    assert w.innov.iloc[0] == pytest.approx(d.y.iloc[0])
    for n in (1, 2, 60):
        b, se = dense_posterior(d, q, h, n)
        np.testing.assert_allclose(w.beta.iloc[n - 1], b[-1], atol=1e-4)
        np.testing.assert_allclose(w.se.iloc[n - 1], se[-1], rtol=1e-4)
    z = (w.innov / np.sqrt(w.innov_var)).to_numpy()[20:]
    assert abs(z.mean()) < 0.15 and 0.85 < z.std() < 1.15 and abs(np.corrcoef(z[1:], z[:-1])[0, 1]) < 0.15
    m = 60
    head = wdf.filter(F.col("date") <= F.lit(d["date"].iloc[m - 1]))
    s = K.tvp_smooth(head, "y", ["x1", "x2"], q, h).toPandas()
    b, se = dense_posterior(d, q, h, m)
    for i, term in enumerate(["x1", "x2"]):
        t = s[(s.series_id == "w") & (s.term == term)].sort_values("date")
        np.testing.assert_allclose(t.beta, b[:, i], atol=1e-5)
        np.testing.assert_allclose(t.se, se[:, i], rtol=1e-4)
        np.testing.assert_allclose(t.hi - t.lo, 2 * 1.96 * t.se)
        assert t.beta.iloc[-1] == pytest.approx(w.beta.iloc[m - 1][i], abs=1e-8)
        assert np.abs(t.beta - beta[:m, i]).mean() < 0.25
    assert np.allclose(f[f.series_id == "v"].sort_values("date").innov, 2 * w.innov, atol=1e-6)


def test_innovations_use_the_betas_of_the_row_before(wdf):
    f = K.tvp_predictions(K.tvp_filter(wdf, "y", ["x1", "x2"], 0.01, 0.25).drop("y"), ["x1", "x2"])
    j = f.join(wdf, ["series_id", "date"])
    gap = F.col("y") - F.col("prior_beta")[0] * F.col("x1") - F.col("prior_beta")[1] * F.col("x2") - F.col("innov")
    assert j.agg(F.max(F.abs(gap))).first()[0] < 1e-9


def test_filter_refuses_repeated_dates(wdf):
    with pytest.raises(Exception, match="must be unique"):
        K.tvp_filter(wdf.unionByName(wdf), "y", ["x1", "x2"], 0.01, 0.25).count()


def test_filter_reads_a_series_in_small_batches(spark, wdf):
    want = K.tvp_filter(wdf, "y", ["x1", "x2"], 0.01, 0.25).select("series_id", "date", "innov").toPandas()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = K.tvp_filter(wdf, "y", ["x1", "x2"], 0.01, 0.25).select("series_id", "date", "innov").toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    key = ["series_id", "date"]
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True), want.sort_values(key, ignore_index=True))


def test_constant_betas_are_least_squares(wdf, walk):
    d = walk[0]
    w = K.tvp_filter(wdf.filter("series_id = 'w'"), "y", ["x1", "x2"], 0.0, 0.25, intercept=True).toPandas().sort_values("date")
    x = np.column_stack([np.ones(len(d)), d[["x1", "x2"]]])
    np.testing.assert_allclose(w.beta.iloc[-1], np.linalg.lstsq(x, d["y"], rcond=None)[0], atol=1e-5)


def test_likelihood(wdf, walk):
    d = walk[0]
    y, x = d["y"].to_numpy(), d[["x1", "x2"]].to_numpy()
    f = K.tvp_filter(wdf.filter("series_id = 'w'"), "y", ["x1", "x2"], 0.01, 0.25).toPandas()
    ll = -0.5 * (np.log(2 * np.pi) + np.log(f.innov_var) + f.innov**2 / f.innov_var).sum()
    assert K.loglik(y, x, np.array([0.25]), np.array([0.01]))[0] == pytest.approx(ll)
    m = KS.tvp_mle(wdf, "y", ["x1", "x2"]).toPandas().set_index("series_id").loc["w"]
    assert m.loglik >= ll
    for dh in (0.97, 1.0, 1.03):
        for dq in (0.9, 1.0, 1.1):
            other = K.loglik(y, x, np.array([m.sigma2_obs * dh]), np.array([m.sigma2_state * dq]))[0]
            assert other <= m.loglik + 1e-2
    assert 0.15 < m.sigma2_obs < 0.4 and 0.004 < m.sigma2_state < 0.025


def test_signals(df, panels):
    s = G.rich_cheap(df, "y", XS).toPandas().set_index("panel_id")
    y, x = design(panels["p1"])
    e = pd.Series(y - x @ np.linalg.lstsq(x, y, rcond=None)[0])
    c = e.cumsum()
    z = ((c - c.rolling(104).mean()) / c.rolling(104).std()).iloc[-1]
    assert s.loc["p1"].z_cum == pytest.approx(z, abs=1e-7)
    assert s.loc["p1"].trend == ("Richening" if e.iloc[-4:].mean() > 0 else "Cheapening")
    short = s.loc["p3"]
    assert (short.verdict, bool(short.has_history)) == ("FAIR VALUE", False)


def test_model_compare(df):
    one = df.filter("panel_id = 'p1'")
    sm = K.tvp_smooth(one, "y", XS, 1e-4, 1.0, ("panel_id",))
    r = G.model_compare(one, sm, "y", XS).toPandas()
    assert len(r) == 5
    np.testing.assert_allclose(r.delta, r.tvp_beta - r.ols_beta)
    y = sm.filter("term = 'x1'").toPandas()
    r2 = 1 - ((y.y - y.fitted) ** 2).sum() / ((y.y - y.y.mean()) ** 2).sum()
    assert r.tvp_r2.iloc[0] == pytest.approx(r2) and r.gain_pp.iloc[0] == pytest.approx((r2 - r.ols_r2.iloc[0]) * 100)


def test_burn(df):
    f = K.tvp_filter(df.filter("panel_id = 'p1'"), "y", XS, 1e-4, 1.0, ("panel_id",))
    full, cut = G.rich_cheap_tvp(f, 12, 24).first(), G.rich_cheap_tvp(f, 12, 24, burn=10).first()
    assert full.resid == pytest.approx(cut.resid) and full.cum_resid != pytest.approx(cut.cum_resid)


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_partitioning_does_not_change_results(spark, df, parts):
    key = ["panel_id", "date"]
    base = G.signal_path(G.static_residuals(df, "y", XS)).select(*key, "z", "z_cum").toPandas().sort_values(key, ignore_index=True)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = G.signal_path(G.static_residuals(df.repartition(parts), "y", XS)).select(*key, "z", "z_cum").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True), base, rtol=1e-7)
