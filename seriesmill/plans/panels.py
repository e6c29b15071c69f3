"""Queries on the weekly panel, the monthly segment panels and the models fitted to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions import windows as W
from seriesmill.operators import aggregates as A
from seriesmill.operators import joins as J
from seriesmill.operators import pca as P
from seriesmill.operators import regression as R
from seriesmill.operators import signals as G
from seriesmill.operators import sparse as L
from seriesmill.operators import moving as MV
from seriesmill.operators import tvp as K
from seriesmill.operators import tvp_score as KS
from seriesmill.operators.cleaning import drop_incomplete, is_selected, select_factors
from seriesmill.plans import sql as Q
from seriesmill.plans.registry import query, tidy
from seriesmill.sources import tables as S

X, COLS, KEY = S.FACTORS, ["y", *S.FACTORS], ("panel_id",)
Q_STATE, H_OBS = 0.0005, 60.0  # parameters of the registered filters


def weekly_returns(spark: SparkSession, sf: str) -> DataFrame:
    return drop_incomplete(W.log_return(S.price_panel(spark, sf), COLS, KEY), COLS)


def segment_returns(spark: SparkSession, sf: str) -> DataFrame:
    return drop_incomplete(W.log_return(S.segment_panels(spark, sf), COLS, KEY), COLS)


_WEEK = f"WITH RECURSIVE {Q.panel()}, {Q.RETS}"
_SEG = f"WITH RECURSIVE {Q.segment_panels()}, {Q.RETS}"


@query("panel_wide", f"WITH {Q.panel()} SELECT * FROM panel")
def panel_wide(spark, sf):
    return select_factors(S.price_panel(spark, sf), COLS)


@query("panels_by_segment", f"WITH {Q.segment_panels()} SELECT * FROM panel")
def panels_by_segment(spark, sf):
    return S.segment_panels(spark, sf)


@query("to_long", f"WITH {Q.panel()} " + " UNION ALL ".join(f"SELECT panel_id, date, '{c}' AS series, {c} AS value FROM panel" for c in COLS))
def to_long(spark, sf):
    return J.unpivot(S.price_panel(spark, sf), ["panel_id", "date"], COLS)


@query("returns_complete", f"{_WEEK} SELECT panel_id, date, {Q.rnds(COLS)} FROM rets")
def returns_complete(spark, sf):
    return tidy(weekly_returns(spark, sf))


@query("returns_by_segment", f"{_SEG} SELECT panel_id, date, {Q.rnds(COLS)} FROM rets")
def returns_by_segment(spark, sf):
    return tidy(segment_returns(spark, sf))


_SUM = (
    "SELECT series, {r} FROM (SELECT series, avg(ret) * 52 AS ann_return, stddev_samp(ret) * sqrt(52) AS ann_vol, "
    "avg(ret) / stddev_samp(ret) * sqrt(52) AS sharpe, skewness(ret) AS skew, kurtosis(ret) AS kurt, max(ret) AS best, "
    "min(ret) AS worst, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS series, {c} AS ret FROM rets" for c in COLS) + ") GROUP BY 1) "
    "JOIN (SELECT series, min(v / m - 1) * 100 AS max_drawdown FROM (SELECT series, v, max(v) OVER (PARTITION BY series ORDER BY date) AS m FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS series, date, {c} AS v FROM panel" for c in COLS) + ")) GROUP BY 1) USING (series)"
).format(r=Q.rnds("ann_return ann_vol sharpe skew kurt best worst max_drawdown") + ", n")


@query("summary_stats", f"{_WEEK} {_SUM}")
def summary_stats(spark, sf):
    ids = ["panel_id", "date"]
    rets = J.unpivot(weekly_returns(spark, sf), ids, COLS, value="ret")
    prices = J.unpivot(S.price_panel(spark, sf), ids, COLS)
    s = A.summary_stats(rets, 52, "ret", ("series",)).join(A.max_drawdown(prices, "value", ("series",)), "series")
    return tidy(s)


def _corr_sql(ctes: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT panel_id, '{a}' AS row, '{b}' AS col, {'1.0::DOUBLE' if a == b else f'corr({a}, {b})'} AS corr FROM rets GROUP BY 1"
        for a in COLS for b in COLS
    )
    return f"{ctes} SELECT panel_id, row, col, {Q.rnd('corr')} FROM ({cells})"


@query("corr_matrix", _corr_sql(_WEEK))
def corr_matrix(spark, sf):
    return tidy(A.corr_matrix(weekly_returns(spark, sf), COLS))


@query("pca_corr", _corr_sql(_SEG))
def pca_corr(spark, sf):
    """The matrix the components come from, one per segment."""
    return tidy(A.corr_matrix(segment_returns(spark, sf), COLS))


_RC = ", ".join(
    f"CASE WHEN count(*) OVER f = 26 THEN corr(y, {x}) OVER f END AS corr_{x}" for x in X
)


@query(
    "rolling_corr",
    f"{_WEEK}, rc AS (SELECT panel_id, date, {_RC} FROM rets WINDOW f AS (PARTITION BY panel_id ORDER BY date ROWS 25 PRECEDING)) "
    f"SELECT panel_id, date, {Q.rnds([f'corr_{x}' for x in X])} FROM rc",
)
def rolling_corr(spark, sf):
    r = W.rolling_corr(weekly_returns(spark, sf), 26, "y", X, KEY)
    return tidy(r.select("panel_id", "date", *[f"corr_{x}" for x in X]))


_Z52 = Q.zscores("rets", 52, 104, "y")


@query("zscore_52", f"{_WEEK}, {_Z52} SELECT panel_id, date, {Q.rnd('z')} FROM zs")
def zscore_52(spark, sf):
    return tidy(W.zscore(weekly_returns(spark, sf), 52, "y", KEY).select("panel_id", "date", "z"))


@query("zscore_cum_104", f"{_WEEK}, {_Z52} SELECT panel_id, date, {Q.rnd('cum_resid', 'cum')}, {Q.rnd('z_cum')} FROM zs")
def zscore_cum_104(spark, sf):
    return tidy(W.zscore_cum(weekly_returns(spark, sf), 104, "y", KEY).select("panel_id", "date", "cum", "z_cum"))


@query(
    "scatter_long",
    f"{_WEEK} SELECT panel_id, date, round(y, 6) + 0.0 AS y, factor, round(x, 6) + 0.0 AS x FROM ("
    + " UNION ALL ".join(f"SELECT panel_id, date, y, '{x}' AS factor, {x} AS x FROM rets" for x in X) + ")",
)
def scatter_long(spark, sf):
    return tidy(J.target_vs_factors(weekly_returns(spark, sf), "y", X))


_PAIRS = "pairs AS (" + " UNION ALL ".join(f"SELECT panel_id, date, y, '{x}' AS factor, {x} AS x FROM rets" for x in X) + ")"


@query(
    "simple_ols",
    f"{_SEG}, {_PAIRS} SELECT panel_id, factor, {Q.rnd('regr_slope(y, x)', 'slope')}, {Q.rnd('regr_intercept(y, x)', 'intercept')}, "
    f"{Q.rnd('regr_r2(y, x)', 'r2')}, {Q.rnd('corr(y, x)', 'corr')}, count(*) AS n FROM pairs GROUP BY 1, 2",
)
def simple_ols(spark, sf):
    return tidy(A.simple_ols(J.target_vs_factors(segment_returns(spark, sf), "y", X), "y", "x", ["panel_id", "factor"]))


@query(
    "implied_move",
    f"{_SEG}, {_PAIRS}, fit AS (SELECT panel_id, factor, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, min(x) AS x_lo, "
    "max(x) AS x_hi, arg_max(x, date) AS x_last, arg_max(y, date) AS y_last FROM pairs GROUP BY 1, 2), "
    "line AS (SELECT *, intercept + slope * x_lo AS y_lo, intercept + slope * x_hi AS y_hi, intercept + slope * x_last AS implied FROM fit) "
    f"SELECT panel_id, factor, {Q.rnds('slope intercept x_lo x_hi x_last y_last y_lo y_hi implied')}, "
    f"{Q.rnd('y_last - implied', 'gap')} FROM line",
)
def implied_move(spark, sf):
    return tidy(A.implied_move(J.target_vs_factors(segment_returns(spark, sf), "y", X), "y", "x", ["panel_id", "factor"]))


_GRAM_COLS = [f"m_{c}" for c in COLS] + [f"s_{a}_{b}" for a, b in R.pairs(COLS)]


@query(
    "ols_gram",
    f"{_SEG}, gr AS (SELECT panel_id, count(*) AS n, {Q.gram(COLS, 'rets')} FROM rets GROUP BY 1) "
    f"SELECT panel_id, n, {Q.rnds(_GRAM_COLS, 5)} FROM gr",
)
def ols_gram(spark, sf):
    return tidy(R.gram(segment_returns(spark, sf), COLS), 5)


def _coef_sql(ctes: str) -> str:
    terms = " UNION ALL ".join(
        f"SELECT panel_id, '{t}' AS term, b[{i}] AS coef, se[{i}] AS se FROM fit" for i, t in enumerate(["intercept", *X], 1)
    )
    return f"{ctes}, {Q.ols()} SELECT panel_id, term, {Q.rnds('coef se')}, {Q.rnd('coef / se', 't', 5)} FROM ({terms})"


def _coef_table(rets: DataFrame) -> DataFrame:
    return tidy(R.ols(rets, "y", X).drop("p").withColumn("t", F.round("t", 5)))


@query("ols_coef", _coef_sql(_WEEK))
def ols_coef(spark, sf):
    return _coef_table(weekly_returns(spark, sf))


@query("ols_coef_by_segment", _coef_sql(_SEG))
def ols_coef_by_segment(spark, sf):
    return _coef_table(segment_returns(spark, sf))


@query(
    "ols_pvalues",
    f"{_SEG}, {Q.ols()}, tt AS ("
    + " UNION ALL ".join(f"SELECT panel_id, '{t}' AS term, b[{i}] / se[{i}] AS t, n - 6 AS dof FROM fit" for i, t in enumerate(["intercept", *X], 1))
    + f") SELECT panel_id, term, {Q.rnd(Q.t_tail('t', 'dof'), 'p')} FROM tt",
)
def ols_pvalues(spark, sf):
    return tidy(R.ols(segment_returns(spark, sf), "y", X).select("panel_id", "term", "p"))


@query("ols_resid", f"{_SEG}, {Q.ols()}, {Q.resid()} SELECT panel_id, date, {Q.rnds('fitted resid')} FROM res")
def ols_resid(spark, sf):
    r = segment_returns(spark, sf)
    return tidy(R.ols_apply(r, R.ols_fit(r, "y", X), "y", X).select("panel_id", "date", "fitted", "resid"))


@query(
    "ols_diag",
    f"{_SEG}, {Q.ols()}, {Q.resid()}, dw AS (SELECT panel_id, sum((resid - p) * (resid - p)) / sum(resid * resid) AS dw FROM "
    "(SELECT *, lag(resid) OVER (PARTITION BY panel_id ORDER BY date) AS p FROM res) GROUP BY 1) "
    f"SELECT panel_id, n, {Q.rnds('r2 adj_r2')}, {Q.rnd('f', k=4)}, {Q.rnd('dw')} FROM fit JOIN dw USING (panel_id)",
)
def ols_diag(spark, sf):
    d = R.ols_diag(segment_returns(spark, sf), "y", X)
    return tidy(d.drop("f_p").withColumn("f", F.round("f", 4)))


@query("ols_f_pvalue", f"{_SEG}, {Q.ols()}, ff AS (SELECT panel_id, f, CAST(n - 6 AS DOUBLE) AS dof FROM fit) SELECT panel_id, {Q.rnd('log10(' + Q.f_tail('f', '5', 'dof') + ')', 'log10_p', 4)} FROM ff")
def ols_f_pvalue(spark, sf):
    """p(F) of each panel; its logarithm, as the fits are close and the values tiny."""
    return tidy(R.ols_diag(segment_returns(spark, sf), "y", X).select("panel_id", F.round(F.log10("f_p"), 4).alias("log10_p")))


_STD = ", ".join(f"({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w AS {c}" for c in COLS)


@query(
    "standardise",
    f"{_SEG} SELECT panel_id, date, {Q.rnds(COLS)} FROM (SELECT panel_id, date, {_STD} FROM rets WINDOW w AS (PARTITION BY panel_id))",
)
def standardise(spark, sf):
    return tidy(R.standardise(segment_returns(spark, sf), COLS))


def _rolling_ols_sql(ctes: str, n: int) -> str:
    f = f"(PARTITION BY panel_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    k = len(X)
    rows = (
        f"fr AS (SELECT *, count(*) OVER {f} AS cnt, {Q.gram(COLS, 'rets', over=f, n=str(n))} FROM rets), "
        f"full_ AS (SELECT * FROM fr WHERE cnt = {n}), sys AS (SELECT panel_id, date, {Q.augmented(COLS)} AS m FROM full_), "
        f"{Q.eliminate(k, 'panel_id, date')}"
    )
    b = [f"m[{i}][{k + 1}]" for i in range(1, k + 1)]
    icpt = "m_y - (" + " + ".join(f"{c} * m_{x}" for c, x in zip(b, X)) + ")"
    rss = "s_y_y - (" + " + ".join(f"{c} * {Q.s(COLS, x, 'y')}" for c, x in zip(b, X)) + ")"
    pred = f"{icpt} + " + " + ".join(f"{c} * {x}" for c, x in zip(b, X))
    return (
        f"{ctes}, {rows} SELECT fr.panel_id, fr.date, {Q.rnd(icpt, 'intercept', 5)}, "
        + ", ".join(Q.rnd(c, f"beta_{x}", 5) for c, x in zip(b, X))
        + f", {Q.rnd(f'1 - ({rss}) / s_y_y', 'r2', 5)}, {Q.rnd(f'y - ({pred})', 'oos_resid', 5)} "
        "FROM fr LEFT JOIN solved ON fr.panel_id = solved.panel_id AND fr.date = solved.date"
    )


@query("rolling_ols", _rolling_ols_sql(_WEEK, 52))
def rolling_ols(spark, sf):
    return tidy(MV.moving_ols(weekly_returns(spark, sf), 52, "y", X), 5)


@query("rolling_ols_by_segment", _rolling_ols_sql(_SEG, 24))
def rolling_ols_by_segment(spark, sf):
    return tidy(MV.moving_ols(segment_returns(spark, sf), 24, "y", X), 5)


@query("rich_cheap", f"{_WEEK}, {Q.ols()}, {Q.resid()}, {Q.zscores('res', 52, 104)} {Q.signal()}")
def rich_cheap(spark, sf):
    return tidy(G.rich_cheap(weekly_returns(spark, sf), "y", X))


@query("rich_cheap_by_segment", f"{_SEG}, {Q.ols()}, {Q.resid()}, {Q.zscores('res', 12, 24)} {Q.signal()}")
def rich_cheap_by_segment(spark, sf):
    return tidy(G.rich_cheap(segment_returns(spark, sf), "y", X, 12, 24))


@query(
    "rich_cheap_path",
    f"{_WEEK}, {Q.ols()}, {Q.resid()}, {Q.zscores('res', 52, 104)} SELECT panel_id, date, {Q.rnds('resid cum_resid z z_cum')} FROM zs",
)
def rich_cheap_path(spark, sf):
    p = G.signal_path(G.static_residuals(weekly_returns(spark, sf), "y", X))
    return tidy(p.select("panel_id", "date", "resid", "cum_resid", "z", "z_cum"))


def _lasso_sql(ctes: str, l1: float = 1.0) -> str:
    sd = ", ".join(f"stddev_pop({x}) AS sd{i}, avg({x}) AS av{i}" for i, x in enumerate(X, 1))
    raw0 = "my - (" + " + ".join(f"w[{i}] / sd{i} * av{i}" for i in range(1, 6)) + ")"
    quad = " + ".join(f"w[{i}] * w[{j}] * g[{i}][{j}]" for i in range(1, 6) for j in range(1, 6))
    lin = " + ".join(f"w[{i}] * c[{i}]" for i in range(1, 6))
    head = f"{Q.rnd('alpha')}, {Q.rnd(f'1 - (vy - 2 * ({lin}) + {quad}) / vy', 'r2')}"
    rows = [f"SELECT panel_id, 'intercept' AS term, CAST(NULL AS DOUBLE) AS coef_std, {Q.rnd(raw0, 'coef')}, {head}, true AS selected, nn AS n, true AS converged FROM bb"]
    rows += [
        f"SELECT panel_id, '{x}', {Q.rnd(f'w[{i}]', 'coef_std')}, {Q.rnd(f'w[{i}] / sd{i}', 'coef')}, {head}, abs(w[{i}]) > 1e-6, nn, true FROM bb"
        for i, x in enumerate(X, 1)
    ]
    return (
        f"{ctes}, {Q.lasso(5, l1=l1)}, sds AS (SELECT panel_id, var_pop(y) AS vy, count(*) AS nn, {sd} FROM rets GROUP BY 1), "
        f"bb AS (SELECT * FROM best JOIN sds USING (panel_id)) " + " UNION ALL ".join(rows)
    )


@query("lasso_cv", _lasso_sql(_WEEK))
def lasso_cv(spark, sf):
    return tidy(L.lasso_cv(weekly_returns(spark, sf), "y", X))


@query("lasso_cv_by_segment", _lasso_sql(_SEG))
def lasso_cv_by_segment(spark, sf):
    return tidy(L.lasso_cv(segment_returns(spark, sf), "y", X))


@query(
    "lasso_summary",
    f"WITH a AS ({_lasso_sql(_SEG)}) SELECT panel_id, max(alpha) AS alpha, max(r2) AS r2, "
    "coalesce(string_agg(CASE WHEN selected THEN term END, ', ' ORDER BY term), 'None') AS selected, "
    "coalesce(string_agg(CASE WHEN NOT selected THEN term END, ', ' ORDER BY term), 'None') AS dropped FROM a WHERE term <> 'intercept' GROUP BY 1",
)
def lasso_summary(spark, sf):
    return tidy(L.selection_summary(L.lasso_cv(segment_returns(spark, sf), "y", X)))


@query("elastic_net_cv", _lasso_sql(_SEG, 0.5))
def elastic_net_cv(spark, sf):
    return tidy(L.lasso_cv(segment_returns(spark, sf), "y", X, l1_ratio=0.5))


@query("lasso_selected", f"WITH a AS ({_lasso_sql(_SEG)}) SELECT panel_id, term, selected AS kept FROM a WHERE term <> 'intercept'")
def lasso_selected(spark, sf):
    """Both filters of the factors as one flag, so the fit runs once."""
    cv = L.lasso_cv(segment_returns(spark, sf), "y", X).filter("term <> 'intercept'")
    return cv.select("panel_id", "term", is_selected().alias("kept"))


@query(
    "lasso_path",
    f"{_SEG}, {Q.lasso(5)}, cv AS (SELECT panel_id, al, avg(e) AS cv_mse FROM mse GROUP BY 1, 2), "
    "fullp AS (SELECT sol.panel_id, sol.al, alpha, w, cv_mse FROM sol JOIN cv ON sol.panel_id = cv.panel_id AND sol.al = cv.al WHERE left_out = 0) "
    + " UNION ALL ".join(
        f"SELECT panel_id, {Q.rnd('alpha')}, '{x}' AS term, {Q.rnd(f'w[{i}]', 'coef_std')}, {Q.rnd('cv_mse')} FROM fullp" for i, x in enumerate(X, 1)
    ),
)
def lasso_path(spark, sf):
    return tidy(L.lasso_path(segment_returns(spark, sf), "y", X))


@query(
    "lasso_exact_path",
    f"{_SEG}, {Q.lasso(5)}, fullp AS (SELECT panel_id, alpha, w FROM sol WHERE left_out = 0) "
    + " UNION ALL ".join(f"SELECT panel_id, {Q.rnd('alpha')}, '{x}' AS term, {Q.rnd(f'w[{i}]', 'coef_std')} FROM fullp" for i, x in enumerate(X, 1)),
)
def lasso_exact_path(spark, sf):
    """The coefficients at 200 penalties from the knots of the exact path; the twin descends coordinate by coordinate."""
    return tidy(L.at_penalties(L.lasso_knots(segment_returns(spark, sf), "y", X)))


_PCA = (
    f"{_SEG}, cm AS (SELECT panel_id, ["
    + ", ".join("[" + ", ".join("1e0" if a == b else f"corr({a}, {b})" for b in COLS) + "]" for a in COLS)
    + f"] AS a FROM rets GROUP BY 1), {Q.jacobi(len(COLS))}"
)


@query(
    "pca_explained",
    f"{_PCA} SELECT panel_id, pc, {Q.rnds('share')}, {Q.rnd('sum(pcs.share) OVER (PARTITION BY panel_id ORDER BY pc)', 'cum_share')} FROM pcs",
)
def pca_explained(spark, sf):
    return tidy(P.explained(P.pca_fit(segment_returns(spark, sf), COLS)))


@query(
    "pca_loadings",
    f"{_PCA} " + " UNION ALL ".join(f"SELECT panel_id, pc, '{c}' AS series, {Q.rnd(f'sgn * vec[{i}]', 'loading')} FROM pcs" for i, c in enumerate(COLS, 1)),
)
def pca_loadings(spark, sf):
    return tidy(P.loadings(P.pca_fit(segment_returns(spark, sf), COLS), COLS))


_PROJ = " + ".join(f"zd.{c} * (p.sgn * p.vec[{i}])" for i, c in enumerate(COLS, 1))


@query(
    "pca_scores",
    f"{_PCA}, zd AS (SELECT panel_id, date, {_STD} FROM rets WINDOW w AS (PARTITION BY panel_id)) SELECT zd.panel_id, date, "
    + ", ".join(f"round(max(CASE WHEN pc = {i} THEN {_PROJ} END), 6) + 0.0 AS pc{i}" for i in range(1, len(COLS) + 1))
    + " FROM zd JOIN pcs p ON zd.panel_id = p.panel_id GROUP BY 1, 2",
)
def pca_scores(spark, sf):
    r = segment_returns(spark, sf)
    return tidy(P.scores(r, P.pca_fit(r, COLS), COLS))


_OBS = (
    "obs AS (SELECT panel_id, row_number() OVER (PARTITION BY panel_id ORDER BY date) AS t, date, y, "
    f"[{', '.join(X)}] AS x FROM rets)"
)
_KF = f"{_SEG}, {_OBS}, {Q.kalman(len(X), Q_STATE, H_OBS, key='panel_id')}, kd AS (SELECT obs.panel_id, date, y, b, p, innov FROM obs JOIN kf ON obs.panel_id = kf.panel_id AND obs.t = kf.t)"
_KF_TERMS = " UNION ALL ".join(
    f"SELECT panel_id, date, '{x}' AS term, {Q.rnd(f'b[{i}]', 'beta', 4)}, {Q.rnd(f'sqrt(greatest(p[{i}][{i}], 0))', 'se', 4)}, "
    f"{Q.rnd('innov', k=4)} FROM kd"
    for i, x in enumerate(X, 1)
)


def _filtered(spark, sf) -> DataFrame:
    return K.tvp_filter(segment_returns(spark, sf), "y", X, Q_STATE, H_OBS, KEY)


@query("tvp_filter", f"{_KF} {_KF_TERMS}")
def tvp_filter(spark, sf):
    f = _filtered(spark, sf)
    return tidy(K.long_betas(f, X, ["panel_id", "date", "innov"]), 4)


@query(
    "rich_cheap_tvp",
    f"{_KF}, {Q.zscores('kd', 12, 24, 'innov')} {Q.signal('innov', kind='real_time', k=4)}",
)
def rich_cheap_tvp(spark, sf):
    return tidy(G.rich_cheap_tvp(_filtered(spark, sf), 12, 24), 4)


_SM = f"{_SEG}, {_OBS}, {Q.kalman(len(X), Q_STATE, H_OBS, key='panel_id')}, {Q.smoother(len(X), Q_STATE, H_OBS, key='panel_id')}"
_FITTED = " + ".join(f"sb[{i}] * x[{i}]" for i in range(1, len(X) + 1))


@query(
    "tvp_smooth",
    f"{_SM}, d AS ("
    + " UNION ALL ".join(f"SELECT panel_id, date, y, {_FITTED} AS fitted, '{x}' AS term, sb[{i}] AS beta, sqrt(greatest(sv[{i}], 0)) AS se FROM sm" for i, x in enumerate(X, 1))
    + f") SELECT panel_id, date, {Q.rnds('y fitted', 4)}, term, {Q.rnds('beta se', 4)}, {Q.rnd('beta - 1.96 * se', 'lo', 4)}, {Q.rnd('beta + 1.96 * se', 'hi', 4)} FROM d",
)
def tvp_smooth(spark, sf):
    return tidy(K.tvp_smooth(segment_returns(spark, sf), "y", X, Q_STATE, H_OBS, KEY), 4)


@query(
    "tvp_mle",
    f"{_SEG}, {_OBS}, {Q.likelihood_peak(len(X))} SELECT panel_id, n, {Q.rnd('loglik', k=3)}, {Q.rnd('ch', 'log10_obs', 2)}, {Q.rnd('cq', 'log10_state', 2)} FROM peak",
)
def tvp_mle(spark, sf):
    """Variances of the highest likelihood, in powers of ten, found by the score; the twin closes in on it by grids."""
    m = KS.tvp_mle(segment_returns(spark, sf), "y", X, KEY)
    d = m.select("panel_id", "n", "loglik", F.log10("sigma2_obs").alias("log10_obs"), F.log10("sigma2_state").alias("log10_state"))
    return tidy(d.withColumn("loglik", F.round("loglik", 3)).withColumns({c: F.round(c, 2) for c in ("log10_obs", "log10_state")}))


@query(
    "beta_delta",
    f"{_SM}, {Q.ols()}, lt AS (SELECT * FROM sm QUALIFY row_number() OVER (PARTITION BY panel_id ORDER BY date DESC) = 1), "
    f"r2s AS (SELECT panel_id, 1 - sum((y - ({_FITTED})) * (y - ({_FITTED}))) / (var_pop(y) * count(*)) AS tvp_r2 FROM sm GROUP BY 1), d AS ("
    + " UNION ALL ".join(f"SELECT panel_id, '{x}' AS term, lt.sb[{i}] AS tvp_beta, fit.b[{i + 1}] AS ols_beta, tvp_r2, fit.r2 AS ols_r2 FROM lt JOIN fit USING (panel_id) JOIN r2s USING (panel_id)" for i, x in enumerate(X, 1))
    + f") SELECT panel_id, term, {Q.rnds('tvp_beta ols_beta', 4)}, {Q.rnd('tvp_beta - ols_beta', 'delta', 4)}, {Q.rnds('tvp_r2 ols_r2', 4)}, {Q.rnd('(tvp_r2 - ols_r2) * 100', 'gain_pp', 4)} FROM d",
)
def beta_delta(spark, sf):
    r = segment_returns(spark, sf)
    return tidy(G.model_compare(r, K.tvp_smooth(r, "y", X, Q_STATE, H_OBS, KEY), "y", X), 4)


@query(
    "latest_betas",
    f"{_KF}, {Q.ols()}, lt AS (SELECT * FROM kd QUALIFY row_number() OVER (PARTITION BY panel_id ORDER BY date DESC) = 1), d AS ("
    + " UNION ALL ".join(f"SELECT panel_id, '{x}' AS term, lt.b[{i}] AS tvp_beta, fit.b[{i + 1}] AS ols_beta FROM lt JOIN fit USING (panel_id)" for i, x in enumerate(X, 1))
    + f") SELECT panel_id, term, {Q.rnds('tvp_beta ols_beta', 4)}, {Q.rnd('tvp_beta - ols_beta', 'delta', 4)} FROM d",
)
def latest_betas(spark, sf):
    """The latest smoothed beta of each factor, which is the last filtered one, against the static one."""
    r = segment_returns(spark, sf)
    latest = K.tvp_smooth(r, "y", X, Q_STATE, H_OBS, KEY).groupBy("panel_id", "term").agg(F.max_by("beta", "date").alias("coef"))
    d = J.compare_betas(latest, R.ols(r, "y", X).filter("term <> 'intercept'"))
    return tidy(d.withColumnsRenamed({"coef_a": "tvp_beta", "coef_b": "ols_beta"}), 4)
