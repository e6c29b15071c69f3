"""Queries on many long-form series: suppliers by month and segment x priority by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import windows as W
from seriesmill.operators import aggregates as A
from seriesmill.operators import cleaning as C
from seriesmill.operators import joins as J
from seriesmill.operators import tvp as K
from seriesmill.plans import sql as Q
from seriesmill.plans.registry import query, tidy
from seriesmill.sources import tables as S
from seriesmill.sources.dimensions import display_order
from seriesmill.sources.publish import series_map as points_json

_S = f"WITH RECURSIVE {Q.SERIES}"
_SR = f"{_S}, {Q.SERIES_RETS}"
_SEC = f"WITH {Q.SECTORS}"
_W = "WINDOW w AS (PARTITION BY series_id ORDER BY date)"
AS_OF, BASE = "2001-10-15", "1998-01-01"
ORDER = [S.TOTAL, "MACHINERY", "AUTOMOBILE", "AEROSPACE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


def supplier_returns(spark, sf) -> DataFrame:
    """(series_id, date, ret, xret): log returns of price and quantity; x may be null only where value is."""
    r = W.log_return(S.supplier_series(spark, sf), ["value", "x"])
    return r.filter("value is not null").withColumnsRenamed({"value": "ret", "x": "xret"})


@query("supplier_series", f"{_S} SELECT * FROM series")
def supplier_series(spark, sf):
    return S.supplier_series(spark, sf)


@query("sector_series", f"{_SEC} SELECT * FROM sectors")
def sector_series(spark, sf):
    return S.sector_series(spark, sf)


@query("log_returns", f"{_SR} SELECT series_id, date, {Q.rnds('ret xret')} FROM srets")
def log_returns(spark, sf):
    return tidy(supplier_returns(spark, sf))


@query(
    "pct_change",
    f"{_S} SELECT series_id, date, {Q.rnd('(value - p) * 100 / p', 'pct')}, "
    "(year(date) - year(pd)) * 12 + month(date) - month(pd) AS gap_months FROM "
    f"(SELECT *, lag(value) OVER w AS p, lag(date) OVER w AS pd FROM series {_W})",
)
def pct_change(spark, sf):
    return tidy(W.pct_change(S.supplier_series(spark, sf)).drop("value", "x"))


@query(
    "drawdown",
    f"{_S} SELECT series_id, date, running_max, {Q.rnd('value / running_max - 1', 'drawdown')} FROM "
    f"(SELECT *, max(value) OVER w AS running_max FROM series {_W})",
)
def drawdown(spark, sf):
    return tidy(W.drawdown(S.supplier_series(spark, sf)).drop("value", "x"), exact=["running_max"])


@query(
    "max_drawdown",
    f"{_S} SELECT series_id, {Q.rnd('min(value / m - 1) * 100', 'max_drawdown')} FROM "
    f"(SELECT *, max(value) OVER w AS m FROM series {_W}) GROUP BY 1",
)
def max_drawdown(spark, sf):
    return tidy(A.max_drawdown(S.supplier_series(spark, sf)))


@query(
    "rebase",
    f"{_S} SELECT series_id, date, {Q.rnd('value / first_value(value) OVER w * 100', 'rebased')} FROM series {_W}",
)
def rebase(spark, sf):
    return tidy(W.rebase(S.supplier_series(spark, sf)).drop("value", "x"))


@query("cum_sum", f"{_SR} SELECT series_id, date, {Q.rnd('sum(ret) OVER w', 'cum')} FROM srets {_W}")
def cum_sum(spark, sf):
    return tidy(W.cum_sum(supplier_returns(spark, sf), "ret").drop("ret", "xret"))


_F12 = "WINDOW f AS (PARTITION BY series_id ORDER BY date ROWS 11 PRECEDING)"


@query(
    "rolling_mean_std",
    f"{_SR}, r AS (SELECT series_id, date, CASE WHEN count(ret) OVER f = 12 THEN avg(ret) OVER f END AS roll_mean, "
    f"CASE WHEN count(ret) OVER f = 12 THEN stddev_samp(ret) OVER f END AS roll_std FROM srets {_F12}) "
    f"SELECT series_id, date, {Q.rnds('roll_mean roll_std')} FROM r",
)
def rolling_mean_std(spark, sf):
    return tidy(W.rolling(supplier_returns(spark, sf), 12, "ret").drop("ret", "xret"))


@query(
    "zscore_by_series",
    f"{_SR}, {Q.zscores('srets', 12, 24, 'ret', 'series_id')} SELECT series_id, date, {Q.rnd('cum_resid', 'cum')}, {Q.rnds('z z_cum')} FROM zs",
)
def zscore_by_series(spark, sf):
    r = W.zscore(supplier_returns(spark, sf), 12, "ret")
    return tidy(W.zscore_cum(r, 24, "ret").drop("ret", "xret"))


@query(
    "rolling_corr_by_series",
    f"{_SR}, r AS (SELECT series_id, date, CASE WHEN count(*) OVER f = 26 THEN corr(ret, xret) OVER f END AS corr_xret FROM srets "
    "WINDOW f AS (PARTITION BY series_id ORDER BY date ROWS 25 PRECEDING)) "
    f"SELECT series_id, date, {Q.rnds('corr_xret')} FROM r",
)
def rolling_corr_by_series(spark, sf):
    return tidy(W.rolling_corr(supplier_returns(spark, sf), 26, "ret", ["xret"]).drop("ret", "xret"))


@query(
    "rolling_beta_1f",
    f"{_SR}, r AS (SELECT series_id, date, count(*) OVER f AS c, regr_slope(ret, xret) OVER f AS beta, "
    "regr_intercept(ret, xret) OVER f AS alpha, regr_r2(ret, xret) OVER f AS r2 FROM srets "
    "WINDOW f AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) "
    "SELECT series_id, date, " + ", ".join(Q.rnd(f"CASE WHEN c = 24 THEN {c} END", c) for c in ("beta", "alpha", "r2")) + " FROM r",
)
def rolling_beta_1f(spark, sf):
    return tidy(W.rolling_beta(supplier_returns(spark, sf), 24, "ret", "xret").drop("ret", "xret"))


@query("suffix_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE suffix(o_orderpriority, 'HIGH')")
def suffix_filter(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return C.filter_metric(o, "HIGH", "o_orderpriority")


@query(
    "min_points",
    f"{_S} SELECT series_id, date, points FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS points FROM series) WHERE points >= 83",
)
def min_points(spark, sf):
    return C.min_points(S.supplier_series(spark, sf), 83).select("series_id", "date", "points")


@query("value_at", f"{_S} SELECT series_id, max(CASE WHEN date = DATE '{BASE}' THEN value END) AS base_value FROM series GROUP BY 1")
def value_at(spark, sf):
    return C.value_at(S.supplier_series(spark, sf), BASE)


@query("range_filter", f"{_S} SELECT series_id, date, value FROM series WHERE date >= DATE '{AS_OF}' - INTERVAL 3 YEAR")
def range_filter(spark, sf):
    return C.filter_range(S.supplier_series(spark, sf), "3y", AS_OF).select("series_id", "date", "value")


@query(
    "select_view",
    f"{_SEC} SELECT 'all entities' AS view, entity, metric, date, value FROM sectors WHERE metric = '2-HIGH' AND entity <> '{S.TOTAL}' "
    "UNION ALL SELECT 'one entity', entity, metric, date, value FROM sectors WHERE entity = 'BUILDING' AND metric IN ('1-URGENT', '2-HIGH', '5-LOW')",
)
def select_view(spark, sf):
    s = S.sector_series(spark, sf)
    cols = ("entity", "metric", "date", "value")
    every = C.select_view(s, None, ["2-HIGH"], S.TOTAL).select(F.lit("all entities").alias("view"), *cols)
    one = C.select_view(s, "BUILDING", ["1-URGENT", "2-HIGH", "5-LOW"], S.TOTAL)
    return every.unionByName(one.select(F.lit("one entity").alias("view"), *cols))


_LP = (
    "rk AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS rn FROM {src}), "
    "lp AS (SELECT series_id, max(CASE WHEN rn = 1 THEN value END) AS current, max(CASE WHEN rn = 1 THEN date END) AS date, "
    "max(CASE WHEN rn = 2 THEN value END) AS previous, max(CASE WHEN rn = 2 THEN date END) AS prev_date FROM rk WHERE rn <= 2 "
    "GROUP BY 1 HAVING count(*) = 2)"
)


@query("latest_prev", f"{_S}, {_LP.format(src='series')} SELECT * FROM lp")
def latest_prev(spark, sf):
    return A.latest_prev(S.supplier_series(spark, sf))


_PK = (
    "pk AS (SELECT series_id, peak, min(date) AS peak_date FROM (SELECT *, max(value) OVER (PARTITION BY series_id) AS peak FROM series) "
    "WHERE value = peak GROUP BY 1, 2)"
)


@query("peak", f"{_S}, {_PK} SELECT * FROM pk")
def peak(spark, sf):
    return A.peak(S.supplier_series(spark, sf))


_BASE = f"bv AS (SELECT series_id, max(CASE WHEN date = DATE '{BASE}' THEN value END) AS base_value FROM series GROUP BY 1)"
_SNAP = f"{_S}, {_LP.format(src='series')}, {_PK}, {_BASE}, snap AS (SELECT * FROM lp JOIN pk USING (series_id) JOIN bv USING (series_id))"


@query("snapshot", f"{_SNAP} SELECT * FROM snap")
def snapshot(spark, sf):
    return A.snapshot(S.supplier_series(spark, sf), BASE)


@query(
    "deltas",
    f"{_SNAP} SELECT series_id, {Q.rnd('current - previous', 'mom')}, {Q.rnd('(current - previous) / previous * 100', 'mom_pct')}, "
    f"{Q.rnd('(current - peak) / peak * 100', 'vs_peak_pct')} FROM snap",
)
def deltas(spark, sf):
    d = A.deltas(A.snapshot(S.supplier_series(spark, sf), BASE))
    return tidy(d.select("series_id", "mom", "mom_pct", "vs_peak_pct"))


_TR = _PK.replace("pk AS", "tr AS").replace("peak", "trough").replace("max(value)", "min(value)")
_LAST = "la AS (SELECT series_id, arg_max(value, date) AS latest FROM series GROUP BY 1)"


@query(
    "peak_trough",
    f"{_S}, {_PK}, {_TR}, {_LAST}, {_BASE} SELECT series_id, peak, peak_date, trough, trough_date, latest, base_value AS base, "
    f"{Q.rnd('(latest / peak - 1) * 100', 'from_peak_pct')}, {Q.rnd('(latest / trough - 1) * 100', 'from_trough_pct')}, "
    f"{Q.rnd('(latest / base_value - 1) * 100', 'from_base_pct')} FROM pk JOIN tr USING (series_id) JOIN la USING (series_id) JOIN bv USING (series_id)",
)
def peak_trough(spark, sf):
    d = A.peak_trough(S.supplier_series(spark, sf), BASE)
    return tidy(d, exact=["peak", "trough", "latest", "base"])


@query(
    "period_stats",
    f"{_S} SELECT series_id, arg_max(value, date) AS last, max(value) AS high, min(value) AS low, "
    f"max(CASE WHEN date > DATE '{AS_OF}' - 364 THEN value END) AS high_52w, min(CASE WHEN date > DATE '{AS_OF}' - 364 THEN value END) AS low_52w "
    f"FROM series WHERE date <= DATE '{AS_OF}' GROUP BY 1",
)
def period_stats(spark, sf):
    return A.period_stats(S.supplier_series(spark, sf), AS_OF)


def _lb(m: int) -> str:
    then = f"date <= DATE '{AS_OF}' - INTERVAL {m} MONTH"
    return f"arg_max(CASE WHEN {then} THEN value END, CASE WHEN {then} THEN date END) AS b{m}"


@query(
    "lookback_change",
    f"{_S}, g AS (SELECT series_id, arg_max(value, date) AS last, {_lb(1)}, {_lb(3)} FROM series WHERE date <= DATE '{AS_OF}' GROUP BY 1) "
    f"SELECT series_id, last, {Q.rnd('(last - b1) / b1 * 100', 'chg_1m')}, {Q.rnd('(last - b3) / b3 * 100', 'chg_3m')} FROM g",
)
def lookback_change(spark, sf):
    return tidy(A.lookback_change(S.supplier_series(spark, sf), AS_OF), exact=["last"])


@query(
    "beveridge",
    f"{_SEC}, j AS (SELECT a.date, a.value AS x, b.value AS y FROM sectors a JOIN sectors b USING (date) "
    f"WHERE a.series_id = '{S.TOTAL}|1-URGENT' AND b.series_id = '{S.TOTAL}|3-MEDIUM' AND b.value <> 0) "
    "SELECT date, x, y, CASE WHEN row_number() OVER (ORDER BY date DESC) <= 12 THEN 'recent' ELSE 'historical' END AS tag FROM j",
)
def beveridge(spark, sf):
    s = S.sector_series(spark, sf)
    pts = J.align_metrics(s, F.col("series_id") == f"{S.TOTAL}|1-URGENT", F.col("series_id") == f"{S.TOTAL}|3-MEDIUM", ["date"])
    return W.tag_recent(pts.withColumn("entity", F.lit(S.TOTAL)), 12, ("entity",)).drop("entity")


@query(
    "tag_recent",
    f"{_S} SELECT series_id, date, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 12 THEN 'recent' ELSE 'historical' END AS tag FROM series",
)
def tag_recent(spark, sf):
    return W.tag_recent(S.supplier_series(spark, sf)).select("series_id", "date", "tag")


@query(
    "spread_series",
    f"{_SEC} SELECT a.entity, a.date, a.value AS x, b.value AS y, {Q.rnd('a.value - b.value', 'spread')} FROM sectors a JOIN sectors b "
    "ON a.entity = b.entity AND a.date = b.date WHERE a.metric = '1-URGENT' AND b.metric = '5-LOW' AND b.value <> 0",
)
def spread_series(spark, sf):
    s = S.sector_series(spark, sf)
    pts = J.align_metrics(s, F.col("metric") == "1-URGENT", F.col("metric") == "5-LOW", ["entity", "date"])
    return tidy(J.spread(pts), exact=["x", "y"])


@query(
    "latest_spread",
    f"{_SEC}, g AS (SELECT entity, arg_max(CASE WHEN metric = '1-URGENT' THEN value END, CASE WHEN metric = '1-URGENT' THEN date END) AS a, "
    "max(CASE WHEN metric = '1-URGENT' THEN date END) AS a_date, "
    "arg_max(CASE WHEN metric = '5-LOW' THEN value END, CASE WHEN metric = '5-LOW' THEN date END) AS b, "
    "max(CASE WHEN metric = '5-LOW' THEN date END) AS b_date FROM sectors WHERE metric IN ('1-URGENT', '5-LOW') GROUP BY 1) "
    f"SELECT *, {Q.rnd('a - b', 'spread')}, {Q.rnd('a / b', 'ratio')} FROM g",
)
def latest_spread(spark, sf):
    s = S.sector_series(spark, sf)
    return tidy(J.latest_pair(s, F.col("metric") == "1-URGENT", F.col("metric") == "5-LOW", ["entity"]), exact=["a", "b"])


@query(
    "label_codes",
    "SELECT c_custkey, c_nationkey AS code, coalesce(r_name, 'Unknown (' || c_nationkey || ')') AS label FROM customer LEFT JOIN region ON c_nationkey = r_regionkey",
)
def label_codes(spark, sf):
    """Customers by code over a dimension that knows only some of the codes."""
    codes = S.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("code"))
    dim = S.table(spark, sf, "region").select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("label"))
    return tidy(J.label_codes(codes, dim)).withColumn("code", F.col("code").cast("int"))


_ORD = "ord AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(ORDER, 1)) + ") t(ord, entity))"


@query(
    "ordered_lookup",
    f"{_SEC}, {_ORD}, u AS (SELECT series_id, entity, date, value FROM sectors WHERE metric = '1-URGENT'), {_LP.format(src='u')} "
    "SELECT CAST(ord AS BIGINT) AS ord, entity, current, previous FROM lp JOIN ord ON series_id = entity || '|1-URGENT'",
)
def ordered_lookup(spark, sf):
    """Latest values in a display list that names one entity (AEROSPACE) the data do not have."""
    latest = A.latest_prev(S.sector_series(spark, sf).filter("metric = '1-URGENT'"), keys=("entity",))
    return tidy(J.ordered_lookup(latest, display_order(spark, ORDER)).select("ord", "entity", "current", "previous"), exact=["current", "previous"])


@query(
    "small_multiples",
    f"{_SEC}, u AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date DESC) AS rn FROM sectors "
    f"WHERE metric = '2-HIGH' AND entity <> '{S.TOTAL}' AND date >= DATE '2001-08-15' - INTERVAL 1 YEAR), "
    "g AS (SELECT entity, max(CASE WHEN rn = 1 THEN value END) AS latest, coalesce(max(CASE WHEN rn = 2 THEN value END), "
    "max(CASE WHEN rn = 1 THEN value END)) AS prev FROM u GROUP BY 1) "
    f"SELECT entity, latest, prev, {Q.rnd('latest - prev', 'change')}, {Q.rnd('(latest - prev) / prev * 100', 'change_pct')} FROM g",
)
def small_multiples(spark, sf):
    s = C.filter_range(C.select_view(S.sector_series(spark, sf), None, ["2-HIGH"], S.TOTAL), "1y", "2001-08-15")
    return tidy(A.small_multiples(s), exact=["latest", "prev"])


_FX = (
    "fx AS (SELECT c_mktsegment AS entity, CAST(date_trunc('week', o_orderdate) AS DATE) AS date, "
    "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS rate FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"
)


@query(
    "convert_units",
    f"{_SEC}, {_FX} SELECT s.entity, s.metric, s.date, s.value, fx.rate, {Q.rnd('s.value * fx.rate / 3.412', 'converted', 2)} "
    f"FROM (SELECT * FROM sectors WHERE entity <> '{S.TOTAL}') s ASOF LEFT JOIN fx ON s.entity = fx.entity AND s.date >= fx.date",
)
def convert_units(spark, sf):
    """Monthly values converted with the weekly rate in force; 3.412 is the fixed unit divisor.

    Each sum counts for its month and priority and for its week, so one pass over the orders gives both.
    """
    both = F.array(F.struct("metric", F.col("month").alias("date")), F.struct(F.lit(None).cast("string").alias("metric"), F.col("week").alias("date")))
    rows = S.segment_calendar(spark, sf).select("entity", "cents", "n", F.inline(both)).groupBy("entity", "metric", "date").agg(S.mean_of(F.sum("cents"), F.sum("n")).alias("m"))
    is_rate = F.col("metric").isNull()
    stacked = rows.select("entity", "metric", "date", F.when(~is_rate, F.col("m")).alias("value"), F.when(is_rate, F.col("m")).alias("rate"))
    return tidy(J.convert_stacked(stacked, 3.412, "entity"), 2, exact=["value", "rate"])


@query(
    "group_sum",
    "SELECT n_nationkey, n_name, coalesce(CAST(sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS BIGINT), 0) AS points FROM nation "
    "LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2",
)
def group_sum(spark, sf):
    sup = S.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), S.cents(F.col("s_acctbal")).alias("c"))
    nations = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return A.group_sum(sup, nations, "n_nationkey", "c", "points")


_BAL = (
    "bal AS (SELECT r_name AS region, n_name AS nation, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS points FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)"
)


def _balances(spark, sf) -> DataFrame:
    """(region, nation, points): customer balances summed per nation before any join."""
    sums = S.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum(S.cents(F.col("c_acctbal"))).alias("points"))
    n = S.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    r = S.table(spark, sf, "region")
    return sums.join(n, "n_nationkey").join(r, "r_regionkey").select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), "points")


@query("standings", f"WITH {_BAL} SELECT *, row_number() OVER (PARTITION BY region ORDER BY points DESC, nation) AS pos FROM bal")
def standings(spark, sf):
    return W.standings(_balances(spark, sf), "points", "nation", ["region"])


@query("share_of_max", f"WITH {_BAL} SELECT *, {Q.rnd('points * 100 / max(points) OVER (PARTITION BY region)', 'share', 0)} FROM bal")
def share_of_max(spark, sf):
    return tidy(W.share_of_max(_balances(spark, sf), "points", ["region"]), 0)


@query("clamp_share", "SELECT c_custkey, round(c_acctbal, 2) AS value, " + Q.rnd("least(abs(c_acctbal) / 8000 * 100, 100)", "share") + " FROM customer")
def clamp_share(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", F.round("c_acctbal", 2).alias("value"))
    return tidy(W.clamp_share(c, 8000.0), exact=["value"])


_L8 = "l8 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS rn FROM series) WHERE rn <= 8)"


@query(
    "minmax",
    f"{_S}, {_L8} SELECT series_id, date, {Q.rnd('(value - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END', 'scaled')} FROM "
    "(SELECT *, min(value) OVER (PARTITION BY series_id) AS lo, max(value) OVER (PARTITION BY series_id) AS hi FROM l8)",
)
def minmax(spark, sf):
    return tidy(W.minmax(W.last_n(S.supplier_series(spark, sf), 8)).select("series_id", "date", "scaled"))


@query("sparkline", f"{_S}, {_L8} SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos, value FROM l8")
def sparkline(spark, sf):
    """The trend arrays, one row per point."""
    t = A.sparkline(S.supplier_series(spark, sf), 8)
    return tidy(t.select("series_id", F.posexplode("trend").alias("pos", "value")), exact=["value"])


@query(
    "first_last",
    f"{_S} SELECT series_id, min(date) AS first_date, arg_min(value, date) AS first_value, max(date) AS last_date, arg_max(value, date) AS last_value FROM series GROUP BY 1",
)
def first_last(spark, sf):
    return A.first_last(S.supplier_series(spark, sf))


@query("domain", f"{_S} SELECT series_id, min(value) AS lo, max(value) AS hi FROM series GROUP BY 1")
def domain(spark, sf):
    return A.domain(S.supplier_series(spark, sf))


@query("counts", f"{_S} SELECT count(DISTINCT series_id) AS n_series, count(value) AS n_obs FROM series")
def counts(spark, sf):
    return A.counts(S.supplier_series(spark, sf))


@query(
    "rank_components",
    f"{_SEC} SELECT date, metric, entity, value, row_number() OVER (PARTITION BY date, metric ORDER BY value DESC, entity) AS pos FROM sectors WHERE entity <> '{S.TOTAL}'",
)
def rank_components(spark, sf):
    s = C.exclude(S.sector_series(spark, sf), S.TOTAL).select("date", "metric", "entity", "value")
    return A.rank_components(s, "value", "entity", ["date", "metric"])


_MOVES = (
    f"mv AS (SELECT series_id, arg_max(pct, date) AS pct FROM (SELECT *, (value - lag(value) OVER w) * 100 / lag(value) OVER w AS pct FROM series {_W}) GROUP BY 1)"
)


def _moves(spark, sf) -> DataFrame:
    c = W.pct_change(S.supplier_series(spark, sf))
    return c.groupBy("series_id").agg(F.max_by("pct", "date").alias("pct"))


@query("top_movers", f"{_S}, {_MOVES} SELECT series_id, {Q.rnd('pct')} FROM mv ORDER BY abs(mv.pct) DESC, series_id LIMIT 10")
def top_movers(spark, sf):
    return tidy(A.top_movers(_moves(spark, sf), 10))


@query(
    "top_movers_by",
    f"{_S}, {_MOVES}, r AS (SELECT mv.series_id, pct, s_nationkey AS nation, row_number() OVER (PARTITION BY s_nationkey ORDER BY abs(pct) DESC, mv.series_id) AS rank "
    f"FROM mv JOIN supplier ON s_suppkey = series_id WHERE pct IS NOT NULL) SELECT series_id, {Q.rnd('pct')}, nation, rank FROM r WHERE rank <= 3",
)
def top_movers_by(spark, sf):
    sup = S.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("series_id"), F.col("s_nationkey").alias("nation"))
    m = _moves(spark, sf).join(sup, "series_id")
    return tidy(A.top_movers_by(m, 3, "nation")).withColumn("nation", F.col("nation").cast("int"))


_LOADS = ["A", "R", "N"]


@query(
    "union_latest",
    "WITH l AS (" + " UNION ALL ".join(
        f"SELECT l_suppkey AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS value, "
        f"CAST({i} AS BIGINT) AS load FROM lineitem WHERE l_returnflag = '{f}' GROUP BY 1, 2" for i, f in enumerate(_LOADS)
    ) + ") SELECT series_id, date, arg_max(value, load) AS value, max(load) AS load FROM l GROUP BY 1, 2",
)
def union_latest(spark, sf):
    """Three loads of the same keys, the last one that has a key wins. One scan: the load number comes from the flag."""
    li = S.table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin(_LOADS))
    load = F.array_position(F.array(*[F.lit(f) for f in _LOADS]), F.col("l_returnflag")) - 1
    keys = [F.col("l_suppkey").alias("series_id"), S.period(F.col("l_shipdate"), "month").alias("date")]
    g = li.groupBy(*keys, load.alias("load")).agg(F.sum(S.cents(F.col("l_extendedprice"))).alias("s"), F.count(F.lit(1)).alias("n"))
    return J.latest_load(g.select("series_id", "date", "load", S.mean_of(F.col("s"), F.col("n")).alias("value")), ["series_id", "date"], ["value"])


@query(
    "recent_trend",
    f"{_SR}, g AS (SELECT series_id, avg(ret) AS recent_mean FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS rn FROM srets) WHERE rn <= 4 GROUP BY 1) "
    f"SELECT series_id, {Q.rnds('recent_mean')}, CASE WHEN g.recent_mean > 0 THEN 'Richening' ELSE 'Cheapening' END AS trend FROM g",
)
def recent_trend(spark, sf):
    return tidy(A.recent_trend(supplier_returns(spark, sf), 4, "ret"))


@query(
    "durbin_watson",
    f"{_SR}, d AS (SELECT *, ret - lag(ret) OVER w AS de FROM srets {_W}) SELECT series_id, {Q.rnd('sum(de * de) / sum(ret * ret)', 'dw')} FROM d GROUP BY 1",
)
def durbin_watson(spark, sf):
    return tidy(A.durbin_watson(supplier_returns(spark, sf), "ret"))


@query(
    "summary_stats_by_series",
    f"{_SR} SELECT series_id, {Q.rnd('avg(ret) * 12', 'ann_return')}, {Q.rnd('stddev_samp(ret) * sqrt(12)', 'ann_vol')}, "
    f"{Q.rnd('avg(ret) / stddev_samp(ret) * sqrt(12)', 'sharpe')}, {Q.rnd('skewness(ret)', 'skew')}, {Q.rnd('kurtosis(ret)', 'kurt')}, "
    f"{Q.rnd('max(ret)', 'best')}, {Q.rnd('min(ret)', 'worst')}, count(ret) AS n FROM srets GROUP BY 1",
)
def summary_stats_by_series(spark, sf):
    return tidy(A.summary_stats(supplier_returns(spark, sf), 12))


@query(
    "series_map",
    f"{_SEC} SELECT series_id, '[' || string_agg('{{\"date\":\"' || date || '\",\"value\":' || CAST(CAST(round(value) AS BIGINT) AS VARCHAR) || '}}', ',' ORDER BY date) || ']' AS json FROM sectors GROUP BY 1",
)
def series_map(spark, sf):
    s = S.sector_series(spark, sf)
    return points_json(s.withColumn("value", F.round("value").cast("bigint")))


_F3 = "WINDOW f AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"


@query(
    "surprise",
    f"{_S}, e AS (SELECT series_id, date, value AS actual, min(value) OVER f AS exp_lo, max(value) OVER f AS exp_hi FROM series {_F3}) "
    f"SELECT series_id, date, {Q.rnd('CASE WHEN actual > exp_hi THEN actual - exp_hi WHEN actual < exp_lo THEN actual - exp_lo WHEN exp_lo IS NOT NULL THEN 0 END', 'gap')}, "
    "CASE WHEN actual > exp_hi THEN 'beat' WHEN actual < exp_lo THEN 'below' WHEN exp_lo IS NOT NULL THEN 'in line' END AS outcome FROM e",
)
def surprise(spark, sf):
    """Each value against the range of the three before it."""
    w = W.by().rowsBetween(-3, -1)
    e = S.supplier_series(spark, sf).withColumns({"exp_lo": F.min("value").over(w), "exp_hi": F.max("value").over(w)})
    return tidy(A.surprise(e, "value").select("series_id", "date", "gap", "outcome"))


@query(
    "annualise",
    f"{_SEC}, p AS (SELECT series_id, date, (value - lag(value) OVER w) * 100 / lag(value) OVER w AS pct FROM sectors WHERE entity = '{S.TOTAL}' {_W}) "
    f"SELECT series_id, date, {Q.rnd('pct * 12', 'annual_simple')}, {Q.rnd('(pow(1 + pct / 100, 12) - 1) * 100', 'annual_compound', 3)} FROM p",
)
def annualise(spark, sf):
    total = S.sector_series(spark, sf).filter(F.col("entity") == S.TOTAL)
    p = A.annualise(W.pct_change(total))
    return tidy(p.select("series_id", "date", "annual_simple", F.round("annual_compound", 3).alias("annual_compound")))


@query(
    "contribution",
    f"{_SEC}, d AS (SELECT date, metric, entity, n AS weight, value - lag(value) OVER w AS change FROM sectors WHERE entity <> '{S.TOTAL}' {_W}) "
    f"SELECT date, metric, entity, {Q.rnd('weight * change / nullif(sum(weight * change) OVER (PARTITION BY date, metric), 0)', 'share', 4)} FROM d WHERE change IS NOT NULL",
)
def contribution(spark, sf):
    s = C.exclude(S.sector_series(spark, sf), S.TOTAL)
    d = s.withColumn("change", F.col("value") - W.lagged("value")).withColumn("weight", F.col("n")).filter("change is not null")
    c = A.contribution(d, ["date", "metric"])
    return tidy(c.select("date", "metric", "entity", "share"), 4)


@query(
    "largest_since",
    f"{_S}, {_LP.format(src='series')} SELECT lp.series_id, lp.date, current, max(s.date) AS largest_since FROM "
    "(SELECT series_id, max(date) AS date, arg_max(value, date) AS current FROM series GROUP BY 1) lp LEFT JOIN series s "
    "ON s.series_id = lp.series_id AND s.date < lp.date AND s.value >= current GROUP BY 1, 2, 3",
)
def largest_since(spark, sf):
    return A.largest_since(S.supplier_series(spark, sf))


_TVP1 = (
    "obs AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY date) AS t, date, ret AS y, [xret] AS x FROM srets), "
    f"{Q.kalman(1, 0.0005, 400.0)}"
)


@query(
    "tvp_1f",
    f"{_SR}, {_TVP1} SELECT kf.series_id, date, {Q.rnd('b[1]', 'beta', 5)}, {Q.rnd('innov', k=4)} FROM kf JOIN obs ON obs.series_id = kf.series_id AND obs.t = kf.t",
)
def tvp_1f(spark, sf):
    f = K.tvp_filter(supplier_returns(spark, sf), "ret", ["xret"], 0.0005, 400.0)
    return tidy(f.select("series_id", "date", F.round(F.col("beta")[0], 5).alias("beta"), F.round("innov", 4).alias("innov")))


@query(
    "lag_state",
    f"{_SR}, {_TVP1} SELECT kf.series_id, date, {Q.rnd('coalesce(lag(b[1]) OVER (PARTITION BY kf.series_id ORDER BY date), 0)', 'prev_beta', 5)} "
    "FROM kf JOIN obs ON obs.series_id = kf.series_id AND obs.t = kf.t",
)
def lag_state(spark, sf):
    f = K.tvp_filter(supplier_returns(spark, sf), "ret", ["xret"], 0.0005, 400.0).withColumn("beta", F.col("beta")[0])
    return tidy(W.lag_state(f, ["beta"]).select("series_id", "date", "prev_beta"), 5)


_Q1, _H1 = "0.0005::DOUBLE", "400::DOUBLE"


_SMOOTH1 = (
    f"{_SR}, o AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY date) AS t, date, ret AS y, xret AS x FROM srets), "
    "n AS (SELECT series_id, max(t) AS n FROM o GROUP BY 1), "
    f"fw AS (SELECT series_id, t, 1e-6 + x * x / {_H1} AS w, x * y / {_H1} AS v FROM o WHERE t = 1 UNION ALL "
    f"SELECT o.series_id, o.t, fw.w / (1 + {_Q1} * fw.w) + o.x * o.x / {_H1}, fw.v / (1 + {_Q1} * fw.w) + o.x * o.y / {_H1} FROM fw JOIN o ON o.series_id = fw.series_id AND o.t = fw.t + 1), "
    "bw AS (SELECT series_id, n AS t, 0e0 AS w, 0e0 AS v FROM n UNION ALL "
    f"SELECT o.series_id, o.t - 1, (bw.w + o.x * o.x / {_H1}) / (1 + {_Q1} * (bw.w + o.x * o.x / {_H1})), (bw.v + o.x * o.y / {_H1}) / (1 + {_Q1} * (bw.w + o.x * o.x / {_H1})) "
    "FROM bw JOIN o ON o.series_id = bw.series_id AND o.t = bw.t WHERE o.t > 1), "
    "sm AS (SELECT o.series_id, o.date, o.y, o.x, (fw.v + bw.v) / (fw.w + bw.w) AS beta, sqrt(1 / (fw.w + bw.w)) AS se "
    "FROM o JOIN fw ON fw.series_id = o.series_id AND fw.t = o.t JOIN bw ON bw.series_id = o.series_id AND bw.t = o.t)"
)


@query("tvp_smooth_1f", f"{_SMOOTH1} SELECT series_id, date, {Q.rnds('beta se')}, {Q.rnd('beta - 1.96 * se', 'lo')}, {Q.rnd('beta + 1.96 * se', 'hi')} FROM sm")
def tvp_smooth_1f(spark, sf):
    s = K.tvp_smooth(supplier_returns(spark, sf), "ret", ["xret"], 0.0005, 400.0)
    return tidy(s.select("series_id", "date", "beta", "se", "lo", "hi"))


@query(
    "r2_gain_1f",
    f"{_SMOOTH1}, r AS (SELECT series_id, count(*) AS n, 1 - sum((y - beta * x) * (y - beta * x)) / (var_pop(y) * count(*)) AS tvp_r2, regr_r2(y, x) AS ols_r2 FROM sm GROUP BY 1) "
    f"SELECT series_id, {Q.rnds('tvp_r2 ols_r2', 5)}, {Q.rnd('(tvp_r2 - ols_r2) * 100', 'gain_pp', 3)} FROM r",
)
def r2_gain_1f(spark, sf):
    """R2 of the smoothed one-factor model against the static one, in percentage points."""
    r = supplier_returns(spark, sf)
    s = K.tvp_smooth(r, "ret", ["xret"], 0.0005, 400.0).withColumn("_e", F.col("y") - F.col("fitted"))
    tvp = A.r_squared(s, "y", "_e", ["series_id"]).withColumnRenamed("r2", "tvp_r2")
    j = tvp.join(A.simple_ols(r, "ret", "xret", ["series_id"]).select("series_id", F.col("r2").alias("ols_r2")), "series_id")
    return tidy(j.select("series_id", F.round("tvp_r2", 5).alias("tvp_r2"), F.round("ols_r2", 5).alias("ols_r2"), F.round((F.col("tvp_r2") - F.col("ols_r2")) * 100, 3).alias("gain_pp")))
