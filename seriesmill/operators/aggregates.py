"""Summary statistics, snapshots and look-back reports: mergeable aggregates per series."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions import windows as W

KEYS = ("series_id",)


def sample_skewness(c: str) -> Column:
    """Bias-corrected skewness from the population moment Spark computes; null below 3 values."""
    n = F.count(c)
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / F.try_subtract(n, F.lit(2)))


def sample_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis; null below 4 values."""
    n = F.count(c).cast("double")
    return F.when(n >= 4, F.try_divide((n - 1) * ((n + 1) * F.kurtosis(c) + 6), (n - 2) * (n - 3)))


def summary_stats(returns: DataFrame, k: int = 52, value: str = "ret", keys: Sequence[str] = KEYS) -> DataFrame:
    """Annualised return, volatility and Sharpe, shape, best and worst period, one aggregate."""
    mean, std = F.avg(value), F.stddev_samp(value)
    return returns.groupBy(*keys).agg(
        (mean * k).alias("ann_return"),
        (std * (k**0.5)).alias("ann_vol"),
        (F.try_divide(mean, std) * (k**0.5)).alias("sharpe"),
        sample_skewness(value).alias("skew"),
        sample_kurtosis(value).alias("kurt"),
        F.max(value).alias("best"),
        F.min(value).alias("worst"),
        F.count(value).alias("n"),
    )


def max_drawdown(prices: DataFrame, value: str = "value", keys: Sequence[str] = KEYS) -> DataFrame:
    """Deepest drawdown in percent, on prices."""
    return W.drawdown(prices, value, keys).groupBy(*keys).agg((F.min("drawdown") * 100).alias("max_drawdown"))


def corr_matrix(returns: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("panel_id",)) -> DataFrame:
    """All pairwise correlations in long form (row, col, corr), from one pass over the panel."""
    pairs = list(itertools.combinations_with_replacement(cols, 2))
    aggs = [W.correlation(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs) if a != b]
    wide = returns.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("n"))
    cells = []
    for i, (a, b) in enumerate(pairs):
        v = F.lit(1.0) if a == b else F.col(f"c{i}")
        for r, c in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), v.alias("corr")))
    return wide.select(*keys, F.inline(F.array(*cells)))


def latest_prev(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Latest and previous available point of each series with at least two points.

    The rank filter is applied before the exchange as well, so each input
    partition sends at most two rows per series.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    top = df.filter(F.col(value).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    first, second = F.col("_rn") == 1, F.col("_rn") == 2
    g = top.groupBy(*keys).agg(
        F.max(F.when(first, F.col(value))).alias("current"),
        F.max(F.when(first, F.col(date))).alias("date"),
        F.max(F.when(second, F.col(value))).alias("previous"),
        F.max(F.when(second, F.col(date))).alias("prev_date"),
    )
    return g.filter("prev_date is not null")


def peak(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Highest value and its date; the earliest date wins a tie."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max(value).alias("peak"), F.min_by(date, F.struct(-F.col(value), F.col(date))).alias("peak_date")
    )


def snapshot(df: DataFrame, base_date: str, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Current, previous, peak and base value per series with at least two points.

    One window step finds the previous point, one aggregate over the same
    partitioning does the rest: a single exchange of the series rows.
    """
    v, d = F.col(value), F.col(date)
    w = W.by(keys, date)
    s = df.filter(v.isNotNull()).withColumns({"_pv": F.lag(value).over(w), "_pd": F.lag(date).over(w)})
    g = s.groupBy(*keys).agg(
        F.max_by(value, date).alias("current"),
        F.max(date).alias("date"),
        F.max_by("_pv", date).alias("previous"),
        F.max_by("_pd", date).alias("prev_date"),
        F.max(value).alias("peak"),
        F.min_by(date, F.struct(-v, d)).alias("peak_date"),
        F.max(F.when(d == F.lit(base_date).cast("date"), v)).alias("base_value"),
    )
    return g.filter("prev_date is not null")


def deltas(snap: DataFrame) -> DataFrame:
    """Change on the previous available point, in percent, and distance from the peak in percent."""
    mom = F.col("current") - F.col("previous")
    return snap.withColumns(
        {
            "mom": mom,
            "mom_pct": F.try_divide(mom, F.col("previous")) * 100,
            "vs_peak_pct": F.try_divide(F.col("current") - F.col("peak"), F.col("peak")) * 100,
        }
    )


def peak_trough(df: DataFrame, base_date: str, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Peak and trough with dates (earliest on ties) and the latest value against peak, trough and base."""
    v, d = F.col(value), F.col(date)
    g = df.filter(v.isNotNull()).groupBy(*keys).agg(
        F.max(value).alias("peak"),
        F.min_by(date, F.struct(-v, d)).alias("peak_date"),
        F.min(value).alias("trough"),
        F.min_by(date, F.struct(v, d)).alias("trough_date"),
        F.max_by(value, date).alias("latest"),
        F.max(F.when(d == F.lit(base_date).cast("date"), v)).alias("base"),
    )

    def vs(c: str) -> Column:
        return (F.try_divide(F.col("latest"), F.col(c)) - 1) * 100

    return g.withColumns({"from_peak_pct": vs("peak"), "from_trough_pct": vs("trough"), "from_base_pct": vs("base")})


def period_stats(df: DataFrame, as_of: str, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Last available value, all-time high and low, and the range of the 52 weeks up to ``as_of``."""
    v, d, day = F.col(value), F.col(date), F.lit(as_of).cast("date")
    in_year = (d > F.date_sub(day, 364)) & (d <= day)
    return df.filter((d <= day) & v.isNotNull()).groupBy(*keys).agg(
        F.max_by(value, date).alias("last"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max(F.when(in_year, v)).alias("high_52w"),
        F.min(F.when(in_year, v)).alias("low_52w"),
    )


def lookback_change(
    df: DataFrame, as_of: str, months: Sequence[int] = (1, 3), value="value", keys: Sequence[str] = KEYS, date="date"
) -> DataFrame:
    """Percent change of the last value against the value in force m months before ``as_of``."""
    v, d, day = F.col(value), F.col(date), F.lit(as_of).cast("date")
    aggs = [F.max_by(value, date).alias("last")]
    for m in months:
        then = d <= F.add_months(day, -m)
        aggs.append(F.max_by(F.when(then, v), F.when(then, d)).alias(f"_b{m}"))
    g = df.filter((d <= day) & v.isNotNull()).groupBy(*keys).agg(*aggs)
    chg = {f"chg_{m}m": F.try_divide(F.col("last") - F.col(f"_b{m}"), F.col(f"_b{m}")) * 100 for m in months}
    return g.withColumns(chg).drop(*[f"_b{m}" for m in months])


def simple_ols(df: DataFrame, y: str, x: str, keys: Sequence[str]) -> DataFrame:
    """Slope, intercept, R2 and correlation of one pair per group."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        W.correlation(y, x).alias("corr"),
        F.count(F.when(F.col(y).isNotNull() & F.col(x).isNotNull(), 1)).alias("n"),
    )


def implied_move(df: DataFrame, y: str, x: str, keys: Sequence[str], date: str = "date") -> DataFrame:
    """End points of the regression line and, for the latest complete pair, the move it implies against the actual one."""
    fit = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull()).groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_lo"),
        F.max(x).alias("x_hi"),
        F.max_by(x, date).alias("x_last"),
        F.max_by(y, date).alias("y_last"),
    )

    def line(c: str) -> Column:
        return F.col("intercept") + F.col("slope") * F.col(c)

    return fit.withColumns(
        {"y_lo": line("x_lo"), "y_hi": line("x_hi"), "implied": line("x_last"), "gap": F.col("y_last") - line("x_last")}
    )


def group_sum(df: DataFrame, groups: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Sum per group over a complete list of groups: a group without rows gets 0.

    Summing before the join keeps a dominant group down to one row per input partition.
    """
    sums = df.groupBy(key).agg(F.sum(value).alias(out))
    return groups.join(sums, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def recent_trend(df: DataFrame, n: int = 4, value: str = "resid", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Mean of the last ``n`` values and its label."""
    last = W.last_n(df.filter(F.col(value).isNotNull()), n, keys, date)
    g = last.groupBy(*keys).agg(F.avg(value).alias("recent_mean"))
    return g.withColumn("trend", F.when(F.col("recent_mean") > 0, "Richening").otherwise("Cheapening"))


def r_squared(df: DataFrame, actual: str, resid: str, keys: Sequence[str], *more: Column) -> DataFrame:
    """1 - sum(e^2) / sum((y - mean)^2), rows without a residual skipped in the first sum; ``more``: other aggregates of the groups."""
    e = F.col(resid)
    total = F.var_pop(actual) * F.count(actual)
    return df.groupBy(*keys).agg((1 - F.try_divide(F.sum(e * e), total)).alias("r2"), *more)


def durbin_watson(df: DataFrame, resid: str = "resid", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    e = F.col(resid)
    step = e - W.lagged(resid, keys, date)
    g = df.filter(e.isNotNull()).withColumn("_de", step).groupBy(*keys)
    return g.agg(F.try_divide(F.sum(F.col("_de") * F.col("_de")), F.sum(e * e)).alias("dw"))


def counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Series and observations loaded. Counting per series first leaves the distinct count to the grouping."""
    per = df.groupBy(*keys).agg(F.count("value").alias("obs"))
    return per.agg(F.count(F.lit(1)).alias("n_series"), F.sum("obs").alias("n_obs"))


def domain(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def first_last(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """First and last available point of each series."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min(date).alias("first_date"),
        F.min_by(value, date).alias("first_value"),
        F.max(date).alias("last_date"),
        F.max_by(value, date).alias("last_value"),
    )


def to_array(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """One ordered array of points per series; date grain bounds its length."""
    pts = F.array_sort(F.collect_list(F.struct(F.col(date).alias("date"), F.col(value).alias("value"))))
    return df.groupBy(*keys).agg(pts.alias("points"))


def surprise(df: DataFrame, actual: str = "actual", lo: str = "exp_lo", hi: str = "exp_hi") -> DataFrame:
    """Actual against a consensus range: gap to the nearer bound and beat / below / in line."""
    a, l, h = F.col(actual), F.col(lo), F.col(hi)
    return df.withColumns(
        {
            "gap": F.when(a > h, a - h).when(a < l, a - l).when(a.between(l, h), 0.0),
            "outcome": F.when(a > h, "beat").when(a < l, "below").when(a.between(l, h), "in line"),
        }
    )


def annualise(df: DataFrame, rate: str = "pct") -> DataFrame:
    """A monthly rate in percent as a yearly one: simple (x12) and compounded."""
    r = F.col(rate)
    return df.withColumns({"annual_simple": r * 12, "annual_compound": (F.pow(1 + r / 100, F.lit(12)) - 1) * 100})


def contribution(df: DataFrame, keys: Sequence[str], weight: str = "weight", change: str = "change") -> DataFrame:
    """Share of a weighted total change that comes from each component.

    The total is an ordinary aggregate joined back, so components combine before any exchange.
    """
    part = F.col(weight) * F.col(change)
    total = df.groupBy(*keys).agg(F.sum(part).alias("_total"))
    j = W.join_back(df, total, keys)
    return j.withColumn("share", F.try_divide(part, F.col("_total"))).drop("_total")


def largest_since(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """Last earlier date with a value at least as large as the latest; null when the latest is a record.

    The latest point is an aggregate joined back, so a key with most of the rows is not gathered in one task.
    """
    d = df.filter(F.col(value).isNotNull())
    latest = d.groupBy(*keys).agg(F.max_by(value, date).alias("_cur"), F.max(date).alias("_cd"))
    hit = (F.col(value) >= F.col("_cur")) & (F.col(date) < F.col("_cd"))
    return W.join_back(d, latest, keys).groupBy(*keys).agg(
        F.max("_cd").alias("date"), F.max("_cur").alias("current"), F.max(F.when(hit, F.col(date))).alias("largest_since")
    )


def small_multiples(df: DataFrame, value: str = "value", keys: Sequence[str] = ("entity",), date: str = "date") -> DataFrame:
    """Latest available value and its change on the one before, which is the latest itself if there is only one."""
    w = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    top = df.filter(F.col(value).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    g = top.groupBy(*keys).agg(
        F.max(F.when(F.col("_rn") == 1, F.col(value))).alias("latest"),
        F.max(F.when(F.col("_rn") == 2, F.col(value))).alias("_p"),
    )
    g = g.withColumn("prev", F.coalesce("_p", "latest")).drop("_p")
    chg = F.col("latest") - F.col("prev")
    return g.withColumns({"change": chg, "change_pct": F.try_divide(chg, F.col("prev")) * 100})


def rank_components(df: DataFrame, value: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Components of each group in descending order of value, with their position."""
    return W.standings(df, value, name, keys)


def top_movers(df: DataFrame, k: int, change: str = "pct", name: str = "series_id") -> DataFrame:
    """The k largest moves by size; each task keeps k rows, so nothing is sorted as a whole."""
    return df.filter(F.col(change).isNotNull()).orderBy(F.abs(F.col(change)).desc(), F.col(name)).limit(k)


def top_movers_by(df: DataFrame, k: int, category: str, change: str = "pct", name: str = "series_id") -> DataFrame:
    """The k largest moves of each category; the rank filter also runs before the exchange."""
    w = Window.partitionBy(category).orderBy(F.abs(F.col(change)).desc(), F.col(name))
    ranked = df.filter(F.col(change).isNotNull()).withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("bigint"))


def sparkline(df: DataFrame, n: int = 8, value: str = "value", keys: Sequence[str] = KEYS, date: str = "date") -> DataFrame:
    """The last ``n`` available values of each series as an ordered array."""
    last = W.last_n(df.filter(F.col(value).isNotNull()), n, keys, date)
    pts = F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col(value).alias("v"))))
    return last.groupBy(*keys).agg(F.transform(pts, lambda p: p["v"]).alias("trend"))
