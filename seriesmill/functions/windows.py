"""Window functions over series at date grain.

Every function partitions by the series keys and orders by the date, so a chain
of them needs one exchange and one sort. A series holds one row per date, which
bounds a partition by the calendar, not by the number of source rows. Sequences
without such a bound (ticks) go through ``operators.long_series``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEYS = ("series_id",)


def join_back(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the aggregates of their group. As in a grouping, rows without a key are a group too: none is lost."""
    own = totals.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) if df.schema[k].nullable else F.col(k) == F.col(f"_of_{k}") for k in keys])
    return df.join(own, same).drop(*[f"_of_{k}" for k in keys])


def by(keys: Sequence[str] = KEYS, order: str = "date"):
    return Window.partitionBy(*keys).orderBy(order)


def lagged(c: str | Column, keys: Sequence[str] = KEYS, order: str = "date", n: int = 1) -> Column:
    return F.lag(c, n).over(by(keys, order))


def log_return(df: DataFrame, cols: Sequence[str] = ("value",), keys=KEYS, order="date", suffix: str = "") -> DataFrame:
    """Log return in percent. A price of zero or below gives null."""
    w = by(keys, order)
    ratio = {c: F.try_divide(F.col(c), F.lag(c).over(w)) for c in cols}
    return df.withColumns({c + suffix: F.log(F.when(r > 0, r)) * 100 for c, r in ratio.items()})


def pct_change(df: DataFrame, value="value", keys=KEYS, order="date", out="pct", default: float | None = None) -> DataFrame:
    """Change against the previous row in percent, with the gap to it in months.

    The gap lets a consumer tell a one-month change from a jump over missing months.
    """
    prev = lagged(value, keys, order)
    chg = F.try_divide((F.col(value) - prev) * 100, prev)
    if default is not None:
        chg = F.coalesce(chg, F.lit(default))
    d, p = F.col(order), lagged(order, keys, order)
    gap = (F.year(d) - F.year(p)) * 12 + F.month(d) - F.month(p)
    return df.withColumns({out: chg, "gap_months": gap.cast("bigint")})


def drawdown(df: DataFrame, value="value", keys=KEYS, order="date") -> DataFrame:
    """Running maximum and the relative distance below it."""
    w = by(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    peak = F.max(value).over(w)
    return df.withColumns({"running_max": peak, "drawdown": F.try_divide(F.col(value), peak) - 1})


def rebase(df: DataFrame, value="value", keys=KEYS, order="date", base: float = 100.0) -> DataFrame:
    w = by(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.first(value, ignorenulls=True).over(w)
    return df.withColumn("rebased", F.try_divide(F.col(value), first) * base)


def cum_sum(df: DataFrame, value="value", keys=KEYS, order="date", out="cum") -> DataFrame:
    w = by(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.coalesce(F.col(value), F.lit(0.0))).over(w))


def _full(agg: Column, n_valid: Column, n: int) -> Column:
    """Null until the frame holds ``n`` values."""
    return F.when(n_valid == n, agg)


def rolling_mean(c: str, n: int, keys=KEYS, order="date") -> Column:
    w = by(keys, order).rowsBetween(-(n - 1), 0)
    return _full(F.avg(c).over(w), F.count(c).over(w), n)


def rolling_std(c: str, n: int, keys=KEYS, order="date") -> Column:
    w = by(keys, order).rowsBetween(-(n - 1), 0)
    return _full(F.stddev_samp(c).over(w), F.count(c).over(w), n)


def rolling(df: DataFrame, n: int, value="value", keys=KEYS, order="date") -> DataFrame:
    return df.withColumns({"roll_mean": rolling_mean(value, n, keys, order), "roll_std": rolling_std(value, n, keys, order)})


def zscore(df: DataFrame, n: int, value="value", keys=KEYS, order="date", out="z") -> DataFrame:
    """Distance from the rolling mean in rolling standard deviations; null while warming up or when the deviation is 0."""
    m, s = rolling_mean(value, n, keys, order), rolling_std(value, n, keys, order)
    return df.withColumn(out, F.try_divide(F.col(value) - m, s))


def zscore_cum(df: DataFrame, n: int, value="value", keys=KEYS, order="date", out="z_cum") -> DataFrame:
    """z-score of the running sum. Two window steps over one partitioning."""
    return zscore(cum_sum(df, value, keys, order, out="cum"), n, "cum", keys, order, out)


def correlation(y: str, x: str, over: WindowSpec | None = None) -> Column:
    """Correlation of the complete pairs of a group, or of a window; null where either side does not vary.

    ``corr`` would stop the whole job there, with a division by zero: two equal returns at the start of one series are enough.
    """
    both = F.col(y).isNotNull() & F.col(x).isNotNull()
    parts = [F.covar_pop(y, x), *[F.stddev_pop(F.when(both, F.col(c))) for c in (y, x)]]
    cov, std_y, std_x = parts if over is None else [p.over(over) for p in parts]
    return F.try_divide(cov, std_y * std_x)


def rolling_corr(df: DataFrame, n: int, y: str, xs: Sequence[str], keys=KEYS, order="date") -> DataFrame:
    """Correlation of ``y`` with each of ``xs`` over the last ``n`` rows, current row included; null where one of them is flat."""
    w = by(keys, order).rowsBetween(-(n - 1), 0)

    def one(x: str) -> Column:
        both = F.count(F.when(F.col(y).isNotNull() & F.col(x).isNotNull(), 1)).over(w)
        return _full(correlation(y, x, w), both, n)

    return df.withColumns({f"corr_{x}": one(x) for x in xs})


def rolling_beta(df: DataFrame, n: int, y: str, x: str, keys=KEYS, order="date") -> DataFrame:
    """One-factor beta, intercept and R2 over the ``n`` rows *before* the current one."""
    w = by(keys, order).rowsBetween(-n, -1)
    both = F.count(F.when(F.col(y).isNotNull() & F.col(x).isNotNull(), 1)).over(w)
    yc, xc = F.col(y), F.col(x)
    return df.withColumns(
        {
            "beta": _full(F.regr_slope(yc, xc).over(w), both, n),
            "alpha": _full(F.regr_intercept(yc, xc).over(w), both, n),
            "r2": _full(F.regr_r2(yc, xc).over(w), both, n),
        }
    )


def tag_recent(df: DataFrame, n: int = 12, keys=KEYS, order="date") -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("tag", F.when(rn <= n, "recent").otherwise("historical"))


def standings(df: DataFrame, value: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Successive positions by value; the name breaks ties.

    Ranks whole groups, so aggregate first: it is meant for lists of components or
    competitors. For the best of a large group use ``top_movers_by``.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(name))
    return df.withColumn("pos", F.row_number().over(w).cast("bigint"))


def share_of_max(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Percent of the largest value of each group; the maximum is an aggregate joined back."""
    top = df.groupBy(*keys).agg(F.max(value).alias("_top"))
    return join_back(df, top, keys).withColumn("share", F.round(F.try_divide(F.col(value) * 100, F.col("_top")), 0)).drop("_top")


def clamp_share(df: DataFrame, scale: float, value="value") -> DataFrame:
    return df.withColumn("share", F.least(F.abs(F.col(value)) / scale * 100, F.lit(100.0)))


def minmax(df: DataFrame, value="value", keys=KEYS) -> DataFrame:
    """Scale to 0..1 inside each series; a series without range scales to 0. The range is an aggregate joined back."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    rng = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    return join_back(df, ends, keys).withColumn("scaled", (F.col(value) - lo) / rng).drop("_lo", "_hi")


def header_flag(df: DataFrame, category: str, keys: Sequence[str], order: str) -> DataFrame:
    """True on the first row and wherever the category differs from the row before."""
    prev = F.lag(category).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("is_header", ~F.col(category).eqNullSafe(prev))


def last_n(df: DataFrame, n: int, keys=KEYS, order="date") -> DataFrame:
    """The last ``n`` rows per series. The rank filter is also applied before the exchange."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")


def all_but_last_n(df: DataFrame, n: int, keys=KEYS, order="date") -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_rn", rn).filter(F.col("_rn") > n).drop("_rn")


def lag_state(df: DataFrame, cols: Sequence[str], keys=KEYS, order="date") -> DataFrame:
    """State known before the row: the previous row's value, 0 on the first row."""
    w = by(keys, order)
    return df.withColumns({f"prev_{c}": F.lag(c, 1, 0.0).over(w) for c in cols})
