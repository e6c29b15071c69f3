"""Rich/cheap signals from regression residuals or filter innovations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions import windows as W
from seriesmill.functions.scalars import verdict
from seriesmill.functions.windows import join_back
from seriesmill.operators.aggregates import r_squared
from seriesmill.operators.regression import ols_apply, ols_betas, ols_fit

KEYS = ("panel_id",)


def signal_path(resid: DataFrame, n: int = 52, n_cum: int = 104, value: str = "resid", keys: Sequence[str] = KEYS) -> DataFrame:
    """Running sum, z-score of the residual and z-score of the running sum, per date."""
    s = W.cum_sum(resid, value, keys, out="cum_resid")
    s = W.zscore(s, n, value, keys, out="z")
    return W.zscore(s, n_cum, "cum_resid", keys, out="z_cum")


def signal_last(path: DataFrame, value: str = "resid", keys: Sequence[str] = KEYS, kind: str = "in_sample", trend_n: int = 4) -> DataFrame:
    """One row per panel: the last state, its verdict and the trend of the last residuals.

    The verdict follows the z-score of the running sum; a history too short for it
    gives FAIR VALUE, which ``has_history`` tells apart.
    """
    w = Window.partitionBy(*keys).orderBy("date").rowsBetween(-(trend_n - 1), 0)
    p = path.withColumn("_recent", F.avg(value).over(w))
    last = p.groupBy(*keys).agg(
        F.max_by(F.struct(F.col("date"), F.col(value).alias("resid"), "cum_resid", "z", "z_cum", "_recent"), "date").alias("s")
    )
    return last.select(
        *keys,
        "s.date",
        "s.resid",
        "s.cum_resid",
        "s.z",
        "s.z_cum",
        verdict(F.col("s.z_cum")).alias("verdict"),
        F.when(F.col("s._recent") > 0, "Richening").otherwise("Cheapening").alias("trend"),
        F.col("s.z_cum").isNotNull().alias("has_history"),
        F.lit(kind).alias("basis"),
    )


def static_residuals(panel: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    return ols_apply(panel, ols_betas(panel, y, xs, keys), y, xs, keys)


def rich_cheap(panel: DataFrame, y: str, xs: Sequence[str], n: int = 52, n_cum: int = 104, keys: Sequence[str] = KEYS) -> DataFrame:
    """Signal per panel from full-sample residuals (they look ahead: basis ``in_sample``)."""
    return signal_last(signal_path(static_residuals(panel, y, xs, keys), n, n_cum, "resid", keys), "resid", keys)


def rich_cheap_tvp(filtered: DataFrame, n: int = 52, n_cum: int = 104, burn: int = 0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Signal per panel from one-step innovations, which use past data only.

    ``burn`` leaves out the first rows, whose innovations still carry the wide prior.
    """
    f = filtered
    if burn:
        f = f.withColumn("_rn", F.row_number().over(W.by(keys))).filter(F.col("_rn") > burn).drop("_rn")
    return signal_last(signal_path(f, n, n_cum, "innov", keys), "innov", keys, kind="real_time")


def model_compare(panel: DataFrame, smoothed: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Latest smoothed beta against the static one per factor, and the gain in R2 in percentage points.

    One fit per panel gives both its coefficients and its R2; every term of the smoothed rows carries the fitted values,
    so one grouping gives the latest beta and the R2 of the moving model.
    """
    fit = ols_fit(panel, y, xs, keys)
    named = F.arrays_zip(F.array(*[F.lit(x) for x in xs]).alias("term"), F.slice("fit.coef", 2, len(xs)).alias("ols_beta"))
    static = fit.select(*keys, F.col("fit.r2").alias("ols_r2"), F.inline(named).alias("term", "ols_beta"))
    resid = smoothed.withColumn("_e", F.col("y") - F.col("fitted"))
    moving = r_squared(resid, "y", "_e", [*keys, "term"], F.max_by("beta", "date").alias("tvp_beta")).withColumnRenamed("r2", "tvp_r2")
    both = join_back(moving, static, [*keys, "term"])
    return both.select(
        *keys, "term", "tvp_beta", "ols_beta", (F.col("tvp_beta") - F.col("ols_beta")).alias("delta"), "tvp_r2", "ols_r2",
        ((F.col("tvp_r2") - F.col("ols_r2")) * 100).alias("gain_pp"),
    )
