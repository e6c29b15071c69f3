"""Least squares per panel from co-moments.

A panel of any length is reduced to its means and k x k centred cross products by
one mergeable aggregate; only that fixed-size summary reaches the solver, where
whole Arrow batches of panels are solved at once. Moving fits (``moving``) use the
same summary of each window.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.tails import f_upper, t_two_sided
from seriesmill.functions.windows import join_back

KEYS = ("panel_id",)

_D, _A = T.DoubleType(), T.ArrayType(T.DoubleType())
BETAS = T.StructType().add("coef", _A).add("r2", _D)
FIT = T.StructType()
for _name in ("coef", "se", "t", "p"):
    FIT.add(_name, _A)
for _name in ("r2", "adj_r2", "f", "f_p"):
    FIT.add(_name, _D)
FIT.add("rank", T.IntegerType())


def pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    return list(itertools.combinations_with_replacement(cols, 2))


def complete(cols: Sequence[str]) -> Column:
    """True where every column has a value."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def gram(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, n, m_<c>, s_<a>_<b>): row count, means and centred cross products of complete rows.

    Co-moments are updated and merged around running means, so nothing cancels
    as it would with raw sums of squares.
    """
    n = F.count(F.lit(1))
    aggs = [n.alias("n")] + [F.avg(c).alias(f"m_{c}") for c in cols]
    aggs += [(F.covar_pop(a, b) * n).alias(f"s_{a}_{b}") for a, b in pairs(cols)]
    return df.filter(complete(cols)).groupBy(*keys).agg(*aggs)


def packed(cols: Sequence[str]) -> tuple[Column, Column]:
    """Means and upper triangle of a ``gram`` row as two arrays."""
    means = F.array(*[F.col(f"m_{c}") for c in cols])
    return means, F.array(*[F.col(f"s_{a}_{b}") for a, b in pairs(cols)])


def full_matrix(upper: np.ndarray, k: int) -> np.ndarray:
    """Upper triangles (..., k(k+1)/2) to symmetric matrices (..., k, k)."""
    i, j = np.triu_indices(k)
    out = np.empty((*upper.shape[:-1], k, k))
    out[..., i, j] = upper
    out[..., j, i] = upper
    return out


def _fit(n: np.ndarray, means: np.ndarray, s: np.ndarray) -> dict[str, np.ndarray]:
    """Least squares with intercept for a batch of summaries; the first column is the target."""
    k = means.shape[1] - 1
    sxx, sxy, syy = s[:, 1:, 1:], s[:, 1:, 0], s[:, 0, 0]
    scale = np.sqrt(np.einsum("nii->ni", sxx))
    scale[scale == 0] = 1.0
    unit = sxx / scale[:, :, None] / scale[:, None, :]
    val, vec = np.linalg.eigh(unit)
    good = val > 1e-12 * k
    rank = good.sum(1)
    part = vec * np.where(good, 1.0 / np.where(good, val, 1.0), 0.0)[:, None, :]
    inv = part @ np.swapaxes(vec, 1, 2) / scale[:, :, None] / scale[:, None, :]
    beta = np.einsum("nij,nj->ni", inv, sxy)
    rss = np.maximum(syy - np.einsum("ni,ni->n", beta, sxy), 0.0)
    dof = n - rank - 1
    with np.errstate(all="ignore"):
        s2 = np.where(dof > 0, rss / dof, np.nan)
        se = np.sqrt(s2[:, None] * np.einsum("nii->ni", inv))
        se0 = np.sqrt(s2 * (1.0 / n + np.einsum("ni,nij,nj->n", means[:, 1:], inv, means[:, 1:])))
        coef = np.column_stack([means[:, 0] - np.einsum("ni,ni->n", means[:, 1:], beta), beta])
        errs = np.column_stack([se0, se])
        r2 = np.where(syy > 0, 1.0 - rss / syy, np.nan)
        return {
            "coef": coef,
            "se": errs,
            "t": coef / errs,
            "r2": r2,
            "adj_r2": 1.0 - (1.0 - r2) * (n - 1) / dof,
            "f": ((syy - rss) / rank) / s2,
            "rank": rank,
            "dof": dof,
        }


def _stack(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), dtype=float)


def _nulls(a: np.ndarray) -> list:
    return [None if not np.isfinite(v) else float(v) for v in a]


@F.pandas_udf(FIT)
def solve(n: pd.Series, means: pd.Series, upper: pd.Series) -> pd.DataFrame:
    if len(n) == 0:
        return pd.DataFrame(columns=["coef", "se", "t", "p", "r2", "adj_r2", "f", "f_p", "rank"])
    m = _stack(means)
    r = _fit(n.to_numpy(float), m, full_matrix(_stack(upper), m.shape[1]))
    p = t_two_sided(r["t"], r["dof"][:, None])
    return pd.DataFrame(
        {
            "coef": list(map(_nulls, r["coef"])),
            "se": list(map(_nulls, r["se"])),
            "t": list(map(_nulls, r["t"])),
            "p": list(map(_nulls, p)),
            "r2": _nulls(r["r2"]),
            "adj_r2": _nulls(r["adj_r2"]),
            "f": _nulls(r["f"]),
            "f_p": _nulls(f_upper(r["f"], r["rank"], r["dof"])),
            "rank": r["rank"].astype("int32"),
        }
    )


@F.pandas_udf(BETAS)
def solve_betas(n: pd.Series, means: pd.Series, upper: pd.Series) -> pd.DataFrame:
    """Coefficients and R2 only; rows without a full frame stay null."""
    out = pd.DataFrame({"coef": [None] * len(n), "r2": [None] * len(n)}, dtype=object)
    ok = means.notna().to_numpy()
    if ok.any():
        m = _stack(means[ok])
        r = _fit(n[ok].to_numpy(float), m, full_matrix(_stack(upper[ok]), m.shape[1]))
        out.loc[ok, "coef"] = pd.Series(list(map(_nulls, r["coef"])), index=out.index[ok])
        out.loc[ok, "r2"] = pd.Series(_nulls(r["r2"]), index=out.index[ok], dtype=object)
    return out


def ols_fit(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per panel: (keys, n, fit)."""
    means, upper = packed([y, *xs])
    return gram(df, [y, *xs], keys).filter("n > 1").select(*keys, "n", solve(F.col("n"), means, upper).alias("fit"))


def ols_betas(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, n, fit) with coefficients and R2 only, for residuals."""
    means, upper = packed([y, *xs])
    return gram(df, [y, *xs], keys).filter("n > 1").select(*keys, "n", solve_betas(F.col("n"), means, upper).alias("fit"))


def ols(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Coefficient table: (keys, term, coef, se, t, p)."""
    terms = F.array(*[F.lit(t) for t in ("intercept", *xs)])
    z = F.arrays_zip(terms.alias("term"), F.col("fit.coef"), F.col("fit.se"), F.col("fit.t"), F.col("fit.p"))
    return ols_fit(df, y, xs, keys).select(*keys, F.inline(z).alias("term", "coef", "se", "t", "p"))


def ols_apply(df: DataFrame, fit: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Fitted values and residuals of complete rows. The join side has one row per panel."""
    c = fit.select(*keys, F.col("fit.coef").alias("_b"))
    fitted = F.col("_b")[0]
    for i, x in enumerate(xs, 1):
        fitted = fitted + F.col("_b")[i] * F.col(x)
    j = join_back(df.filter(complete([y, *xs])), c, keys).withColumn("fitted", fitted).drop("_b")
    return j.withColumn("resid", F.col(y) - F.col("fitted"))


def ols_diag(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """R2, adjusted R2, F with its p-value, Durbin-Watson and N per panel."""
    from seriesmill.operators.aggregates import durbin_watson

    fit = ols_fit(df, y, xs, keys)
    dw = durbin_watson(ols_apply(df, fit, y, xs, keys), "resid", keys)
    flat = fit.select(
        *keys, "n", F.col("fit.r2").alias("r2"), F.col("fit.adj_r2").alias("adj_r2"), F.col("fit.f").alias("f"),
        F.col("fit.f_p").alias("f_p"),
    )
    return join_back(flat, dw, keys)


def standardise(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Centre and scale by the population deviation of each panel; a constant column becomes 0.

    Moments are aggregated first and joined back as one row per panel.
    """
    aggs = [f(c).alias(f"_{k}_{c}") for c in cols for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    j = join_back(df, df.groupBy(*keys).agg(*aggs), keys)
    z = {}
    for c in cols:
        s = F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))
        z[c] = (F.col(c) - F.col(f"_m_{c}")) / s
    return j.withColumns(z).drop(*[f"_{k}_{c}" for c in cols for k in "ms"])
