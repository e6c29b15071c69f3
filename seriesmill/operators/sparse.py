"""LASSO and elastic net per panel with contiguous cross-validation.

Rows are reduced to one summary per (panel, fold) by a single mergeable aggregate.
Everything after that, 200 penalties on ten folds, works on ten k x k matrices per
panel and does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.regression import KEYS, complete, full_matrix, gram, packed

ALPHA_EXPONENTS = (-4.0, 1.0, 200)  # fixed values: 200 penalties from 1e-4 to 1e1


def alpha_grid(lo: float = ALPHA_EXPONENTS[0], hi: float = ALPHA_EXPONENTS[1], n: int = ALPHA_EXPONENTS[2]) -> np.ndarray:
    return np.logspace(lo, hi, n)


def fold_grams(df: DataFrame, y: str, xs: Sequence[str], folds: int, keys=KEYS, order: str = "date") -> DataFrame:
    """(keys, fold, n, means, upper) of contiguous folds in date order."""
    w = Window.partitionBy(*keys).orderBy(order)
    tagged = df.filter(complete([y, *xs])).withColumn("fold", F.ntile(folds).over(w))
    means, upper = packed([y, *xs])
    return gram(tagged, [y, *xs], [*keys, "fold"]).select(*keys, "fold", "n", means.alias("means"), upper.alias("upper"))


def merge(n: np.ndarray, means: np.ndarray, s: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Combine centred summaries of disjoint row sets."""
    total = n.sum()
    mean = (n[:, None] * means).sum(0) / total
    d = means - mean
    return total, mean, s.sum(0) + np.einsum("f,fi,fj->ij", n, d, d)


def path(g: np.ndarray, c: np.ndarray, alphas: np.ndarray, l1_ratio: float, tol: float = 1e-10, sweeps: int = 50_000) -> tuple[np.ndarray, bool]:
    """Warm-started coordinate descent for a stack of problems at once.

    ``g`` (m, k, k) and ``c`` (m, k) are centred moments divided by the row count.
    Returns (len(alphas), m, k) for penalties in the given, descending order, and whether all of them settled.
    """
    settled = True
    m, k = c.shape
    w = np.zeros((m, k))
    out = np.empty((len(alphas), m, k))
    diag = np.einsum("mii->mi", g)
    for i, a in enumerate(alphas):
        l1, denom = a * l1_ratio, diag + a * (1.0 - l1_ratio)
        for _ in range(sweeps):
            biggest = 0.0
            for j in range(k):
                rho = c[:, j] - np.einsum("mk,mk->m", g[:, j], w) + diag[:, j] * w[:, j]
                with np.errstate(all="ignore"):
                    new = np.sign(rho) * np.maximum(np.abs(rho) - l1, 0.0) / denom[:, j]
                new = np.where(denom[:, j] > 0, new, 0.0)
                biggest = max(biggest, float(np.abs(new - w[:, j]).max()))
                w[:, j] = new
            if biggest < tol:
                break
        else:
            settled = False
        out[i] = w
    return out, settled


def cross_validate(n, means, s, alphas: np.ndarray, l1_ratio: float) -> dict[str, np.ndarray | float]:
    """Choose the penalty with the lowest mean fold error; all folds and the full fit share one path run."""
    order = np.argsort(-alphas, kind="stable")
    desc = alphas[order]
    total, mean, full = merge(n, means, s)
    # Scaling uses the whole panel, before the folds are cut.
    scale = np.sqrt(np.diag(full)[1:] / total)
    scale[scale == 0] = 1.0
    unit = np.concatenate([[1.0], scale])
    m, s, full = means / unit, s / unit[:, None] / unit, full / unit[:, None] / unit
    train = [merge(np.delete(n, i), np.delete(m, i, 0), np.delete(s, i, 0)) for i in range(len(n))]
    stack = np.stack([t[2] / t[0] for t in train] + [full / total])
    w, settled = path(stack[:, 1:, 1:], stack[:, 1:, 0], desc, l1_ratio)
    mse = np.empty((len(desc), len(n)))
    for i, (_, tm, _) in enumerate(train):
        b = w[:, i]
        gap = (m[i, 0] - tm[0]) - b @ (m[i, 1:] - tm[1:])
        quad = s[i][0, 0] - 2.0 * b @ s[i][1:, 0] + np.einsum("ai,ij,aj->a", b, s[i][1:, 1:], b)
        mse[:, i] = quad / n[i] + gap**2
    best = int(np.argmin(mse.mean(1)))
    b = w[best, -1]
    rss = full[0, 0] - 2.0 * b @ full[1:, 0] + b @ full[1:, 1:] @ b
    return {
        "alphas": desc,
        "path": w[:, -1],
        "mse": mse.mean(1),
        "alpha": float(desc[best]),
        "n": int(total),
        "converged": settled,
        "std": b,
        "raw": b / scale,
        "intercept": float(mean[0] - (b / scale) @ mean[1:]),
        "r2": float(1.0 - rss / full[0, 0]) if full[0, 0] > 0 else np.nan,
    }


def _read(pdf: pd.DataFrame):
    pdf = pdf.sort_values("fold")
    means = np.array(pdf["means"].tolist(), float)
    return pdf["n"].to_numpy(float), means, full_matrix(np.array(pdf["upper"].tolist(), float), means.shape[1])


def _key_type(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def lasso_cv(df: DataFrame, y: str, xs: Sequence[str], folds: int = 10, l1_ratio: float = 1.0, alphas=None,
             keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """(keys, term, coef_std, coef, alpha, r2, selected, n, converged); one group holds ``folds`` rows, whatever the panel.

    A panel with fewer than two rows has no fit: null coefficients, nothing selected, and ``n`` tells why.
    """
    grid, names, keys = alpha_grid() if alphas is None else np.asarray(alphas, float), list(xs), list(keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["n"].sum() < 2 or len(pdf) < 2:
            nothing = np.full(len(names), np.nan)
            r = {"std": nothing, "raw": nothing, "intercept": np.nan, "alpha": np.nan, "r2": np.nan, "n": int(pdf["n"].sum()), "converged": False}
        else:
            r = cross_validate(*_read(pdf), grid, l1_ratio)
        out = pd.DataFrame({"term": ["intercept", *names], "coef_std": [np.nan, *r["std"]], "coef": [r["intercept"], *r["raw"]]})
        out["alpha"], out["r2"] = r["alpha"], r["r2"]
        out["selected"] = [True, *(np.abs(r["std"]) > 1e-6)]
        out["n"], out["converged"] = r["n"], r["converged"]
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    g = fold_grams(df, y, xs, folds, keys, order)
    schema = f"{_key_type(df, keys)}, term string, coef_std double, coef double, alpha double, r2 double, selected boolean, n bigint, converged boolean"
    fits = g.groupBy(*keys).applyInPandas(fit, schema)
    return fits.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("coef_std", "coef", "alpha", "r2")})


def lasso_path(df: DataFrame, y: str, xs: Sequence[str], l1_ratio: float = 1.0, alphas=None, keys: Sequence[str] = KEYS,
               folds: int = 10, order: str = "date") -> DataFrame:
    """(keys, alpha, term, coef_std, cv_mse): the coefficients at every penalty, from the same fold summaries."""
    grid, names, keys = alpha_grid() if alphas is None else np.asarray(alphas, float), list(xs), list(keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        r = cross_validate(*_read(pdf), grid, l1_ratio)
        k = len(names)
        out = pd.DataFrame({
            "alpha": np.repeat(r["alphas"], k),
            "term": names * len(r["alphas"]),
            "coef_std": r["path"].ravel(),
            "cv_mse": np.repeat(r["mse"], k),
        })
        for key in reversed(keys):
            out.insert(0, key, pdf[key].iloc[0])
        return out

    g = fold_grams(df, y, xs, folds, keys, order)
    return g.groupBy(*keys).applyInPandas(fit, f"{_key_type(df, keys)}, alpha double, term string, coef_std double, cv_mse double")


def selection_summary(cv: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Selected and dropped factor names as text, ``None`` when there are none."""
    from seriesmill.functions.scalars import join_names

    c = cv.filter("term <> 'intercept'")
    names = lambda cond: join_names(F.array_sort(F.collect_list(F.when(cond, F.col("term")))))
    return c.groupBy(*keys).agg(
        F.first("alpha").alias("alpha"), F.first("r2").alias("r2"),
        names(F.col("selected")).alias("selected"), names(~F.col("selected")).alias("dropped"),
    )


# --- the exact path ------------------------------------------------------------------------------


def homotopy(g: np.ndarray, c: np.ndarray) -> list[tuple[float, str, int, np.ndarray]]:
    """(penalty, event, factor, coefficients) at every knot of the path, from no factor to no penalty.

    Between knots the coefficients are linear in the penalty: w = u - a v on the active factors. The next knot is the
    largest penalty below at which another factor's correlation with the residual reaches it (``enter``) or an active
    coefficient becomes zero (``leave``). A factor that active ones explain completely never enters.
    """
    k, w = len(c), np.zeros(len(c))
    usable = np.diag(g) > 0
    held = np.where(usable, np.abs(c), 0.0)
    alpha = float(held.max()) if k else 0.0
    if alpha <= 0:
        return [(0.0, "end", -1, w)]
    first = int(np.argmax(held))
    active, signs, knots, last = [first], [np.sign(c[first])], [(alpha, "enter", first, w.copy())], first
    while True:
        part = g[np.ix_(active, active)]
        u, v = np.linalg.solve(part, c[active]), np.linalg.solve(part, np.array(signs))
        a, b = c - g[:, active] @ u, g[:, active] @ v  # the residual's correlations are a + alpha b
        best, event, who, sign = 0.0, "end", -1, 0.0
        for j in np.flatnonzero(usable).tolist():
            if j in active:
                at = active.index(j)
                zero = u[at] / v[at] if v[at] else 0.0
                if j != last and best < zero < alpha * (1 - 1e-12):
                    best, event, who = zero, "leave", j
                continue
            if j == last or g[j, j] - g[j, active] @ np.linalg.solve(part, g[active, j]) <= 1e-10 * g[j, j]:
                continue
            for s in (1.0, -1.0):
                if 1.0 - s * b[j] > 1e-14 and best < (meets := s * a[j] / (1.0 - s * b[j])) <= alpha * (1 + 1e-10):
                    best, event, who, sign = min(meets, alpha), "enter", j, s
        w = np.zeros(k)
        w[active] = u - best * v
        if event == "leave":
            w[who] = 0.0
        knots.append((best, event, who, w))
        if event == "end":
            return knots
        if event == "enter":
            active, signs = [*active, who], [*signs, sign]
        else:
            at = active.index(who)
            del active[at], signs[at]
            if not active:
                knots.append((0.0, "end", -1, np.zeros(k)))
                return knots
        alpha, last = best, who


def _standard(n: float, upper: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Moments of standardised factors, and with the target, divided by the row count."""
    s = full_matrix(upper, k)
    scale = np.sqrt(np.diag(s) / n)
    scale[0], scale[scale == 0] = 1.0, 1.0
    s = s / n / scale[:, None] / scale
    return s[1:, 1:], s[1:, 0]


def lasso_knots(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, step, alpha, event, factor, term, coef_std): the whole path of each panel, knot by knot, from one summary per
    panel. ``factor`` enters or leaves at the knot; the last one (``end``) is least squares."""
    names, keys, k = list(xs), list(keys), len(xs) + 1

    def run(frames):
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                at = dict(zip(pdf.columns, row))
                knots = homotopy(*_standard(at["n"], np.array(at["upper"], float), k))
                out = pd.DataFrame({
                    "step": np.repeat(np.arange(len(knots)), len(names)), "alpha": np.repeat([q[0] for q in knots], len(names)),
                    "event": np.repeat([q[1] for q in knots], len(names)), "factor": np.repeat(np.array([names[q[2]] if q[2] >= 0 else None for q in knots], object), len(names)),
                    "term": names * len(knots), "coef_std": np.concatenate([q[3] for q in knots]),
                })
                for key in reversed(keys):
                    out.insert(0, key, [at[key]] * len(out))
                yield out

    g = gram(df, [y, *xs], keys).where("n > 1").select(*keys, "n", packed([y, *xs])[1].alias("upper"))
    return g.mapInPandas(run, f"{_key_type(df, keys)}, step bigint, alpha double, event string, factor string, term string, coef_std double")


def at_penalties(knots: DataFrame, alphas: Sequence[float] | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, alpha, term, coef_std) at any penalties: exact, as the path is linear between its knots."""
    grid = [float(a) for a in (alpha_grid() if alphas is None else alphas)]
    per = knots.groupBy(*keys, "term").agg(F.array_sort(F.collect_list(F.struct("alpha", "coef_std"))).alias("path"))
    asked = per.withColumn("a", F.explode(F.array(*[F.lit(a) for a in grid])))
    above = F.get(F.filter("path", lambda p: p["alpha"] >= F.col("a")), F.lit(0))
    below = F.try_element_at(F.filter("path", lambda p: p["alpha"] <= F.col("a")), F.lit(-1))
    part = asked.select(*keys, "term", "a", above.alias("hi"), below.alias("lo"))
    share = F.coalesce(F.try_divide(F.col("a") - F.col("lo.alpha"), F.col("hi.alpha") - F.col("lo.alpha")), F.lit(0.0))
    inside = F.col("lo.coef_std") + share * (F.col("hi.coef_std") - F.col("lo.coef_std"))
    return part.select(*keys, F.col("a").alias("alpha"), "term", F.when(F.col("hi").isNull(), F.lit(0.0)).otherwise(inside).alias("coef_std"))
