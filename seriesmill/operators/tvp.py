"""Regression with random-walk betas: y_t = x_t' b_t + e_t, b_t = b_{t-1} + u_t.

The recursion is sequential inside a series and independent between series. Spark
shuffles and sorts the rows by (series, date); the forward filter then reads its
partition as a stream of Arrow batches and keeps only the state (b, P) between rows,
so the length of a series does not matter for memory. The backward smoother needs a
whole series, which holds one row per date; ``tvp_parallel`` has both for series of any length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.regression import complete

KEYS = ("series_id",)
PRIOR_VARIANCE = 1e6  # fixed value: approximate diffuse prior


def step(b: np.ndarray, p: np.ndarray, x: np.ndarray, y: float, h: float):
    """One measurement update; returns the innovation, its variance and the new state."""
    px = p @ x
    v = y - x @ b
    f = x @ px + h
    gain = px / f
    return v, f, b + gain * v, p - gain[:, None] * px


def filter_runs(y: np.ndarray, x: np.ndarray, starts: np.ndarray, q: float, h: float, before=None):
    """Forward filter over consecutive series that begin at ``starts``; all of them step together.

    ``before``: state (b, P) of the first one, if it goes on from earlier rows. Returns innovations, their variances,
    betas, standard deviations, and the state behind the last row.
    """
    n, k = x.shape
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")  # the series still running are always the first ones
    first, longest = starts[order], lengths[order]
    b, p = np.zeros((len(starts), k)), np.tile(start(k)[1], (len(starts), 1, 1))
    here = int(np.flatnonzero(order == 0)[0])
    if before is not None:
        b[here], p[here] = before[0], before[1] + np.eye(k) * q
    innov, var, beta, sd = np.empty(n), np.empty(n), np.empty((n, k)), np.empty((n, k))
    noise = np.eye(k) * q
    for t in range(longest[0]):
        m = int(np.searchsorted(-longest, -t, side="left"))  # lengths above t
        rows = first[:m] + t
        if t:
            p[:m] += noise
        xt = x[rows]
        px = np.einsum("mij,mj->mi", p[:m], xt)
        v = y[rows] - np.einsum("mi,mi->m", xt, b[:m])
        f = np.einsum("mi,mi->m", xt, px) + h
        gain = px / f[:, None]
        b[:m] += gain * v[:, None]
        p[:m] -= gain[:, :, None] * px[:, None, :]
        innov[rows], var[rows], beta[rows] = v, f, b[:m]
        sd[rows] = np.sqrt(np.maximum(np.einsum("mii->mi", p[:m]), 0.0))
    at = int(np.flatnonzero(order == len(starts) - 1)[0])
    return innov, var, beta, sd, (b[at].copy(), p[at].copy())


def start(k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(k), np.eye(k) * PRIOR_VARIANCE


def _types(df: DataFrame, keys: Sequence[str], order: str) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in [*keys, order])


def _with_intercept(df: DataFrame, xs: Sequence[str], intercept: bool) -> tuple[DataFrame, list[str]]:
    return (df.withColumn("const", F.lit(1.0)), ["const", *xs]) if intercept else (df, list(xs))


def _by_series(df: DataFrame, y: str, xs: Sequence[str], keys, order) -> DataFrame:
    """Complete observations, hash-partitioned by series and sorted by date inside it.

    The partition count is explicit: these stages are heavy per byte, and adaptive
    execution would otherwise merge them by size into few tasks.
    """
    rows = df.filter(complete([y, *xs])).select(*keys, order, F.col(y).cast("double").alias("_y"), F.array(*xs).alias("_x"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *keys).sortWithinPartitions(*keys, order)


def _grouped(df: DataFrame, y: str, xs: Sequence[str], keys, order):
    return _by_series(df, y, xs, keys, order).groupBy(*keys)


def tvp_filter(df: DataFrame, y: str, xs: Sequence[str], q: float, h: float, keys: Sequence[str] = KEYS,
               order: str = "date", intercept: bool = False) -> DataFrame:
    """Filtered betas and one-step innovations: (keys, date, y, innov, innov_var, beta[], se[]).

    ``q`` is the variance of the beta steps (the same for all betas), ``h`` that of
    the observation. The first prediction is 0, so the first innovation is y itself.
    A task walks through its sorted series one Arrow batch after the other; a batch
    may hold many short series or a part of a long one. All series of a batch take their
    steps together, so Python loops over dates and not over rows.
    """
    df, xs = _with_intercept(df, xs, intercept)
    keys, k = list(keys), len(xs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried, last, state = None, None, start(k)
        for pdf in batches:
            if not len(pdf):
                continue
            ids = pdf[keys].apply(tuple, axis=1).tolist() if len(keys) > 1 else [(v,) for v in pdf[keys[0]]]
            new = np.array([True] + [a != b for a, b in zip(ids[1:], ids)])
            days = pdf[order]
            again = np.concatenate([[False], ~new[1:] & (days.to_numpy()[1:] <= days.to_numpy()[:-1])])
            goes_on = ids[0] == carried
            if again.any() or goes_on and days.iloc[0] <= last:
                raise ValueError("dates of a series must be unique")
            x = np.array(pdf["_x"].tolist(), float)
            innov, var, beta, se, state = filter_runs(pdf["_y"].to_numpy(float), x, np.flatnonzero(new), q, h, state if goes_on else None)
            carried, last = ids[-1], days.iloc[-1]
            out = pdf[[*keys, order]].assign(y=pdf["_y"], innov=innov, innov_var=var)
            out["beta"], out["se"] = list(beta), list(se)
            yield out

    schema = f"{_types(df, keys, order)}, y double, innov double, innov_var double, beta array<double>, se array<double>"
    return _by_series(df, y, xs, keys, order).mapInPandas(run, schema)


def unique_dates(days: pd.Series) -> None:
    """Two rows of one date have no order, so a recursion over them would have no defined result."""
    if days.duplicated().any():
        raise ValueError("dates of a series must be unique")


def drift(info: np.ndarray, vec: np.ndarray, q: float) -> tuple[np.ndarray, np.ndarray]:
    """Information about the betas one step on; works for no information and for q = 0."""
    m = np.linalg.inv(np.eye(len(vec)) + q * info)
    moved = m @ info
    return (moved + moved.T) / 2.0, m @ vec


def smooth(y: np.ndarray, x: np.ndarray, q: float, h: float) -> tuple[np.ndarray, np.ndarray]:
    """Two-sided betas and their standard deviations.

    Information from the past and present meets information from the future. Both
    only ever add up, so the wide prior costs no digits.
    """
    n, k = x.shape
    seen, seen_v = np.eye(k) / PRIOR_VARIANCE, np.zeros(k)
    info, vec = np.empty((n, k, k)), np.empty((n, k))
    for t in range(n):
        if t:
            seen, seen_v = drift(seen, seen_v, q)
        seen, seen_v = seen + np.outer(x[t], x[t]) / h, seen_v + x[t] * y[t] / h
        info[t], vec[t] = seen, seen_v
    ahead, ahead_v = np.zeros((k, k)), np.zeros(k)
    for t in range(n - 2, -1, -1):
        ahead, ahead_v = drift(ahead + np.outer(x[t + 1], x[t + 1]) / h, ahead_v + x[t + 1] * y[t + 1] / h, q)
        info[t] += ahead
        vec[t] += ahead_v
    cov = np.linalg.inv(info)
    return np.einsum("tij,tj->ti", cov, vec), np.sqrt(np.einsum("tii->ti", cov))


def tvp_smooth(df: DataFrame, y: str, xs: Sequence[str], q: float, h: float, keys: Sequence[str] = KEYS,
               order: str = "date", intercept: bool = False) -> DataFrame:
    """(keys, date, y, fitted, term, beta, se, lo, hi): smoothed betas in long form with 95% bands."""
    df, xs = _with_intercept(df, xs, intercept)
    keys = list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        unique_dates(pdf[order])
        x = np.array(pdf["_x"].tolist(), float)
        beta, se = smooth(pdf["_y"].to_numpy(), x, q, h)
        out = pdf[[*keys, order]].copy()
        out["y"], out["fitted"] = pdf["_y"], (x * beta).sum(1)
        out["beta"], out["se"] = list(beta), list(se)
        return out

    schema = f"{_types(df, keys, order)}, y double, fitted double, beta array<double>, se array<double>"
    wide = _grouped(df, y, xs, keys, order).applyInPandas(run, schema)
    return bands(long_betas(wide, xs, [*keys, order, "y", "fitted"]))


def long_betas(wide: DataFrame, xs: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Array columns beta and se to one row per term."""
    terms = F.array(*[F.lit(x) for x in xs])
    z = F.arrays_zip(terms.alias("term"), F.col("beta"), F.col("se"))
    return wide.select(*ids, F.inline(z).alias("term", "beta", "se"))


def bands(df: DataFrame, z: float = 1.96) -> DataFrame:
    return df.withColumns({"lo": F.col("beta") - z * F.col("se"), "hi": F.col("beta") + z * F.col("se")})


def loglik(y: np.ndarray, x: np.ndarray, h: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Log likelihood for many (h, q) at once; one pass over the series."""
    n, k = x.shape
    m = len(h)
    b = np.zeros((m, k))
    p = np.broadcast_to(np.eye(k) * PRIOR_VARIANCE, (m, k, k)).copy()
    total = np.full(m, -0.5 * n * np.log(2 * np.pi))
    step_var = q[:, None, None] * np.eye(k)
    for t in range(n):
        if t:
            p += step_var
        px = p @ x[t]
        f = px @ x[t] + h
        v = y[t] - b @ x[t]
        total -= 0.5 * (np.log(f) + v * v / f)
        gain = px / f[:, None]
        b += gain * v[:, None]
        p -= gain[:, :, None] * px[:, None, :]
    return total


def tvp_loglik(df: DataFrame, y: str, xs: Sequence[str], variances: Sequence[tuple[float, float]], keys: Sequence[str] = KEYS,
               order: str = "date", intercept: bool = False) -> DataFrame:
    """(keys, h, q, loglik): the likelihood that ``tvp_score.tvp_mle`` searches, at given pairs of observation and step variance."""
    df, xs = _with_intercept(df, xs, intercept)
    keys = list(keys)
    h, q = np.array(variances, float).T

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        unique_dates(pdf[order])
        out = pd.DataFrame({"h": h, "q": q, "loglik": loglik(pdf["_y"].to_numpy(), np.array(pdf["_x"].tolist(), float), h, q)})
        for key in reversed(keys):
            out.insert(0, key, pdf[key].iloc[0])
        return out

    types = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keys)
    return _grouped(df, y, xs, keys, order).applyInPandas(run, f"{types}, h double, q double, loglik double")


def tvp_predictions(filtered: DataFrame, xs: Sequence[str], keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Betas known before each row (previous row's filtered betas, 0 at the start)."""
    w = Window.partitionBy(*keys).orderBy(order)
    zero = F.array(*[F.lit(0.0) for _ in xs])
    return filtered.withColumn("prior_beta", F.coalesce(F.lag("beta").over(w), zero))
