"""Moving co-moments with constant work per row, whatever the length of the window.

A sequence is cut into blocks as long as the window. Inside each block running summaries (count, means, centred cross
products) are kept from its front and from its back; a window is the back of one block and the front of the next, so one
merge of two summaries gives it. Summaries only ever grow or merge around means: nothing is subtracted, so nothing
cancels, and a window is not read again for each row.

All blocks of an Arrow batch step together in numpy. Rows stream through their sorted partition, which keeps those that the
next ones still look back on. Series at date grain come whole; sequences without a bound come in chunks with copied
borders. No task holds a series or a chunk: what it holds depends on the window only, not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.long_series import ROWS_PER_CHUNK, chunked
from seriesmill.operators.regression import KEYS, _fit, full_matrix

#: Means and cross products (upper triangle) of the full windows, their rows' values, and which rows have a full window.
Use = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]]
#: Blocks that step together, so that a step is worth its call, and the rows that are enough for that however long a block is.
ABREAST, ROWS_AT_ONCE = 64, 100_000


def _runs(x: np.ndarray, first: np.ndarray, lengths: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Running means and cross products along blocks that go from ``first`` forwards or backwards; longest block first."""
    i, j = np.triu_indices(x.shape[1])
    mean, s = np.empty_like(x), np.empty((len(x), len(i)))
    m, c = np.zeros((len(first), x.shape[1])), np.zeros((len(first), len(i)))
    for t in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -t, side="left"))
        rows = first[:live] + step * t
        off = x[rows] - m[:live]
        m[:live] += off / (t + 1)
        c[:live] += off[:, i] * (x[rows] - m[:live])[:, j]
        mean[rows], s[rows] = m[:live], c[:live]
    return mean, s


def windows(x: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, means, cross products): every row that ends a window of ``n`` rows of its series, and the window's summary."""
    lengths = np.diff(np.append(starts, len(x)))
    level = np.repeat(x[starts], lengths, axis=0)
    x = x - level  # a high level costs no digits of the deviations
    counts = -(-lengths // n)
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.repeat(starts, counts) + nth * n
    size = np.minimum(n, np.repeat(starts + lengths, counts) - first)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    front_m, front_s = _runs(x, first, size, 1)
    whole = size == n
    back_m, back_s = _runs(x, first[whole] + n - 1, size[whole], -1)
    pos = np.arange(len(x)) - np.repeat(starts, lengths)
    ends = np.flatnonzero(pos >= n - 1)
    new = (pos[ends] % n + 1).astype(float)  # rows of the window in the block of its end
    mean, s = front_m[ends], front_s[ends]
    both = np.flatnonzero(new < n)
    at = ends[both] - n + 1
    a, b = n - new[both], new[both]
    off = mean[both] - back_m[at]
    mean[both] = back_m[at] + off * (b / n)[:, None]
    i, j = np.triu_indices(x.shape[1])
    s[both] += back_s[at] + off[:, i] * off[:, j] * (a * b / n)[:, None]
    return ends, mean + level[ends], s


def _holes(bad: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Missing values in each window, by column."""
    upto = np.vstack([np.zeros((1, bad.shape[1]), int), np.cumsum(bad, axis=0)])
    return upto[ends + 1] - upto[ends + 1 - n]


def _looked_at(pdf: pd.DataFrame, x: np.ndarray, starts: np.ndarray, n: int, lag: int, use: Use) -> dict[str, np.ndarray]:
    """Runs ``use`` on the windows that end ``lag`` rows before each row; windows with a missing value are NaN where it counts."""
    bad = np.isnan(x)
    ends, mean, s = windows(np.where(bad, 0.0, x), starts, n)
    missing = _holes(bad, ends, n) > 0
    i, j = np.triu_indices(x.shape[1])
    mean[missing], s[missing[:, i] | missing[:, j]] = np.nan, np.nan
    series = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
    rows = ends + lag
    ok = rows < len(x)
    ok[ok] = series[rows[ok]] == series[ends[ok]]
    return use(mean[ok], s[ok], x[rows[ok]], rows[ok])


def _at_least(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches joined until they hold so many rows."""
    parts, size = [], 0
    for pdf in batches:
        if len(pdf):
            parts.append(pdf)
            size += len(pdf)
        if parts and size >= rows:
            joined, parts, size = pd.concat(parts, ignore_index=True), [], 0
            yield joined
    if parts:
        yield pd.concat(parts, ignore_index=True)


def moving(df: DataFrame, cols: Sequence[str], n: int, use: Use, out: Sequence[str], keys: Sequence[str] = KEYS, order: str | Sequence[str] = "date",
           lag: int = 0, keep: Sequence[str] = (), rows_per_chunk: int | None = None) -> DataFrame:
    """(keys, order, keep, out): what ``use`` makes of the summary of each window of ``n`` rows; null before a full one.

    ``lag`` 0: the window ends with the row itself, 1: with the row before. ``rows_per_chunk``: for sequences that no
    task shall read whole; without it a series is one run of rows in one task. Either way a
    task holds a batch and two windows, or a batch, a window and at most ``ROWS_AT_ONCE`` rows where that is more.
    """
    keys, order, keep, cols, out = list(keys), [order] if isinstance(order, str) else list(order), list(keep), list(cols), list(out)
    rows = df.select(*keys, *order, *keep, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    ids = [*keys, *order, *keep]
    run = keys if rows_per_chunk is None else ["_chunk", *keys]
    back = n - 1 + lag
    least = max(back, min(ABREAST * n, ROWS_AT_ONCE))  # of new rows: what is looked back on is computed at most twice
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ids] + [f"`{c}` double" for c in out])

    def values(pdf: pd.DataFrame) -> np.ndarray:
        return np.column_stack([pdf[f"_v{i}"].to_numpy(float) for i in range(len(cols))])

    def starts_of(pdf: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(pdf), bool)
        new[:1] = True
        for c in run:
            codes = pd.factorize(pdf[c], use_na_sentinel=False)[0]
            new[1:] |= codes[1:] != codes[:-1]
        return np.flatnonzero(new)

    def with_results(pdf: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        results = {c: np.full(len(pdf), np.nan) for c in out}

        def place(mean, s, x, at):
            for c, v in use(mean, s, x, at).items():
                results[c][at] = v
            return results

        _looked_at(pdf, values(pdf), starts_of(pdf), n, lag, place)
        return pdf.loc[own, ids].assign(**{c: v[own] for c, v in results.items()})

    def in_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in _at_least(batches, least):
            before = 0 if held is None else len(held)
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            own = np.arange(len(pdf)) >= before
            yield with_results(pdf, own if rows_per_chunk is None else own & pdf["_own"].to_numpy(bool))
            last = max(int(starts_of(pdf)[-1]), len(pdf) - back)
            held = pdf.iloc[last:].reset_index(drop=True) if last < len(pdf) else None

    if rows_per_chunk is None:
        ordered = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    else:
        ordered = chunked(rows, keys, order, back, rows_per_chunk).repartition("_chunk").sortWithinPartitions("_chunk", "_pos")
    return ordered.mapInPandas(in_partition, schema)


# --- uses ----------------------------------------------------------------------------------------


def moving_stats(df: DataFrame, n: int, value: str = "value", keys=KEYS, order="date", keep: Sequence[str] = (), rows_per_chunk: int | None = None) -> DataFrame:
    """Mean, standard deviation and z-score over the last ``n`` rows, the row itself included: roll_mean, roll_std, z."""

    def use(mean, s, x, _):
        std = np.sqrt(s[:, 0] / (n - 1)) if n > 1 else np.full(len(s), np.nan)
        with np.errstate(all="ignore"):
            return {"roll_mean": mean[:, 0], "roll_std": std, "z": np.where(std > 0, (x[:, 0] - mean[:, 0]) / std, np.nan)}

    return moving(df, [value], n, use, ["roll_mean", "roll_std", "z"], keys, order, 0, [value, *keep], rows_per_chunk)


def moving_corr(df: DataFrame, n: int, y: str, xs: Sequence[str], keys=KEYS, order="date", rows_per_chunk: int | None = None) -> DataFrame:
    """Correlation of ``y`` with each of ``xs`` over the last ``n`` rows; one missing value only hides its own pair."""
    k = len(xs) + 1
    i, j = np.triu_indices(k)
    own = {int(a): at for at, (a, b) in enumerate(zip(i, j)) if a == b}

    def use(mean, s, x, _):
        with np.errstate(all="ignore"):
            return {f"corr_{c}": np.clip(np.where(s[:, own[0]] * s[:, own[m]] > 0, s[:, m] / np.sqrt(s[:, own[0]] * s[:, own[m]]), np.nan), -1.0, 1.0) for m, c in enumerate(xs, 1)}

    return moving(df, [y, *xs], n, use, [f"corr_{c}" for c in xs], keys, order, 0, (), rows_per_chunk)


def moving_ols(df: DataFrame, n: int, y: str, xs: Sequence[str], keys=KEYS, order="date", rows_per_chunk: int | None = None) -> DataFrame:
    """Coefficients and R2 over the ``n`` rows before each row, and its out-of-sample residual.

    The window leaves out the current row, so the residual is a real forecast error. A window with a missing value
    gives nulls, as do rows before a full window.
    """
    k = len(xs) + 1

    def use(mean, s, x, _):
        names = ["intercept", *[f"beta_{c}" for c in xs], "r2", "oos_resid"]
        full = np.isfinite(s).all(1)
        out = {c: np.full(len(s), np.nan) for c in names}
        if full.any():
            fit = _fit(np.full(int(full.sum()), float(n)), mean[full], full_matrix(s[full], k))
            for at, c in enumerate(names[:k]):
                out[c][full] = fit["coef"][:, at]
            out["r2"][full] = fit["r2"]
            out["oos_resid"][full] = x[full, 0] - fit["coef"][:, 0] - (x[full, 1:] * fit["coef"][:, 1:]).sum(1)
        return out

    return moving(df, [y, *xs], n, use, ["intercept", *[f"beta_{c}" for c in xs], "r2", "oos_resid"], keys, order, 1, (), rows_per_chunk)
