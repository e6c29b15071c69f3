"""The random-walk regression of ``tvp`` for series of any length: filter, smoother and likelihood in parallel over time.

What a stretch of rows does to the betas is one affine-Gaussian map. Given the betas before it, those at its end are
normal with mean A b + c and covariance C, and its observations weigh the betas before it by exp(v'b - b'Jb / 2). Two
neighbouring maps compose into one, and composition is associative. So

* rows are numbered along (keys, order) and cut into chunks; each chunk reduces the piece of a series that enters it
  from before or leaves it behind to one map of fixed size;
* the maps of a series are combined from both sides, at most ``FAN`` in a task, groups of groups beyond that. This gives
  the filtered betas before each chunk and the information that all later chunks hold;
* each chunk is then filtered and smoothed by itself from there.

Inside a chunk the same trick cuts a long piece into blocks that step together in numpy, so a chunk of n rows takes
about 2 sqrt(n) steps in Python. No task ever sees a whole series.

The results are those of ``tvp_filter`` and ``tvp_smooth``, whatever the length of the chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.long_series import chunked
from seriesmill.operators.regression import complete
from seriesmill.operators.tvp import KEYS, PRIOR_VARIANCE, _with_intercept, bands, long_betas
from seriesmill.session import fresh_path

ROWS_PER_CHUNK = 100_000
#: Maps of one series that are combined in one task.
FAN = 4_096


@dataclass
class Maps:
    """Maps of several stretches: (m, k, k) and (m, k) arrays. ``base`` is the log weight at zero betas."""

    a: np.ndarray
    c: np.ndarray
    cov: np.ndarray
    v: np.ndarray
    j: np.ndarray
    base: np.ndarray

    @classmethod
    def identity(cls, m: int, k: int) -> Maps:
        return cls(np.tile(np.eye(k), (m, 1, 1)), np.zeros((m, k)), np.zeros((m, k, k)), np.zeros((m, k)), np.zeros((m, k, k)), np.zeros(m))

    def at(self, i) -> Maps:
        return Maps(self.a[i], self.c[i], self.cov[i], self.v[i], self.j[i], self.base[i])

    def pack(self, i: int) -> bytes:
        return np.concatenate([x[i].ravel() for x in (self.a, self.c, self.cov, self.v, self.j)] + [[self.base[i]]]).tobytes()

    @classmethod
    def unpack(cls, rows: Sequence[bytes], k: int) -> Maps:
        flat = np.frombuffer(b"".join(rows), float).reshape(len(rows), -1)
        parts = np.split(flat, np.cumsum([k * k, k, k * k, k, k * k]), axis=1)
        return cls(*[p.reshape(-1, k, k) if p.shape[1] == k * k and n in (0, 2, 4) else p for n, p in enumerate(parts[:5])], parts[5][:, 0])


def _mv(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.einsum("...ij,...j->...i", m, v)


def _even(m: np.ndarray) -> np.ndarray:
    return (m + np.swapaxes(m, -1, -2)) / 2.0


def forward(mean: np.ndarray, cov: np.ndarray, e: Maps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normal betas before a stretch to those at its end, and the log likelihood of its observations."""
    k = mean.shape[-1]
    g = np.linalg.inv(np.eye(k) + cov @ e.j)
    post = _even(g @ cov)
    best = _mv(g, mean + _mv(cov, e.v))
    quad = 2 * np.einsum("...i,...i->...", e.v, _mv(g, mean)) - np.einsum("...i,...i->...", _mv(e.j, mean), _mv(g, mean)) + np.einsum("...i,...i->...", e.v, _mv(post, e.v))
    loglik = e.base + 0.5 * quad + 0.5 * np.linalg.slogdet(g)[1]
    return _mv(e.a, best) + e.c, _even(e.a @ post @ np.swapaxes(e.a, -1, -2) + e.cov), loglik


def backward(v: np.ndarray, j: np.ndarray, e: Maps) -> tuple[np.ndarray, np.ndarray]:
    """Information about the betas at the end of a stretch to information about those before it, its rows included."""
    k = v.shape[-1]
    g = np.linalg.inv(np.eye(k) + j @ e.cov)
    at = np.swapaxes(e.a, -1, -2)
    return e.v + _mv(at, _mv(g, v - _mv(j, e.c))), _even(e.j + at @ g @ j @ e.a)


def compose(first: Maps, then: Maps) -> Maps:
    """One map for two neighbouring stretches."""
    k = first.c.shape[-1]
    g = np.linalg.inv(np.eye(k) + first.cov @ then.j)
    through = then.a @ g
    v, j = backward(then.v, then.j, first)
    quad = 2 * np.einsum("...i,...i->...", then.v, _mv(g, first.c)) - np.einsum("...i,...i->...", _mv(then.j, first.c), _mv(g, first.c))
    quad = quad + np.einsum("...i,...i->...", then.v, _mv(_even(g @ first.cov), then.v))
    return Maps(
        through @ first.a, _mv(through, first.c + _mv(first.cov, then.v)) + then.c, _even(through @ first.cov @ np.swapaxes(then.a, -1, -2) + then.cov),
        v, j, first.base + then.base + 0.5 * quad + 0.5 * np.linalg.slogdet(g)[1],
    )


# --- stretches of rows, many at once -----------------------------------------------------------


class Blocks:
    """Consecutive stretches of rows, stepping together; the longest come first, so those still running are a prefix."""

    def __init__(self, y: np.ndarray, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.y, self.x, self.k = y, x, x.shape[1]
        self.order = np.argsort(-lengths, kind="stable")
        self.starts, self.lengths = starts[self.order], lengths[self.order]
        self.back = np.empty(len(starts), int)
        self.back[self.order] = np.arange(len(starts))

    def _running(self, t: int) -> int:
        return int(np.searchsorted(-self.lengths, -t, side="left"))

    def maps(self, q: float, h: float) -> Maps:
        e, noise = Maps.identity(len(self.starts), self.k), np.eye(self.k) * q
        for t in range(int(self.lengths[0]) if len(self.lengths) else 0):
            m = self._running(t)
            rows = self.starts[:m] + t
            x = self.x[rows]
            p = e.cov[:m] + noise
            px = _mv(p, x)
            f = np.einsum("mi,mi->m", x, px) + h
            gone = np.einsum("mji,mj->mi", e.a[:m], x)  # what the observation sees of the betas before
            miss = self.y[rows] - np.einsum("mi,mi->m", x, e.c[:m])
            e.v[:m] += gone * (miss / f)[:, None]
            e.j[:m] += gone[:, :, None] * (gone / f[:, None])[:, None, :]
            e.base[:m] -= 0.5 * (np.log(2 * np.pi * f) + miss * miss / f)
            gain = px / f[:, None]
            e.a[:m] -= gain[:, :, None] * gone[:, None, :]
            e.c[:m] += gain * miss[:, None]
            e.cov[:m] = _even(p - gain[:, :, None] * px[:, None, :])
        return e.at(self.back)

    def filter(self, mean: np.ndarray, cov: np.ndarray, q: float, h: float, keep_cov: bool = False) -> dict[str, np.ndarray]:
        """Innovations, their variances, betas and deviations of all rows, from the betas before each stretch."""
        n, k = self.x.shape
        b, p = mean[self.order].copy(), cov[self.order].copy()
        out = {"innov": np.empty(n), "innov_var": np.empty(n), "beta": np.empty((n, k)), "se": np.empty((n, k))}
        if keep_cov:
            out["cov"] = np.empty((n, k, k))
        noise = np.eye(k) * q
        for t in range(int(self.lengths[0]) if len(self.lengths) else 0):
            m = self._running(t)
            rows = self.starts[:m] + t
            x = self.x[rows]
            p[:m] += noise
            px = _mv(p[:m], x)
            miss = self.y[rows] - np.einsum("mi,mi->m", x, b[:m])
            f = np.einsum("mi,mi->m", x, px) + h
            gain = px / f[:, None]
            b[:m] += gain * miss[:, None]
            p[:m] -= gain[:, :, None] * px[:, None, :]
            out["innov"][rows], out["innov_var"][rows], out["beta"][rows] = miss, f, b[:m]
            out["se"][rows] = np.sqrt(np.maximum(np.einsum("mii->mi", p[:m]), 0.0))
            if keep_cov:
                out["cov"][rows] = p[:m]
        return out

    def ahead(self, v: np.ndarray, j: np.ndarray, q: float, h: float) -> tuple[np.ndarray, np.ndarray]:
        """What the rows after each row tell about its betas, from what the rows after its stretch tell."""
        n, k = self.x.shape
        v, j = v[self.order].copy(), j[self.order].copy()
        all_v, all_j, eye = np.empty((n, k)), np.empty((n, k, k)), np.eye(k)
        for t in range(int(self.lengths[0]) if len(self.lengths) else 0):
            m = self._running(t)
            rows = self.starts[:m] + self.lengths[:m] - 1 - t
            x = self.x[rows]
            all_v[rows], all_j[rows] = v[:m], j[:m]
            seen_j = j[:m] + x[:, :, None] * x[:, None, :] / h
            seen_v = v[:m] + x * (self.y[rows] / h)[:, None]
            g = np.linalg.inv(eye + q * seen_j)
            j[:m], v[:m] = _even(g @ seen_j), _mv(g, seen_v)
        return all_v, all_j


def smoothed(beta: np.ndarray, cov: np.ndarray, v: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filtered betas met with what comes after them: means and deviations."""
    g = np.linalg.inv(np.eye(beta.shape[1]) + cov @ j)
    return _mv(g, beta + _mv(cov, v)), np.sqrt(np.maximum(np.einsum("nii->ni", g @ cov), 0.0))


def prior(k: int, q: float) -> tuple[np.ndarray, np.ndarray]:
    """Betas before the first row: the step that each row begins with brings them to the wide prior."""
    return np.zeros(k), np.eye(k) * (PRIOR_VARIANCE - q)


class Pieces:
    """The series, or pieces of series, that a chunk holds, cut into blocks of about the root of their length."""

    def __init__(self, y: np.ndarray, x: np.ndarray, starts: np.ndarray, q: float, h: float):
        self.n, self.k, self.q, self.h, self.starts = len(y), x.shape[1], q, h, starts
        lengths = np.diff(np.append(starts, self.n))
        size = np.maximum(np.ceil(np.sqrt(lengths)).astype(int), 16)
        counts = -(-lengths // size)
        self.first = np.cumsum(counts) - counts  # first block of each piece
        self.counts = counts
        nth = np.arange(int(counts.sum())) - np.repeat(self.first, counts)
        begins = np.repeat(starts, counts) + nth * np.repeat(size, counts)
        ends = np.minimum(begins + np.repeat(size, counts), np.repeat(starts + lengths, counts))
        self.blocks = Blocks(y, x, begins, ends - begins)
        self._maps: Maps | None = None

    @property
    def maps(self) -> Maps:
        if self._maps is None:
            self._maps = self.blocks.maps(self.q, self.h)
        return self._maps

    def whole(self, piece: int) -> Maps:
        """The map of one piece."""
        at = self.first[piece]
        out = self.maps.at(slice(at, at + 1))
        for b in range(at + 1, at + self.counts[piece]):
            out = compose(out, self.maps.at(slice(b, b + 1)))
        return out

    def before(self, entering: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Betas before each block; ``entering`` has those of pieces that go on from earlier chunks."""
        mean, cov = (np.tile(p, (int(self.counts.sum()), *[1] * p.ndim)) for p in prior(self.k, self.q))
        for piece in set(entering) | set(np.flatnonzero(self.counts > 1).tolist()):
            at = self.first[piece]
            if piece in entering:
                mean[at], cov[at] = entering[piece]
            for b in range(at, at + self.counts[piece] - 1):
                mean[b + 1], cov[b + 1], _ = forward(mean[b], cov[b], self.maps.at(b))
        return mean, cov

    def after(self, leaving: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """What comes after each block tells; ``leaving`` has what later chunks tell about pieces that go on there."""
        m = int(self.counts.sum())
        v, j = np.zeros((m, self.k)), np.zeros((m, self.k, self.k))
        for piece in set(leaving) | set(np.flatnonzero(self.counts > 1).tolist()):
            at = self.first[piece] + self.counts[piece] - 1
            if piece in leaving:
                v[at], j[at] = leaving[piece]
            for b in range(at, self.first[piece], -1):
                v[b - 1], j[b - 1] = backward(v[b], j[b], self.maps.at(b))
        return v, j


# --- on Spark ------------------------------------------------------------------------------------


def _chunks(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str], order: Sequence[str], rows_per_chunk: int) -> DataFrame:
    """Complete rows in chunks, each with a copy of the row before it."""
    rows = df.filter(complete([y, *xs])).select(*keys, *order, F.col(y).cast("double").alias("_y"), *[F.col(x).cast("double").alias(f"_x{i}") for i, x in enumerate(xs)])
    return chunked(rows, keys, order, halo=1, rows_per_chunk=rows_per_chunk)


def _cut(pdf: pd.DataFrame, keys: Sequence[str], order: Sequence[str], k: int):
    """The rows of a chunk in order, the first row of each piece, and whether the first piece goes on from before."""
    pdf = pdf.sort_values("_pos", kind="stable").reset_index(drop=True)
    other = np.zeros(max(len(pdf) - 1, 0), bool)
    for c in keys:
        codes = pd.factorize(pdf[c], use_na_sentinel=False)[0]
        other |= codes[1:] != codes[:-1]
    same = ~other
    for c in order:
        codes = pd.factorize(pdf[c], use_na_sentinel=False)[0]
        same &= codes[1:] == codes[:-1]
    if same.any():
        raise ValueError("dates of a series must be unique")
    skip = int(not pdf["_own"].iloc[0])
    goes_on = bool(skip and not other[0]) if len(pdf) > skip else False
    new = np.concatenate([[True], other])[skip:]
    new[:1] = True
    pdf = pdf.iloc[skip:].reset_index(drop=True)
    x = np.column_stack([pdf[f"_x{i}"].to_numpy(float) for i in range(k)])
    return pdf, np.flatnonzero(new), goes_on, pdf["_y"].to_numpy(float), x


def _types(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def border_maps(chunks: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, q: float, h: float) -> DataFrame:
    """(keys, _chunk, _start, n, map): maps of the first and the last piece of each chunk; others begin and end inside it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = pdf["_chunk"].iloc[0]
        pdf, starts, _, y, x = _cut(pdf, keys, order, k)
        if not len(pdf):
            return pd.DataFrame(columns=[*keys, "_chunk", "_start", "n", "map"])
        pieces = Pieces(y, x, starts, q, h)
        ends = np.append(starts[1:], len(pdf))
        at = sorted({0, len(starts) - 1})
        out = pdf.iloc[starts[at]][list(keys)].reset_index(drop=True)
        out["_chunk"], out["_start"] = chunk, pdf["_pos"].to_numpy()[starts[at]]
        out["n"], out["map"] = (ends - starts)[at], [pieces.whole(p).pack(0) for p in at]
        return out

    return chunks.groupBy("_chunk").applyInPandas(run, f"{_types(chunks, keys)}, _chunk bigint, _start bigint, n bigint, map binary")


def _same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = b.withColumnsRenamed({c: f"_of_{c}" for c in keys})
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return a.join(named, cond).drop(*[f"_of_{c}" for c in keys])


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def borders(maps: DataFrame, keys: Sequence[str], k: int, q: float, fan: int = FAN) -> DataFrame:
    """(keys, _chunk, _start, mean, cov, v, j, loglik): betas before each piece, what the rows after it tell, and the log
    likelihood of its rows given those before. ``maps`` is stored; a task combines ``fan`` maps of a series at most."""
    keys = list(keys)
    types = _types(maps, keys)
    state = "mean binary, cov binary, v binary, j binary"
    most = maps.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    grouped = maps.withColumn("_group", F.floor(F.col("_chunk") / fan) if most > fan else F.lit(0).cast("bigint"))
    if most > fan:

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_chunk")
            each = Maps.unpack(pdf["map"].tolist(), k)
            out = each.at(slice(0, 1))
            for i in range(1, len(pdf)):
                out = compose(out, each.at(slice(i, i + 1)))
            row = pdf.iloc[:1][[*keys, "_group", "_start"]].copy()
            row["n"], row["map"] = pdf["n"].sum(), [out.pack(0)]
            return row.rename(columns={"_group": "_chunk"})

        above = _stored(grouped.groupBy(*keys, "_group").applyInPandas(whole, f"{types}, _chunk bigint, _start bigint, n bigint, map binary"), "maps")
        ends = borders(above, keys, k, q, fan).select(*keys, F.col("_chunk").alias("_group"), "mean", "cov", "v", "j")
        grouped = _same_keys(grouped, ends, [*keys, "_group"])
    else:
        mean, cov = prior(k, q)
        zero = np.zeros(k).tobytes(), np.zeros((k, k)).tobytes()
        grouped = grouped.withColumns({c: F.lit(bytearray(b)) for c, b in zip(("mean", "cov", "v", "j"), (mean.tobytes(), cov.tobytes(), *zero))})

    def sweep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk").reset_index(drop=True)
        each = Maps.unpack(pdf["map"].tolist(), k)
        mean, cov, v, j = (np.frombuffer(pdf[c].iloc[0], float) for c in ("mean", "cov", "v", "j"))
        cov, j = cov.reshape(k, k), j.reshape(k, k)
        rows: list[list] = []
        for i in range(len(pdf)):
            here = [mean.tobytes(), cov.tobytes(), None, None]
            mean, cov, loglik = forward(mean, cov, each.at(i))
            rows.append([*here, float(loglik)])
        for i in range(len(pdf) - 1, -1, -1):
            rows[i][2], rows[i][3] = v.tobytes(), j.tobytes()
            v, j = backward(v, j, each.at(i))
        out = pdf[[*keys, "_chunk", "_start"]].copy()
        for c, values in zip(("mean", "cov", "v", "j", "loglik"), zip(*rows)):
            out[c] = list(values)
        return out

    return grouped.groupBy(*keys, "_group").applyInPandas(sweep, f"{types}, _chunk bigint, _start bigint, {state}, loglik double")


def _prepared(df, y, xs, q, h, keys, order, intercept, rows_per_chunk, fan):
    df, xs = _with_intercept(df, xs, intercept)
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    chunks = _chunks(df, y, xs, keys, order, rows_per_chunk)
    maps = _stored(border_maps(chunks, keys, order, len(xs), q, h), "maps")
    return chunks, maps, xs, keys, order


def _walk(chunks: DataFrame, ends: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, q: float, h: float, smooth: bool) -> DataFrame:
    """All rows of all chunks, each chunk from what its borders bring."""

    def run(pdf: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, *order, "y", *(("fitted", "beta", "se") if smooth else ("innov", "innov_var", "beta", "se"))]
        if not len(pdf):
            return pd.DataFrame(columns=names)
        pdf, starts, goes_on, y, x = _cut(pdf, keys, order, k)
        if not len(pdf):
            return pd.DataFrame(columns=names)
        pieces = Pieces(y, x, starts, q, h)
        first_pos = pdf["_pos"].to_numpy()[starts]
        entering, leaving = {}, {}
        for start, *state in zip(ends["_start"], ends["mean"], ends["cov"], ends["v"], ends["j"]):
            piece = int(np.searchsorted(first_pos, start))
            mean, cov, v, j = (np.frombuffer(s, float) for s in state)
            if piece == 0 and goes_on:
                entering[piece] = mean, cov.reshape(k, k)
            if piece == len(starts) - 1:
                leaving[piece] = v, j.reshape(k, k)
        found = pieces.blocks.filter(*pieces.before(entering), q, h, keep_cov=smooth)
        out = pdf[[*keys, *order]].assign(y=y)
        if smooth:
            beta, se = smoothed(found["beta"], found["cov"], *pieces.blocks.ahead(*pieces.after(leaving), q, h))
            out["fitted"], out["beta"], out["se"] = (x * beta).sum(1), list(beta), list(se)
        else:
            out["innov"], out["innov_var"], out["beta"], out["se"] = found["innov"], found["innov_var"], list(found["beta"]), list(found["se"])
        return out[names]

    numbers = "y double, fitted double" if smooth else "y double, innov double, innov_var double"
    schema = f"{_types(chunks, [*keys, *order])}, {numbers}, beta array<double>, se array<double>"
    return chunks.groupBy("_chunk").cogroup(ends.groupBy("_chunk")).applyInPandas(run, schema)


def long_tvp_filter(df: DataFrame, y: str, xs: Sequence[str], q: float, h: float, keys: Sequence[str] = KEYS, order: str | Sequence[str] = "date",
                    intercept: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK, fan: int = FAN) -> DataFrame:
    """As ``tvp_filter``: (keys, order, y, innov, innov_var, beta[], se[]), for series that no task can hold."""
    chunks, maps, xs, keys, order = _prepared(df, y, xs, q, h, keys, order, intercept, rows_per_chunk, fan)
    return _walk(chunks, borders(maps, keys, len(xs), q, fan), keys, order, len(xs), q, h, smooth=False)


def long_tvp_smooth(df: DataFrame, y: str, xs: Sequence[str], q: float, h: float, keys: Sequence[str] = KEYS, order: str | Sequence[str] = "date",
                    intercept: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK, fan: int = FAN) -> DataFrame:
    """As ``tvp_smooth``: (keys, order, y, fitted, term, beta, se, lo, hi), for series that no task can hold."""
    chunks, maps, xs, keys, order = _prepared(df, y, xs, q, h, keys, order, intercept, rows_per_chunk, fan)
    wide = _walk(chunks, borders(maps, keys, len(xs), q, fan), keys, order, len(xs), q, h, smooth=True)
    return bands(long_betas(wide, xs, [*keys, *order, "y", "fitted"]))


def long_tvp_loglik(df: DataFrame, y: str, xs: Sequence[str], q: float, h: float, keys: Sequence[str] = KEYS, order: str | Sequence[str] = "date",
                    intercept: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK, fan: int = FAN) -> DataFrame:
    """(keys, n, loglik): the log likelihood of each series, added up from maps alone; rows are read once."""
    df, xs = _with_intercept(df, xs, intercept)
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    chunks, k = _chunks(df, y, xs, keys, order, rows_per_chunk), len(xs)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = pdf["_chunk"].iloc[0]
        pdf, starts, _, y, x = _cut(pdf, keys, order, k)
        pieces = Pieces(y, x, starts, q, h)
        out = pdf.iloc[starts][keys].reset_index(drop=True)
        out["_chunk"], out["_start"], out["n"] = chunk, pdf["_pos"].to_numpy()[starts], np.diff(np.append(starts, len(pdf)))
        out["map"] = [pieces.whole(p).pack(0) for p in range(len(starts))]
        return out

    maps = _stored(chunks.groupBy("_chunk").applyInPandas(run, f"{_types(chunks, keys)}, _chunk bigint, _start bigint, n bigint, map binary"), "maps")
    per = _same_keys(borders(maps, keys, k, q, fan).select(*keys, "_chunk", "loglik"), maps.select(*keys, "_chunk", "n"), [*keys, "_chunk"])
    return per.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("loglik").alias("loglik"))
