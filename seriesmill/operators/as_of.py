"""Sequences without a bound that look back: the quote in force, and the last value as large.

Rows are numbered along (keys, time) by one range sort and cut into chunks of equal length (``long_series``). What a
chunk needs from the ones before it is small: the last quote of the key that enters it, or the values that nothing
later has covered. No task sees a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.long_series import ROWS_PER_CHUNK, chunked
from seriesmill.session import fresh_path


def as_of_join(rows: DataFrame, quotes: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], quote_time: str | None = None,
               tolerance=None, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``rows`` with the ``values`` of the latest quote of their key at or before their time, and its time (``quote_time``).

    Nulls before the first quote, where the quote is older than ``tolerance`` (an interval, or a number for numeric
    times), and for rows without a key or a time: as in a join, nothing equals null. Quotes without a key or a time are
    ignored, as are those whose values are all null. Of quotes of one time the one with the largest values counts.
    Repeated rows stay repeated; a key of any size is spread over tasks.
    """
    keys, values = list(keys), list(values)
    there = F.lit(False)
    for v in values:
        there = there | F.col(v).isNotNull()
    for c in [*keys, time]:
        there = there & F.col(c).isNotNull()
    quote = F.struct(F.col(time).alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    given = quotes.where(there).select(*keys, F.col(time).alias("_time"), quote.alias("_quote"), F.lit(None).cast(rows.schema).alias("_row"))
    asked = rows.select(*keys, F.col(time).alias("_time"), F.lit(None).cast(given.schema["_quote"].dataType).alias("_quote"), F.struct(*rows.columns).alias("_row"))
    both = given.unionByName(asked).withColumn("_asks", F.col("_row").isNotNull())
    order = ["_time", "_asks", "_quote"]  # a quote of the same time counts already
    c = chunked(both, keys, order, rows_per_chunk=rows_per_chunk)
    upto = Window.partitionBy("_chunk", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = c.withColumn("_known", F.last("_quote", ignorenulls=True).over(upto))
    # The last quote of each key in each chunk; a key has one row per chunk it reaches into.
    ends = c.groupBy("_chunk", *keys).agg(F.max_by("_quote", F.when(~F.col("_asks"), F.col("_pos"))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).where("_carried IS NOT NULL").drop("_last")
    known = inside.where("_asks").join(carried, ["_chunk", *keys], "left").withColumn("_known", F.coalesce("_known", "_carried"))
    usable = F.col("_time").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    if tolerance is not None:
        usable = usable & (F.col("_known.at") >= F.col("_time") - tolerance)
    known = known.withColumn("_known", F.when(usable, F.col("_known")))
    stamp = [F.col("_known.at").alias(quote_time)] if quote_time else []
    return known.select(*[F.col("_row")[f].alias(f) for f in rows.columns], *[F.col("_known")[f"v{i}"].alias(v) for i, v in enumerate(values)], *stamp)


def convert_as_of(rows: DataFrame, quotes: DataFrame, divisor: float, keys: Sequence[str], time: str, value: str = "value", rate: str = "rate",
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """value x rate / divisor with the rate in force at the time of the row; null before the first rate."""
    return as_of_join(rows, quotes, keys, time, [rate], rows_per_chunk=rows_per_chunk).withColumn("converted", F.col(value) * F.col(rate) / divisor)


# --- the last value as large ---------------------------------------------------------------------


def previous_at_least(values: np.ndarray) -> np.ndarray:
    """Position of the last earlier value at least as large, -1 for none: a stack of the values nothing later has covered."""
    out, stack, v = np.full(len(values), -1, "i8"), [], values.tolist()
    for i, x in enumerate(v):
        while stack and v[stack[-1]] < x:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


def skyline(values: np.ndarray) -> np.ndarray:
    """Positions of the values above all later ones, the last first: so values rise."""
    back = values[::-1]
    top = np.maximum.accumulate(back)
    new = np.concatenate([[True], back[1:] > top[:-1]]) if len(back) else np.zeros(0, bool)
    return len(values) - 1 - np.flatnonzero(new)


def slices_wanted(chunks: Sequence[int], firsts: Sequence[float], tops: Sequence[float]) -> list[tuple[int, int, float, float]]:
    """(chunk, earlier chunk, lo, hi): which values of which earlier skylines the open points of each chunk look for.

    The chunks of one key come in order with their first value and their maximum. A stack keeps the chunks whose maximum
    is above all later ones; each chunk looks at those it then removes and at one more, so there are fewer than two
    slices per chunk, and the slices of one skyline do not overlap.
    """
    out, stack = [], []
    for chunk, first, top in zip(chunks, firsts, tops):
        low = first
        while stack:
            there, height = stack[-1]
            if height >= low:
                out.append((chunk, there, low, min(height, top)))
                low = np.nextafter(height, np.inf)
            if height > top:
                break
            stack.pop()
        stack.append((chunk, top))
    return [s for s in out if s[2] <= s[3]]


def last_as_large(df: DataFrame, value: str = "value", keys: Sequence[str] = ("series_id",), order: str | Sequence[str] = "date",
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Every available point with the last earlier one of its key at least as large: ``since`` (its first order column) and
    ``since_value``; null for a record. Points without a number have no row.

    A monotone stack answers most points inside their chunk. What stays open are running records of the piece that enters
    from before. Of each chunk only its first value and its maximum go to one place per key, where a stack of chunks tells
    which earlier skylines the records meet; those skylines send the few values asked for.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    number = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(number)).select(*df.columns, number.alias("_v"))
    stamp, kind, own_columns = order[0], df.schema[order[0]].dataType.simpleString(), list(df.columns)
    c = chunked(rows, keys, order, rows_per_chunk=rows_per_chunk)

    def types(cols: Sequence[str]) -> str:
        return ", ".join(f"`{x}` {df.schema[x].dataType.simpleString()}" for x in cols)

    def pieces(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        pdf = pdf.sort_values("_pos", kind="stable").reset_index(drop=True)
        new = np.zeros(len(pdf), bool)
        new[:1] = True
        for k in keys:
            codes = pd.factorize(pdf[k], use_na_sentinel=False)[0]
            new[1:] |= codes[1:] != codes[:-1]
        return pdf, np.flatnonzero(new)

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, starts = pieces(pdf)
        at = sorted({0, len(starts) - 1})
        v = pdf["_v"].to_numpy(float)
        out = pdf.iloc[starts[at]][[*keys, "_chunk"]].reset_index(drop=True)
        return out.assign(first=v[starts[at]], top=np.maximum.reduceat(v, starts)[at])

    def want(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        return pd.DataFrame(slices_wanted(pdf["_chunk"].tolist(), pdf["first"].tolist(), pdf["top"].tolist()), columns=["_to", "_chunk", "lo", "hi"])

    def cut(pdf: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        columns = ["_chunk", "heights", "stamps"]
        if not len(wanted) or not len(pdf):
            return pd.DataFrame(columns=columns)
        pdf, starts = pieces(pdf)
        own = pdf.iloc[starts[-1] :]
        v = own["_v"].to_numpy(float)
        at = skyline(v)
        heights, when = v[at], own[stamp].iloc[at].reset_index(drop=True)
        out = []
        for to, lo, hi in zip(wanted["_to"], wanted["lo"], wanted["hi"]):
            a, b = np.searchsorted(heights, lo), np.searchsorted(heights, hi) + 1
            out.append((to, heights[a:b].tolist(), when.iloc[a:b].tolist()))
        return pd.DataFrame(out, columns=columns)

    def answer(pdf: pd.DataFrame, slices: pd.DataFrame) -> pd.DataFrame:
        columns = [*own_columns, "since", "since_value"]
        if not len(pdf):
            return pd.DataFrame(columns=columns)
        pdf, starts = pieces(pdf)
        v, stops = pdf["_v"].to_numpy(float), np.append(starts[1:], len(pdf))
        at = np.concatenate([np.where(own >= 0, own + a, -1) for a, own in ((a, previous_at_least(v[a:b])) for a, b in zip(starts, stops))])
        since, height = pdf[stamp].iloc[np.maximum(at, 0)].reset_index(drop=True), np.where(at >= 0, v[np.maximum(at, 0)], np.nan)
        since = since.astype(object).where(at >= 0, None)
        if len(slices):
            heights, when = np.concatenate(slices["heights"].tolist()), [x for part in slices["stamps"] for x in part]
            # The last point as large is the lowest as large: on the skylines higher means earlier.
            rising = np.argsort(heights, kind="stable")
            heights = heights[rising]
            for i in np.flatnonzero(at[: stops[0]] < 0):
                k = int(np.searchsorted(heights, v[i]))
                if k < len(heights):
                    since.iloc[i], height[i] = when[rising[k]], heights[k]
        return pdf[own_columns].assign(since=since, since_value=height)

    borders = c.groupBy("_chunk").applyInPandas(ends, f"{types(keys)}, _chunk bigint, first double, top double")
    path = fresh_path(df.sparkSession, "as-large")
    borders.groupBy(*keys).applyInPandas(want, "_to bigint, _chunk bigint, lo double, hi double").write.parquet(path)
    wanted = df.sparkSession.read.schema("_to bigint, _chunk bigint, lo double, hi double").parquet(path)
    slices = c.groupBy("_chunk").cogroup(wanted.groupBy("_chunk")).applyInPandas(cut, f"_chunk bigint, heights array<double>, stamps array<{kind}>")
    return c.groupBy("_chunk").cogroup(slices.groupBy("_chunk")).applyInPandas(answer, f"{types(df.columns)}, since {kind}, since_value double")
