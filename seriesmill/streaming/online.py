"""Online time-varying regression: one-step innovations as days complete."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from seriesmill.operators.tvp import start, step
from seriesmill.sources.tables import mean_of, scaled
from seriesmill.streaming.engine import use_rocksdb

DELAY = "1 hour"


def daily_pairs(ticks: DataFrame, delay: str = DELAY, decimals: int = 8) -> DataFrame:
    """Daily means per asset: (asset, date, y, x). Batch or stream; a day is released once the watermark has passed it.

    Sums are taken over whole numbers of the feed's smallest step, ``decimals`` places, so they do not depend on the
    order of arrival; the default keeps eight places of values below about 90 billion. Sums have 38 digits, enough for any day.
    """
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    g = t.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("w"), "asset")
    whole = lambda c: F.sum(scaled(F.col(c), decimals).cast("decimal(38,0)"))
    agg = g.agg(whole("price").alias("p"), whole("k").alias("k"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        "asset", F.col("w.start").cast("date").alias("date"), mean_of(F.col("p"), F.col("n"), decimals).alias("y"),
        mean_of(F.col("k"), F.col("n"), decimals).alias("x"),
    )


class InnovationProcessor(StatefulProcessor):
    """Carries the betas and their covariance of one series from batch to batch."""

    def __init__(self, xs: Sequence[str], q: float, h: float):
        self.xs, self.q, self.h = list(xs), q, h

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "b array<double>, p array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        k = len(self.xs)
        days = pd.concat(list(rows)).sort_values("date")
        seen = self.state.exists()
        if seen:
            b, p = (np.array(v, float) for v in self.state.get())
            p = p.reshape(k, k)
        else:
            b, p = start(k)
        out = []
        for y, x in zip(days["y"].to_numpy(float), days[self.xs].to_numpy(float)):
            if seen:
                p = p + np.eye(k) * self.q
            seen = True
            v, _, b, p = step(b, p, x, y, self.h)
            out.append((v, b.tolist()))
        self.state.update((b.tolist(), p.ravel().tolist()))
        res = days[["asset", "date", "y"]].copy()
        res["innov"], res["beta"] = [o[0] for o in out], [o[1] for o in out]
        yield res

    def close(self) -> None:
        pass


def stream_tvp(daily: DataFrame, q: float, h: float, xs: Sequence[str] = ("x",)) -> DataFrame:
    """(asset, date, y, innov, beta[]) from a stream of complete days."""
    use_rocksdb(daily.sparkSession)
    return daily.groupBy("asset").transformWithStateInPandas(
        InnovationProcessor(xs, q, h), "asset string, date date, y double, innov double, beta array<double>", "Append", "None"
    )
