"""Chunked windows equal a plain computation for any chunk size, also when one key holds most rows."""

import numpy as np
import pandas as pd
import pytest

from seriesmill.operators import long_series as L
from seriesmill.operators import moving as M

KEYS, ORDER = ["asset"], ["ts", "event_id"]


@pytest.fixture(scope="module")
def ticks():
    rng = np.random.default_rng(5)
    n = 3000
    asset = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c", "d"], n))
    asset[:3] = ["one", "two", "two"]
    # Many equal time stamps, and a third of all rows in a single one.
    ts = np.where(rng.random(n) < 0.35, 500, rng.integers(0, 1000, n))
    return pd.DataFrame({"asset": asset, "ts": ts, "event_id": np.arange(n), "price": rng.integers(1, 5000, n) / 100})


@pytest.fixture(scope="module")
def df(spark, ticks):
    return spark.createDataFrame(ticks).repartition(5)


def _by_id(df):
    return df.toPandas().sort_values("event_id").reset_index(drop=True)


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_previous_and_rolling(df, ticks, size):
    want = ticks.sort_values(ORDER)
    g = want.groupby("asset")["price"]
    want = want.assign(
        pct=g.pct_change() * 100,
        roll_mean=g.transform(lambda s: s.rolling(20).mean()),
        roll_std=g.transform(lambda s: s.rolling(20).std()),
    ).sort_values("event_id")
    pct = _by_id(L.long_pct_change(df, "price", KEYS, ORDER, size))
    assert len(pct) == len(ticks)
    np.testing.assert_allclose(pct["pct"].astype(float), want["pct"], rtol=1e-9)
    roll = _by_id(M.moving_stats(df, 20, "price", KEYS, ORDER, rows_per_chunk=size))
    np.testing.assert_allclose(roll["roll_mean"].astype(float), want["roll_mean"], rtol=1e-9)
    np.testing.assert_allclose(roll["roll_std"].astype(float), want["roll_std"], rtol=1e-7)


@pytest.mark.parametrize("size", [7, 100, 10_000])
def test_running(df, ticks, size):
    want = ticks.sort_values(ORDER)
    g = want.groupby("asset")["price"]
    want = want.assign(cum=g.cumsum(), top=g.cummax()).sort_values("event_id")
    got = _by_id(L.long_running(df, "price", KEYS, ORDER, size))
    np.testing.assert_allclose(got["cum"], want["cum"], rtol=1e-9)
    np.testing.assert_array_equal(got["running_max"], want["top"])
    np.testing.assert_allclose(got["drawdown"], want["price"].to_numpy() / want["top"].to_numpy() - 1, atol=1e-12)


@pytest.mark.parametrize("size", [3, 250])
def test_crossings(spark, df, ticks, size):
    rules = spark.createDataFrame([("hot", 10.0, 40.0), ("a", 5.0, 45.0), ("two", 1.0, 2.0)], "asset string, lower double, upper double")
    lo, hi = {"hot": 10.0, "a": 5.0, "two": 1.0}, {"hot": 40.0, "a": 45.0, "two": 2.0}
    want, last = set(), {}
    for r in ticks.sort_values(ORDER).itertuples():
        if r.asset in lo:
            z = "above" if r.price > hi[r.asset] else "below" if r.price < lo[r.asset] else "in"
            if z != "in" and z != last.get(r.asset, "in"):
                want.add((r.event_id, z))
            last[r.asset] = z
    got = {(r.event_id, r.alert) for r in L.crossings(df, rules, rows_per_chunk=size).collect()}
    assert got == want and len(want) > 100


def test_no_task_gets_a_whole_key(df):
    c = L.chunked(df, KEYS, ORDER, halo=19, rows_per_chunk=100)
    assert c.groupBy("_chunk").count().agg({"count": "max"}).first()[0] <= 119
    assert c.filter("_own").count() == 3000
