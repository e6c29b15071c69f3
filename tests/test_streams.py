"""A stream gives the batch result, in few or many micro-batches and in any file order."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import cleaning as C
from seriesmill.operators import tvp as K
from seriesmill.streaming import alerts as R
from seriesmill.streaming import engine as E
from seriesmill.streaming import online as O

RULES = [("a", 10.0, 50.0), ("b", 20.0, 60.0)]


@pytest.fixture(scope="module")
def events():
    rng = np.random.default_rng(11)
    n = 600
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 12 * 24 * 3600, n)), unit="s")
    return pd.DataFrame({
        "event_id": np.arange(n), "ts": ts.astype("datetime64[us]"), "event_type": np.where(rng.random(n) < 0.8, "a", "b"),
        "value": rng.integers(100, 7000, n) / 100, "props": [f'{{"k": {k}}}' for k in rng.integers(0, 100, n)],
    })


def _land(events, folder, files):
    """Write contiguous files with rising file times."""
    os.makedirs(folder)
    for i, idx in enumerate(np.array_split(np.arange(len(events)), files)):
        path = f"{folder}/part-{i:03d}.parquet"
        events.iloc[idx].to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "asset string, lower double, upper double")


def _batch(spark, events):
    d = spark.createDataFrame(events)
    return d.select(F.col("event_type").alias("asset"), "ts", "event_id", F.col("value").alias("price"),
                    F.get_json_object("props", "$.k").cast("double").alias("k"))


def _done(buckets, events, delay):
    return buckets.filter(F.col("bucket_end") <= F.lit(events.ts.max()) - F.expr(f"interval {delay}"))


@pytest.mark.parametrize("files", [1, 3, 6])
def test_crossings(spark, events, rules, tmp_path, files):
    src = _land(events, str(tmp_path / "in"), files)
    out = E.run_to_table(R.stream_crossings(E.tick_stream(spark, src, 1), rules), "c", str(tmp_path / "out"), str(tmp_path / "cp"))
    want = R.bucket_crossings(_done(R.latest_per_bucket(_batch(spark, events)), events, R.DELAY), rules)
    got = {tuple(r) for r in out.collect()}
    assert got == {tuple(r) for r in want.collect()} and len(got) > 50


def test_shuffled_arrival_within_the_delay(spark, events, rules, tmp_path):
    """Rows that arrive out of order between batches, but within the delay, change nothing."""
    ev = events.copy()
    ev["ts"] = pd.Timestamp("2024-01-01") + (ev["ts"] - pd.Timestamp("2024-01-01")) / 600
    rng = np.random.default_rng(2)
    late = ev.sort_values("ts").reset_index(drop=True)
    late = late.iloc[np.argsort(np.arange(len(late)) + rng.uniform(0, 40, len(late)), kind="stable")]
    src = _land(late, str(tmp_path / "in"), 5)
    out = E.run_to_table(R.stream_crossings(E.tick_stream(spark, src, 1), rules, "1 minute", "10 minutes"), "c", str(tmp_path / "o"), str(tmp_path / "cp"))
    b = _done(R.latest_per_bucket(_batch(spark, ev), "1 minute", "10 minutes"), ev, "10 minutes")
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in R.bucket_crossings(b, rules).collect()}


def test_late_rows_are_dropped(spark, events, tmp_path):
    late = events.head(1).assign(event_id=9999, value=1.0)
    src = _land(pd.concat([events, late]), str(tmp_path / "in"), 4)
    os.utime(f"{src}/part-003.parquet", (1_800_000_000, 1_800_000_000))
    only_late = _land(late, str(tmp_path / "late"), 1)
    os.replace(f"{only_late}/part-000.parquet", f"{src}/part-999.parquet")
    os.utime(f"{src}/part-999.parquet", (1_900_000_000, 1_900_000_000))
    out = E.run_to_table(R.latest_per_bucket(E.tick_stream(spark, src, 1)), "b", str(tmp_path / "o"), str(tmp_path / "cp"))
    first = out.orderBy("bucket").first()
    want = R.latest_per_bucket(_batch(spark, events)).orderBy("bucket").first()
    assert (first.bucket, first.price, first.ticks) == (want.bucket, want.price, want.ticks)


def test_level_and_edge_alerts(spark, tmp_path):
    """Prices 10, 60, 70, 20, 1 with a band of 5 to 50: three level alerts, two edge alerts."""
    prices = [10.0, 60.0, 70.0, 20.0, 1.0, 10.0]
    ts = pd.date_range("2024-01-01", periods=5, freq="15min").tolist() + [pd.Timestamp("2024-01-02")]
    ev = pd.DataFrame({"event_id": range(6), "ts": pd.Series(ts).astype("datetime64[us]"), "event_type": "gold", "value": prices, "props": "{}"})
    band = spark.createDataFrame([("gold", 5.0, 50.0)], "asset string, lower double, upper double")
    src = _land(ev, str(tmp_path / "in"), 3)
    level = E.run_to_table(R.stream_alerts(E.tick_stream(spark, src, 1).drop("k"), band), "l", str(tmp_path / "l"), str(tmp_path / "lc"))
    assert sorted(r.event_id for r in level.collect()) == [1, 2, 4]
    edge = E.run_to_table(R.stream_crossings(E.tick_stream(spark, src, 1), band), "e", str(tmp_path / "e"), str(tmp_path / "ec"))
    assert sorted((r.price, r.alert) for r in edge.collect()) == [(1.0, "below"), (60.0, "above")]


@pytest.mark.parametrize("files", [1, 4])
def test_innovations(spark, events, tmp_path, files):
    src = _land(events, str(tmp_path / "in"), files)
    out = E.run_to_table(O.stream_tvp(O.daily_pairs(E.tick_stream(spark, src, 1)), 0.01, 4.0), "t", str(tmp_path / "o"), str(tmp_path / "cp"))
    last = events.ts.max() - pd.Timedelta("1h")
    days = O.daily_pairs(_batch(spark, events)).filter(F.date_add("date", 1).cast("timestamp") <= F.lit(last))
    want = K.tvp_filter(days, "y", ["x"], 0.01, 4.0, ["asset"]).toPandas().sort_values(["asset", "date"], ignore_index=True)
    got = out.toPandas().sort_values(["asset", "date"], ignore_index=True)
    assert len(got) == len(want) >= 20
    np.testing.assert_allclose(got.innov, want.innov, atol=1e-9)


def _entered(events, every="15min"):
    """(asset, interval, zone) of every tick that crosses into an outer zone."""
    bands = {a: (lo, hi) for a, lo, hi in RULES}
    out = {}
    for asset, g in events.sort_values(["ts", "event_id"]).groupby("event_type"):
        before = "in"
        for ts, price in zip(g.ts, g.value):
            lo, hi = bands[asset]
            now = "above" if price > hi else "below" if price < lo else "in"
            if now not in ("in", before):
                out.setdefault((asset, ts.floor(every), now), price)
            before = now
    return out


@pytest.mark.parametrize("files", [1, 3, 6])
def test_no_crossing_inside_an_interval_is_lost(spark, events, rules, tmp_path, files):
    ev = events.copy()  # about eight ticks per interval
    ev["ts"] = (pd.Timestamp("2024-01-01") + (ev["ts"] - pd.Timestamp("2024-01-01")) / 15).astype("datetime64[us]")
    src = _land(ev, str(tmp_path / "in"), files)
    counts = {}
    out = E.run_to_table(R.stream_entries(E.tick_stream(spark, src, 1), rules), "n", str(tmp_path / "o"), str(tmp_path / "cp"), counts)
    last = ev.ts.max() - pd.Timedelta(R.DELAY)
    want = {k for k in _entered(ev) if k[1] + pd.Timedelta("15min") <= last}
    rows = out.collect()
    assert {(r.asset, pd.Timestamp(r.bucket), r.alert) for r in rows} == want and len(rows) == len(want) > 50
    assert counts["late"] == 0
    prices = dict(zip(ev.event_id, ev.value))
    assert all(prices[r.event_id] == r.price for r in rows)


def test_entries_of_one_interval():
    t = {f"{z}_{n}": None for z in R.ZONES for n in ("first", "last")}
    spike = t | {"in_first": (1, 1, 9.0), "in_last": (3, 3, 9.0), "above_first": (2, 2, 99.0), "above_last": (2, 2, 99.0)}
    assert R.entries(spike, "in") == ([("above", (2, 2, 99.0))], "in")
    stays = t | {"above_first": (1, 1, 99.0), "above_last": (3, 3, 98.0)}
    assert R.entries(stays, "above") == ([], "above") and R.entries(stays, "below") == ([("above", (1, 1, 99.0))], "above")
    back = stays | {"in_first": (2, 2, 9.0), "in_last": (2, 2, 9.0)}
    assert R.entries(back, "above") == ([("above", (3, 3, 98.0))], "above")


def test_late_rows_are_counted(spark, events, rules, tmp_path):
    src = _land(events, str(tmp_path / "in"), 4)
    _land(events.head(1).assign(event_id=9999), str(tmp_path / "late"), 1)
    os.replace(f"{tmp_path}/late/part-000.parquet", f"{src}/part-999.parquet")
    os.utime(f"{src}/part-999.parquet", (1_900_000_000, 1_900_000_000))
    counts = {}
    E.run_to_table(R.latest_per_bucket(E.tick_stream(spark, src, 1)), "b", str(tmp_path / "o"), str(tmp_path / "cp"), counts)
    assert counts["late"] == 1


def test_snapshot_does_not_grow_with_triggers(spark, events, tmp_path):
    src = _land(events, str(tmp_path / "in"), 6)
    path = str(tmp_path / "snap")
    rows = R.stream_snapshot(E.tick_stream(spark, src, 1), path, str(tmp_path / "c")).collect()
    assert len(rows) == 2 and R.snapshot_versions(spark, path) == [4, 5]
    assert spark.read.parquet(f"{path}/version=5").count() == 2


def test_folder_with_a_trailing_slash(spark, events, tmp_path):
    src = _land(events, str(tmp_path / "in"), 2)
    assert E.stream_table(spark, src + "/").isStreaming


def test_snapshot_replay_changes_nothing(spark, events, tmp_path):
    src = _land(events, str(tmp_path / "in"), 3)
    path = str(tmp_path / "snap")
    one = sorted(tuple(r) for r in R.stream_snapshot(E.tick_stream(spark, src, 1), path, str(tmp_path / "c1")).collect())
    two = sorted(tuple(r) for r in R.stream_snapshot(E.tick_stream(spark, src, 1), path, str(tmp_path / "c2")).collect())
    want = events.sort_values("ts").groupby("event_type").last()
    assert one == two and {r[0]: r[3] for r in one} == want["value"].to_dict()


def test_keywords(spark, tmp_path):
    docs = pd.DataFrame({"doc_id": [1, 2, 3, 4], "text": ["New TARIFF on steel", "nothing", "x" * 100_000 + " rate cut", "Rate cut after tariff"]})
    os.makedirs(tmp_path / "in")
    docs.to_parquet(tmp_path / "in" / "p.parquet", index=False)
    words = ["tariff", "rate cut"]
    s = E.stream_table(spark, str(tmp_path / "in"))
    out = E.run_to_table(R.stream_keywords(s, words).drop("text"), "k", str(tmp_path / "o"), str(tmp_path / "cp"))
    want = {(1, "tariff"), (3, "rate cut"), (4, "tariff,rate cut")}
    assert {tuple(r) for r in out.collect()} == want
    assert {tuple(r) for r in C.keyword_alerts(spark.createDataFrame(docs), words).drop("text").collect()} == want


def test_late_rows_are_counted_beyond_the_latest_reports(spark, events, tmp_path):
    """The query keeps only its latest report here; the late rows of earlier batches count all the same."""
    src = _land(events, str(tmp_path / "in"), 3)
    late = _land(events.head(5).assign(event_id=range(9000, 9005)), str(tmp_path / "late"), 1)
    for k, when in enumerate((1_700_000_000, 1_700_000_100, 1_700_000_200)):
        os.utime(f"{src}/part-{k:03d}.parquet", (when, when))
    os.replace(f"{late}/part-000.parquet", f"{src}/part-900.parquet")
    os.utime(f"{src}/part-900.parquet", (1_800_000_000, 1_800_000_000))
    last = _land(events.tail(3).assign(event_id=range(9100, 9103)), str(tmp_path / "last"), 1)
    os.replace(f"{last}/part-000.parquet", f"{src}/part-901.parquet")
    os.utime(f"{src}/part-901.parquet", (1_900_000_000, 1_900_000_000))
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        counts = {}
        E.run_to_table(R.latest_per_bucket(E.tick_stream(spark, src, 1)), "b", str(tmp_path / "o"), str(tmp_path / "cp"), counts)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert counts["late"] == 6, "five of the batch before, one group of the last"
