"""The quote in force and the last value as large, on sequences that no task holds, against plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import as_of as AO


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    key = lambda n: [None if k == "none" else k for k in np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "never", "none"], n)).tolist()]
    rows = [(k, int(t), i, float(v)) for i, (k, t, v) in enumerate(zip(key(1500), rng.integers(0, 400, 1500), rng.normal(0, 1, 1500)))]
    rows += [("a", None, 5000, 1.0), rows[0], rows[0]]
    quotes = [(k, int(t), float(r), f"q{i}") for i, (k, t, r) in enumerate(zip(key(700), rng.integers(20, 500, 700), rng.normal(0, 1, 700))) if k != "never"]
    quotes += [("hot", 30, None, None), ("hot", None, 9.0, "x"), ("a", 25, None, "only a name")]
    left = spark.createDataFrame(rows, "k string, t int, id int, value double").repartition(5)
    right = spark.createDataFrame(quotes, "k string, t int, rate double, name string").repartition(3)
    return rows, quotes, left, right


def in_force(rows, quotes, tolerance=None):
    out = []
    for k, t, i, v in rows:
        mine = [(qt, (r is not None, r, n is not None, n), r, n) for qk, qt, r, n in quotes if k is not None and qk == k and t is not None and qt is not None and qt <= t and (r, n) != (None, None)]
        best = max(mine, key=lambda m: (m[0], m[1]), default=(None, None, None, None))
        if tolerance is not None and best[0] is not None and best[0] < t - tolerance:
            best = (None, None, None, None)
        out.append((i, v, best[2], best[3], best[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 50, 333, 100_000])
def test_quote_in_force(data, size):
    rows, quotes, left, right = data
    got = AO.as_of_join(left, right, ["k"], "t", ["rate", "name"], "at", rows_per_chunk=size)
    assert got.columns == ["k", "t", "id", "value", "rate", "name", "at"]
    assert sorted(((r.id, r.value, r.rate, r.name, r.at) for r in got.collect()), key=str) == in_force(rows, quotes)


def test_old_quotes_and_conversion(data):
    rows, quotes, left, right = data
    got = AO.as_of_join(left, right, ["k"], "t", ["rate", "name"], "at", tolerance=3, rows_per_chunk=100)
    assert sorted(((r.id, r.value, r.rate, r.name, r.at) for r in got.collect()), key=str) == in_force(rows, quotes, 3)
    c = AO.convert_as_of(left, right.drop("name"), 4.0, ["k"], "t", rows_per_chunk=100).collect()
    assert all((r.converted is None) == (r.rate is None) and (r.rate is None or r.converted == r.value * r.rate / 4.0) for r in c) and len(c) == len(rows)
    assert AO.as_of_join(left.limit(0), right, ["k"], "t", ["rate"]).count() == 0
    assert {r.rate for r in AO.as_of_join(left, right.limit(0), ["k"], "t", ["rate"]).collect()} == {None}


def test_no_window_holds_a_key(data):
    *_, left, right = data
    plan = AO.as_of_join(left, right, ["k"], "t", ["rate"], rows_per_chunk=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "_chunk" in plan


def plain(points):
    out = []
    for i, (t, v) in enumerate(points):
        before = [(u, w) for u, w in points[:i] if w >= v]
        out.append((t, v, *(before[-1] if before else (None, None))))
    return out


SHAPES = {
    "random": lambda rng, n: rng.integers(0, 50, n).astype(float),
    "rising": lambda rng, n: np.arange(n, dtype=float),
    "falling": lambda rng, n: -np.arange(n, dtype=float),
    "top first, then rising": lambda rng, n: np.concatenate([[1e9], np.arange(n - 1.0)]),
    "flat": lambda rng, n: np.zeros(n),
    "waves": lambda rng, n: np.sin(np.arange(n) / 9.0) * np.linspace(1, 3, n),
    "falling, then rising": lambda rng, n: np.abs(np.arange(n) - n / 2.0),
}


@pytest.mark.parametrize("size", [1, 13, 100, 100_000])
def test_last_value_as_large(spark, size):
    rng = np.random.default_rng(6)
    rows, want = [], []
    for n, (name, make) in enumerate(SHAPES.items()):
        v = make(rng, 260 + n)
        rows += [(name if n else None, t, float(x)) for t, x in enumerate(v)]
        want += [(name if n else None, *p) for p in plain([(t, float(x)) for t, x in enumerate(v)])]
    rows += [("flat", 9000, None), ("flat", 9001, float("nan")), ("single", 1, 2.0)]
    want += [("single", 1, 2.0, None, None)]
    df = spark.createDataFrame(rows, "series_id string, date int, value double").repartition(4)
    got = AO.last_as_large(df, rows_per_chunk=size).collect()
    none = lambda x: None if x is None or x != x else x
    assert sorted(((r.series_id, r.date, r.value, r.since, none(r.since_value)) for r in got), key=str) == sorted(want, key=str)
    assert AO.last_as_large(df.limit(0)).count() == 0


def test_slices_stay_few():
    rng = np.random.default_rng(1)
    for make in SHAPES.values():
        v = make(rng, 2000).reshape(-1, 10)
        wanted = AO.slices_wanted(range(len(v)), v[:, 0].tolist(), v.max(1).tolist())
        assert len(wanted) < 2 * len(v)


def test_dates_and_time_stamps(spark):
    rows = [("s", f"2024-01-{d:02d} 10:00:00", x) for d, x in ((1, 5.0), (2, 3.0), (3, 4.0), (4, 3.5))]
    df = spark.createDataFrame(rows, "series_id string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    for size in (1, 100):
        got = AO.last_as_large(df, order="ts", rows_per_chunk=size).orderBy("ts").collect()
        assert [str(r.since)[:10] for r in got] == ["None", "2024-01-01", "2024-01-01", "2024-01-03"]
        days = AO.last_as_large(df.withColumn("ts", F.to_date("ts")), order="ts", rows_per_chunk=size).orderBy("ts").collect()
        assert [str(r.since) for r in days] == ["None", "2024-01-01", "2024-01-01", "2024-01-03"]
