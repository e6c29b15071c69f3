"""Published results recomputed from their published inputs. All literals below are fixed values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesmill.functions import windows as W
from seriesmill.operators import aggregates as A
from seriesmill.operators import cleaning as C
from seriesmill.operators import joins as J

# Oil price by day.
OIL = [
    ("2026-03-30", 112.78), ("2026-03-31", 118.35), ("2026-04-01", 101.16), ("2026-04-02", 109.03), ("2026-04-06", 109.77),
    ("2026-04-07", 109.27), ("2026-04-08", 94.75), ("2026-04-09", 95.92), ("2026-04-10", 95.20), ("2026-04-13", 99.36),
    ("2026-04-14", 94.79), ("2026-04-15", 94.93), ("2026-04-16", 99.39), ("2026-04-17", 90.38), ("2026-04-20", 90.43),
    ("2026-04-21", 93.24), ("2026-04-22", 96.18), ("2026-04-23", 99.35), ("2026-04-24", 99.13), ("2026-04-27", 101.69),
    ("2026-04-28", 104.40), ("2026-04-29", 105.14),
]
# Laboratory diamond price by half year.
LAB = [
    ("2020-01-01", 3410), ("2020-06-01", 2500), ("2020-12-01", 1700), ("2021-06-01", 2200), ("2021-12-01", 2800), ("2022-06-01", 2200),
    ("2022-12-01", 1800), ("2023-06-01", 1500), ("2023-12-01", 1200), ("2024-06-01", 1000), ("2024-12-01", 892), ("2025-06-01", 850),
    ("2025-12-01", 800), ("2026-03-01", 780),
]
# Polished diamond index, the points around its extremes.
INDEX = [
    ("2020-01-01", 118.0), ("2020-04-01", 112.0), ("2021-12-01", 142.0), ("2022-01-01", 146.0), ("2022-03-01", 155.0), ("2022-06-01", 148.0),
    ("2025-12-01", 86.0), ("2026-01-01", 84.2), ("2026-02-01", 84.2), ("2026-03-01", 84.7),
]
# Inflation by category.
CATEGORIES = [
    ("Communication", 6.8), ("Food", 4.0), ("Culture & Recreation", 2.2), ("Clothing & Footwear", 2.1), ("Furniture & Household", 1.2),
    ("Housing", 1.0), ("Miscellaneous", 0.6), ("Transportation", 0.5), ("Medical Care", 0.4), ("Education", -5.6),
]
# Inflation release against consensus (measure, actual, low, high).
RELEASE = [("headline m/m", 0.9, 0.93, 0.93), ("headline y/y", 3.3, 3.4, 3.7), ("core m/m", 0.2, 0.29, 0.29), ("core y/y", 2.6, 2.7, 2.7)]


def _series(spark, rows, name):
    df = spark.createDataFrame([(name, d, float(v)) for d, v in rows], "series_id string, date string, value double")
    return df.withColumn("date", F.col("date").cast("date"))


def test_oil(spark):
    s = _series(spark, OIL, "oil")
    moves = {str(r.date): r.pct for r in W.pct_change(s).collect()}
    for day, pct in (("2026-04-01", -14.52), ("2026-04-08", -13.29), ("2026-04-17", -9.07)):
        assert moves[day] == pytest.approx(pct, abs=0.005)
    p = A.period_stats(s, "2026-04-29").first()
    assert (p.last, p.high, p.low) == (105.14, 118.35, 90.38)


def test_diamonds(spark):
    r = A.peak_trough(_series(spark, INDEX, "idx"), "2020-04-01").first()
    assert (r.peak, r.peak_date, r.latest, r.trough) == (155.0, dt.date(2022, 3, 1), 84.7, 84.2)
    assert r.trough_date == dt.date(2026, 1, 1), "the earlier of two equal lows"
    assert r.from_peak_pct == pytest.approx(-45.35, abs=0.005) and r.from_base_pct == pytest.approx(-24.38, abs=0.005)
    lab = A.peak_trough(_series(spark, LAB, "lab"), "2020-01-01").first()
    assert lab.from_base_pct == pytest.approx(-77.1, abs=0.05)


def test_categories(spark):
    c = spark.createDataFrame(CATEGORIES, "name string, value double").withColumn("g", F.lit("jp"))
    ranked = W.clamp_share(A.rank_components(c, "value", "name", ["g"]), 8.0).orderBy("pos").collect()
    assert [r.name for r in ranked] == [n for n, _ in CATEGORIES]
    assert ranked[0].share == pytest.approx(85.0) and ranked[-1].share == pytest.approx(70.0)


def test_release(spark):
    d = spark.createDataFrame(RELEASE, "measure string, actual double, exp_lo double, exp_hi double")
    assert {r.outcome for r in A.surprise(d).collect()} == {"below"}
    v = {m: a for m, a, _, _ in RELEASE}
    assert v["headline m/m"] - v["core m/m"] == pytest.approx(0.7)
    a = A.annualise(spark.createDataFrame([(0.2,)], "pct double")).first()
    assert a.annual_simple == pytest.approx(2.4) and a.annual_compound == pytest.approx(2.4266, abs=1e-3)


def test_standings(spark):
    pts = [("A1", "A", 72), ("A2", "A", 63), ("B1", "B", 49), ("B2", "B", 41), ("C1", "C", 4), ("D1", "D", 4)]
    d = spark.createDataFrame(pts, "driver string, team string, points int").withColumn("series", F.lit("s"))
    pos = W.share_of_max(W.standings(d, "points", "driver", ["series"]), "points", ["series"])
    assert {r.driver: (r.pos, r.share) for r in pos.collect()}["A2"] == (2, 88.0)
    assert sorted(r.pos for r in pos.collect()) == [1, 2, 3, 4, 5, 6]
    teams = spark.createDataFrame([(t,) for t in "ABCDE"], "team string")
    assert {r.team: r.total for r in A.group_sum(d, teams, "team", "points", "total").collect()} == {"A": 135, "B": 90, "C": 4, "D": 4, "E": 0}


def test_gas_spread(spark):
    a, b = _series(spark, [("2026-04-20", 17.0), ("2026-04-27", 17.576)], "ttf"), _series(spark, [("2026-04-27", 2.868)], "hh")
    r = J.latest_pair(a.unionByName(b).withColumn("g", F.lit(1)), F.col("series_id") == "ttf", F.col("series_id") == "hh", ["g"]).first()
    assert r.spread == pytest.approx(14.708) and r.ratio == pytest.approx(6.128, abs=1e-3)


def test_threshold_band(spark):
    rules = spark.createDataFrame([("gold", 4500.0, 5000.0)], "asset string, lower double, upper double")
    q = spark.createDataFrame([("gold", 5000.01), ("gold", 4499.0), ("gold", 4500.0), ("gold", 5000.0), ("gold", 4787.4), ("oil", 1.0)], "asset string, price double")
    assert {(r.price, r.alert) for r in C.threshold_rule(q, rules).collect()} == {(5000.01, "above"), (4499.0, "below")}


def test_edge_cases(spark):
    flat = _series(spark, [(f"2024-{m:02d}-01", 5.0) for m in range(1, 13)], "flat")
    z = W.zscore(flat, 3).collect()
    assert all(r.z is None for r in z), "no deviation, no z-score"
    gap = W.pct_change(_series(spark, [("2025-09-01", 0.0), ("2025-12-01", 2.0)], "g"), default=0.0).orderBy("date").collect()
    assert [(r.pct, r.gap_months) for r in gap] == [(0.0, None), (0.0, 3)]
    assert W.log_return(_series(spark, [("2024-01-01", 1.0), ("2024-02-01", 0.0), ("2024-03-01", 2.0)], "z")).filter("value is not null").count() == 0
    rec = A.largest_since(_series(spark, [("2024-01-01", 1.0), ("2024-02-01", 9.0)], "r")).first()
    assert rec.largest_since is None
    tie = A.peak(_series(spark, [("2024-03-01", 9.0), ("2024-02-01", 9.0), ("2024-01-01", 1.0)], "t")).first()
    assert str(tie.peak_date) == "2024-02-01"
    one = A.small_multiples(_series(spark, [("2024-01-01", 3.0)], "o"), keys=("series_id",)).first()
    assert (one.latest, one.prev, one.change) == (3.0, 3.0, 0.0)
    mm = W.minmax(flat).first()
    assert mm.scaled == 0.0
    assert C.cutoff("1y", "2024-02-29") == dt.date(2023, 2, 28) and C.cutoff("all", "2024-02-29") is None
    assert W.all_but_last_n(flat, 10).count() == 2 and W.last_n(flat, 10).count() == 10
