"""Rows without a key, folders and patterns of documents, sums of busy days: nothing is lost without a word."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.functions import windows as W
from seriesmill.operators import aggregates as A
from seriesmill.operators import cleaning as C
from seriesmill.operators import regression as R
from seriesmill.operators import signals as G
from seriesmill.operators import tvp as K
from seriesmill.sources import documents as S
from seriesmill.sources import publish as P
from seriesmill.streaming import online as O

KEYS = ["k", "m"]


@pytest.fixture(scope="module")
def keyed(spark):
    """Three groups, two of them with a null in the key."""
    rng = np.random.default_rng(3)
    rows = [(k, m, f"2024-01-{d:02d}", float(v), float(x)) for k, m in ((None, "a"), (None, None), ("z", "a")) for d, v, x in zip(range(1, 13), rng.normal(5, 1, 12), rng.normal(2, 1, 12))]
    return spark.createDataFrame(rows, "k string, m string, date string, value double, x double")


def groups(df, col):
    out = {}
    for r in df.collect():
        out.setdefault((r.k, r.m), []).append(r[col])
    return {k: sorted(v) for k, v in out.items()}


def alone(df, fn, col):
    """The same operator on each group by itself, under a key without nulls."""
    out = {}
    for k, m in ((None, "a"), (None, None), ("z", "a")):
        own = df.filter(F.col("k").eqNullSafe(F.lit(k)) & F.col("m").eqNullSafe(F.lit(m))).withColumns({"k": F.lit("one"), "m": F.lit("one")})
        out[k, m] = sorted(r[col] for r in fn(own).collect())
    return out


@pytest.mark.parametrize(
    "fn, col",
    [
        (lambda d: W.share_of_max(d, "value", KEYS), "share"),
        (lambda d: W.minmax(d, "value", KEYS), "scaled"),
        (lambda d: C.min_points(d, 12, KEYS), "value"),
        (lambda d: A.contribution(d, KEYS, "x", "value"), "share"),
        (lambda d: A.largest_since(d, "value", KEYS), "current"),
        (lambda d: R.standardise(d, ["value", "x"], KEYS), "x"),
        (lambda d: R.ols_apply(d, R.ols_betas(d, "value", ["x"], KEYS), "value", ["x"], KEYS), "resid"),
        (lambda d: R.ols_diag(d, "value", ["x"], KEYS), "f"),
        (lambda d: G.model_compare(d, K.tvp_smooth(d.withColumnRenamed("value", "y"), "y", ["x"], 0.01, 1.0, KEYS), "value", ["x"], KEYS), "gain_pp"),
    ],
)
def test_rows_without_a_key_are_a_group(keyed, fn, col):
    got, want = groups(fn(keyed), col), alone(keyed, fn, col)
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9)


def doc(*entries):
    return json.dumps({"Results": {"series": [{"seriesID": i, "data": [{"year": "2024", "period": "M01", "value": v}]} for i, v in entries]}})


def test_folders_patterns_and_equal_names(spark, tmp_path):
    for folder, name, text in (("a", "one.json", doc(("A", "1"), ("B", "1"))), ("a", "two +x.json", doc(("B", "2"))), ("b/c", "one.json", doc(("C", "3"), ("A", "4"))),
                               ("b/_temporary", "gone.json", doc(("A", "9"))), ("b", ".hidden.json", doc(("A", "9"))), ("d", "o[1].json", doc(("D", "5")))):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    read = lambda *p: sorted((r.series_id, r.value) for r in S.read_series_json(spark, [str(tmp_path / x) for x in p]).collect())
    assert read("a") == [("A", 1.0), ("B", 2.0)]
    assert read("a/*.json") == read("a/one.json", "a/two +x.json") == read("a")
    assert read("a/two +x.json", "a/one.json") == [("A", 1.0), ("B", 1.0)]
    assert read("a", "b") == [("A", 4.0), ("B", 2.0), ("C", 3.0)]
    assert read("b", "a") == [("A", 1.0), ("B", 2.0), ("C", 3.0)], "equal names in two folders keep the given order"
    assert read("d") == [("D", 5.0)]
    with pytest.raises(FileNotFoundError, match="no file at"):
        read("a", "nothing/*.json")
    with pytest.raises(ValueError, match="given twice"):
        read("a", "a/one.json")


def test_a_busy_day_does_not_overflow(spark):
    ticks = spark.range(200_000).select(F.lit("a").alias("asset"), F.lit("2024-01-02 10:00:00").cast("timestamp").alias("ts"), F.lit(1e6).alias("price"), F.lit(1.25).alias("k"))
    assert [(r.y, r.x) for r in O.daily_pairs(ticks).collect()] == [(1e6, 1.25)]


def test_a_section_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 10, 1, 2).mapInArrow(count, "id bigint")
    P.publish(df, str(tmp_path / "t"), "s")
    assert seen.value == 10
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(10))
    P.publish(df.where("id < 3"), str(tmp_path / "t"), "s")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["section=s"]
