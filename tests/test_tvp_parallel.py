"""Filter, smoother and likelihood in parallel over time equal the sequential ones for any chunk, block and fan."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import tvp as K
from seriesmill.operators import tvp_parallel as T

Q_, H = 0.01, 0.25


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    out = []
    for name, n in (("hot", 700), ("a", 90), (None, 40), ("one", 1), ("two", 2)):
        x = rng.normal(1, 1, (n, 2))
        b = np.cumsum(rng.normal(0, 0.1, (n, 2)), 0)
        y = (x * b).sum(1) + rng.normal(0, 0.5, n)
        out += [(name, i, float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)]
    out += [("a", 1000, None, 1.0, 1.0), ("gap", 0, 1.0, None, 2.0)]
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "series_id string, date int, y double, x1 double, x2 double").repartition(5)


def wide(out, cols):
    d = out.toPandas()
    d["series_id"] = d["series_id"].fillna("-")
    d = d.sort_values([c for c in ("series_id", "date", "term") if c in d]).reset_index(drop=True)
    return d[["series_id", "date"]], np.array([np.concatenate([np.atleast_1d(v) for v in r]) for r in d[cols].itertuples(index=False)], float)


def test_composition_is_associative_and_moves_states():
    rng = np.random.default_rng(1)
    y, x = rng.normal(0, 1, 60), rng.normal(0, 1, (60, 3))
    maps = T.Blocks(y, x, np.array([0, 7, 30]), np.array([7, 23, 30])).maps(Q_, H)
    a, b, c = (maps.at(slice(i, i + 1)) for i in range(3))
    one, two = T.compose(T.compose(a, b), c), T.compose(a, T.compose(b, c))
    whole = T.Blocks(y, x, np.array([0]), np.array([60])).maps(Q_, H)
    for f in ("a", "c", "cov", "v", "j", "base"):
        np.testing.assert_allclose(getattr(one, f), getattr(two, f), rtol=1e-9, atol=1e-10)
        np.testing.assert_allclose(getattr(one, f), getattr(whole, f), rtol=1e-9, atol=1e-10)
    mean, cov = T.prior(3, Q_)
    got = T.forward(mean, cov, whole.at(0))
    *_, (b_end, p_end) = K.filter_runs(y, x, np.array([0]), Q_, H)
    np.testing.assert_allclose(got[0], b_end, atol=1e-8)
    np.testing.assert_allclose(got[1], p_end, atol=1e-8)
    assert got[2] == pytest.approx(K.loglik(y, x, np.array([H]), np.array([Q_]))[0], abs=1e-7)
    assert T.Maps.unpack([whole.pack(0)], 3).cov.tolist() == whole.cov.tolist()


@pytest.mark.parametrize("size, fan", [(1, 3), (7, 4096), (7, 5), (64, 2), (100_000, 4096)])
def test_filter_and_smoother_equal_the_sequential_ones(df, size, fan):
    ids, want = wide(K.tvp_filter(df, "y", ["x1", "x2"], Q_, H), ["innov", "innov_var", "beta", "se"])
    got_ids, got = wide(T.long_tvp_filter(df, "y", ["x1", "x2"], Q_, H, rows_per_chunk=size, fan=fan), ["innov", "innov_var", "beta", "se"])
    assert ids.equals(got_ids)
    np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-8)
    if size == 1:
        return
    ids, want = wide(K.tvp_smooth(df, "y", ["x1", "x2"], Q_, H), ["y", "fitted", "beta", "se", "lo", "hi"])
    got_ids, got = wide(T.long_tvp_smooth(df, "y", ["x1", "x2"], Q_, H, rows_per_chunk=size, fan=fan), ["y", "fitted", "beta", "se", "lo", "hi"])
    assert ids.equals(got_ids)
    np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-8)


@pytest.mark.parametrize("size, fan", [(50, 3), (100_000, 4096)])
def test_likelihood_adds_up(df, rows, size, fan):
    got = {r.series_id: (r.n, r.loglik) for r in T.long_tvp_loglik(df, "y", ["x1", "x2"], Q_, H, rows_per_chunk=size, fan=fan).collect()}
    for name in ("hot", "a", None, "one", "two"):
        own = np.array([r[2:] for r in sorted((r for r in rows if r[0] == name and r[2] is not None), key=lambda r: r[1])], float)
        ll = K.loglik(own[:, 0], own[:, 1:], np.array([H]), np.array([Q_]))[0]
        assert got[name][0] == len(own) and got[name][1] == pytest.approx(ll, abs=1e-7)
    assert "gap" not in got


def test_several_order_columns_and_repeated_ones(spark, df):
    two = df.filter("y is not null").withColumns({"ts": F.floor(F.col("date") / 10), "event_id": F.col("date")})
    got = T.long_tvp_filter(two, "y", ["x1", "x2"], Q_, H, order=["ts", "event_id"], rows_per_chunk=33)
    ids, want = wide(K.tvp_filter(df, "y", ["x1", "x2"], Q_, H), ["beta"])
    _, mine = wide(got.withColumnRenamed("event_id", "date"), ["beta"])
    np.testing.assert_allclose(mine, want, rtol=1e-8, atol=1e-8)
    again = df.unionByName(df.filter("series_id = 'hot' and date in (63, 64)"))
    for size in (64, 100_000):
        with pytest.raises(Exception, match="must be unique"):
            T.long_tvp_filter(again, "y", ["x1", "x2"], Q_, H, rows_per_chunk=size).count()
    assert T.long_tvp_filter(df.limit(0), "y", ["x1", "x2"], Q_, H).count() == 0


def test_no_task_holds_the_series(spark, df):
    chunks = T._chunks(df, "y", ["x1", "x2"], ["series_id"], ["date"], 50)
    assert chunks.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 51
    maps = T.border_maps(chunks, ["series_id"], ["date"], 2, Q_, H)
    assert maps.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 2
