"""Plans and skew: what must hold for tables far larger than the test data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seriesmill.functions import windows as W
from seriesmill.operators import aggregates as A
from seriesmill.operators import cleaning as C
from seriesmill.operators import joins as J
from seriesmill.sources import publish as P
from seriesmill.sources import tables as S

SF = "/root/testdata/sf0.001"
STREAMS = {n for n in entry.queries() if n.startswith("stream_")}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMS))
def test_no_query_pairs_everything_with_everything(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p, "no row-at-a-time Python"


def test_scans_read_needed_columns_only(spark):
    p = plan(S.price_panel(spark, SF))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p
    assert "PushedFilters: [IsNotNull(ts)" in plan(S.table(spark, SF, "events").filter("ts >= timestamp_ntz'2024-01-05'").select("ts"))


def test_rows_combine_before_the_exchange(spark):
    for df in (S.price_panel(spark, SF), S.supplier_series(spark, SF), S.segment_panels(spark, SF)):
        p = plan(df)
        assert p.index("partial_sum") > p.index("Exchange hashpartitioning"), "printed below, so executed before"
    assert plan(A.latest_prev(S.supplier_series(spark, SF))).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_movers"](spark, SF))


def test_window_chain_needs_one_exchange_of_the_series(spark):
    s = S.supplier_series(spark, SF)
    base = plan(s).count("Exchange hashpartitioning")
    chain = W.zscore_cum(W.zscore(W.rolling(W.drawdown(W.log_return(s)), 12), 12), 24)
    assert plan(chain).count("Exchange hashpartitioning") == base + 1


def test_dimension_is_broadcast_only_while_small(spark):
    dim = spark.range(100).select(F.col("id").alias("code"), F.col("id").cast("string").alias("label"))
    facts = spark.range(1000).select((F.col("id") % 120).alias("code"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = J.label_codes(facts, dim)
        assert "SortMergeJoin" in plan(big)
        want = sorted(map(tuple, big.collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        small = J.label_codes(facts, dim)
        assert "BroadcastHashJoin" in plan(small) and sorted(map(tuple, small.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stored_series_are_pruned_by_metric(spark, tmp_path):
    P.write_series(S.sector_series(spark, SF), str(tmp_path / "s"))
    d = C.get_series(spark.read.parquet(str(tmp_path / "s")), "BUILDING", "2-HIGH")
    p = plan(d)
    assert "PartitionFilters: [isnotnull(metric" in p and "EqualTo(entity,BUILDING)" in p
    assert d.count() > 0


def test_a_hot_supplier_and_a_hot_customer(spark, tmp_path):
    """Two thirds of all rows in one supplier and one customer: same results as a plain computation."""
    rng = np.random.default_rng(3)
    n = 60_000
    day = pd.Timestamp("2000-01-01") + pd.to_timedelta(rng.integers(0, 700, n), unit="D")
    hot = rng.random(n) < 0.67
    li = pd.DataFrame({"l_suppkey": np.where(hot, 7, rng.integers(0, 50, n)), "l_shipdate": day.astype("datetime64[us]"),
                       "l_extendedprice": rng.integers(100, 10_000_000, n) / 100, "l_quantity": rng.integers(1, 50, n).astype(float)})
    o = pd.DataFrame({"o_custkey": np.where(hot, 3, rng.integers(0, 40, n)), "o_orderdate": li.l_shipdate, "o_totalprice": li.l_extendedprice,
                      "o_orderpriority": rng.choice(S.PRIORITIES, n)})
    c = pd.DataFrame({"c_custkey": np.arange(40), "c_mktsegment": ["A", "B"] * 20})
    for name, d in (("lineitem", li), ("orders", o), ("customer", c)):
        d.to_parquet(tmp_path / f"{name}.parquet", index=False)
    month = li.l_shipdate.dt.to_period("M").dt.start_time.dt.date
    want = li.groupby(["l_suppkey", month])["l_extendedprice"].mean()
    got = S.supplier_series(spark, str(tmp_path)).toPandas().set_index(["series_id", "date"])["value"].sort_index()
    np.testing.assert_allclose(got, want.sort_index(), rtol=1e-12)
    seg = o.merge(c, left_on="o_custkey", right_on="c_custkey")
    y = seg.groupby(["c_mktsegment", seg.o_orderdate.dt.to_period("M").dt.start_time.dt.date])["o_totalprice"].mean()
    got = S.segment_panels(spark, str(tmp_path)).toPandas().set_index(["panel_id", "date"])["y"].sort_index()
    np.testing.assert_allclose(got, y.sort_index(), rtol=1e-12)


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_results_do_not_depend_on_partitioning(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    names = ["snapshot", "panel_wide", "zscore_by_series", "tvp_1f", "crossings"]
    want = {n: sorted(map(str, entry.queries()[n](spark, SF).collect())) for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for n in names:
            assert sorted(map(str, entry.queries()[n](spark, SF).collect())) == want[n], n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_orders_are_shuffled_once_at_most_for_segment_panels(spark):
    def exchanges():
        return plan(S.segment_panels(spark, SF)).count("Exchange hashpartitioning")

    assert exchanges() == 1  # sums only: customers are broadcast
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges() == 3  # both sides of the join, then sums
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name,table,scans", [("convert_units", "orders", 1), ("union_latest", "lineitem", 1), ("lasso_selected", "orders", 1)])
def test_one_scan(spark, name, table, scans):
    df = entry.queries()[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count(f"{table}.parquet") == scans
