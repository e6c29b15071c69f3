"""Series that stand still for a while have no correlation there; they stop no job and equal the twin in SQL."""

import datetime
import random

import duckdb
import oracle
import pytest

import __spark_entry__ as E
from seriesmill.functions import windows as W
from seriesmill.operators import aggregates as A


@pytest.fixture(scope="module")
def flat_dir(spark, tmp_path_factory):
    """Suppliers whose quantity, price or neither stands still, at the start or over a full window."""
    rng, rows = random.Random(3), []
    for supplier, (flat_x, flat_y) in enumerate([(0, 0), (3, 0), (0, 3), (40, 0), (0, 40), (60, 60), (2, 2)]):
        for month in range(60):
            day = datetime.datetime(1995 + month // 12, month % 12 + 1, 1 + supplier)
            x, y = 25.0 if month < flat_x else float(rng.randint(1, 50)), 1000.0 if month < flat_y else rng.randint(90_000, 200_000) / 100
            rows.append((supplier, x, y, day))
    path = str(tmp_path_factory.mktemp("flat"))
    df = spark.createDataFrame(rows, "l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz")
    df.write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.mark.parametrize("name", ["rolling_corr_by_series", "rolling_beta_1f"])
def test_flat_windows_equal_the_twin(spark, flat_dir, name):
    df = E.queries()[name](spark, flat_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{flat_dir}/lineitem.parquet/*.parquet'")
    assert oracle.compare(df.schema, df.collect(), con.sql(E.oracle_sql()[name])) == ""


def test_correlation_is_null_where_nothing_varies(spark):
    rows = [("line", float(i), 2.0 * i) for i in range(5)] + [("x", float(i), 7.0) for i in range(5)] + [("y", 7.0, float(i)) for i in range(5)]
    rows += [("one", 1.0, 2.0), ("gap", 1.0, 1.0), ("gap", 2.0, None), ("gap", None, 2.0), ("gap", 2.0, 3.0), ("none", None, None)]
    df = spark.createDataFrame(rows, "panel_id string, y double, x double")
    want = {"line": 1.0, "x": None, "y": None, "one": None, "gap": 1.0, "none": None}
    got = {r.panel_id: r.r for r in df.groupBy("panel_id").agg(W.correlation("y", "x").alias("r")).collect()}
    assert got == {k: v and pytest.approx(v) for k, v in want.items()}
    fits = {r.panel_id: r.corr for r in A.simple_ols(df, "y", "x", ["panel_id"]).collect()}
    assert fits == {k: v and pytest.approx(v) for k, v in want.items()}
    cells = {r.panel_id: r.corr for r in A.corr_matrix(df, ["y", "x"]).filter("row = 'y' and col = 'x'").collect()}
    assert cells == {k: v and pytest.approx(v) for k, v in want.items()}
