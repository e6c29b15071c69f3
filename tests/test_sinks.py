import json

from pyspark.sql import functions as F

from seriesmill.operators import quotes as M
from seriesmill.sources import dimensions as D
from seriesmill.sources import publish as P


def test_publish_twice_is_publish_once(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("p", 1.0), ("q", 2.0)], "k string, v double")
    P.publish(a, path, "ols")
    P.publish(a.withColumn("v", F.col("v") * 10), path, "kalman")
    P.publish(a.withColumn("v", F.col("v") + 1), path, "kalman")
    P.publish(a.withColumn("v", F.col("v") + 1), path, "kalman")
    got = sorted((r.section, r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("kalman", "p", 2.0), ("kalman", "q", 3.0), ("ols", "p", 1.0), ("ols", "q", 2.0)]


def test_series_map_and_snapshot_files(spark, tmp_path):
    df = spark.createDataFrame([("s", "2024-02-01", 2.0), ("s", "2024-01-01", 1.0), ("t", "2024-01-01", None)], "series_id string, date string, value double")
    df = df.withColumn("date", F.col("date").cast("date"))
    P.write_series_map(df, str(tmp_path / "m"))
    rows = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "m")).collect()]
    by = {r["key"]: r["points"] for r in rows}
    assert by["s"] == [{"date": "2024-01-01", "value": 1.0}, {"date": "2024-02-01", "value": 2.0}]
    assert [p["date"] for p in by["t"]] == ["2024-01-01"]
    P.write_snapshot(df, str(tmp_path / "s"), "parquet")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3


def test_report(spark, tmp_path):
    q = spark.createDataFrame([("^GSPC", 6816.89, 0.5), ("^TNX", 4.32, -0.56), ("^VIX", 19.23, 0.0)], "ticker string, price double, change_pct double")
    t = M.snapshot_table(q.withColumn("error", F.lit(None).cast("string")), D.tickers(spark)).withColumn("report_id", F.lit("morning"))
    lines = M.frame_report(M.render_report(t), F.lit("2026-04-29 10:00:00").cast("timestamp"))
    P.write_report(lines, str(tmp_path / "r"))
    text = [r.line for r in lines.orderBy("ord", "part").collect()]
    assert text[:4] == ["═" * 45, "  MARKET DATA SNAPSHOT", "  2026-04-29 10:00 UTC", "═" * 45]
    assert text[4:8] == ["", "EQUITIES", "  S&P 500                  6,816.89     +0.50%", "  Nasdaq                Error: no quote"]
    assert "  US 10Y Yield                4.32%     -0.56%" in text
    assert "  VIX                         19.23     +0.00%" in text
    assert text[-2:] == ["", "═" * 45] and text.count("FX") == 1
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == sorted(text)
