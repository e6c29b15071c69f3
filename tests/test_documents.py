"""JSON documents, dimensions and the functions only they need."""

import datetime as dt
import json

from pyspark.sql import functions as F

from seriesmill.functions import scalars as X
from seriesmill.operators import quotes as M
from seriesmill.operators.aggregates import snapshot
from seriesmill.operators.cleaning import clean_values
from seriesmill.sources import dimensions as D
from seriesmill.sources import documents as S
from seriesmill.sources.tables import read_panel


def _doc(**series):
    return {"Results": {"series": [{"seriesID": k, "data": [dict(zip(("year", "period", "value"), p)) for p in v]} for k, v in series.items()]}}


def _write(tmp_path, *docs):
    paths = []
    for i, d in enumerate(docs):
        p = tmp_path / f"f{i}.json"
        p.write_text(json.dumps(d, indent=1))
        paths.append(str(p))
    return paths


def test_series_documents(spark, tmp_path):
    jol, qul = "JTS30000000000JOL", "JTS99900000000QUL"
    first = _doc(**{jol: [("2020", "M01", "1")], "JTS20000000000JOL": [("2020", "M02", "7")], "JTS10000000000HIL": []})
    second = _doc(**{
        jol: [("2020", "M03", "5"), ("2020", "M01", "4"), ("2020", "M02", "5"), ("2020", "M13", "9"), ("2020", "M04", ""), ("2020", "M05", "-")],
        qul: [("2021", "M01", "2.5")],
        "JTS20000000000JOL": [],
    })
    s = S.read_series_json(spark, _write(tmp_path, first, second))
    got = {(r.series_id, r.date.isoformat(), r.value) for r in s.collect()}
    assert got == {
        (jol, "2020-01-01", 4.0), (jol, "2020-02-01", 5.0), (jol, "2020-03-01", 5.0),
        (qul, "2021-01-01", 2.5), ("JTS20000000000JOL", "2020-02-01", 7.0),
    }
    keys = {r.series_id: r.key for r in S.decode_series_ids(s, D.industries(spark), D.metrics(spark)).collect()}
    assert keys[jol] == "Manufacturing|Job Openings"
    assert keys[qul] == "Unknown (999)|Quits"
    snap = snapshot(s, "2020-01-01").collect()
    assert len(snap) == 1, "series with one point have no snapshot"
    r = snap[0]
    assert (r.current, r.previous, r.peak, r.peak_date, r.base_value) == (5.0, 5.0, 5.0, dt.date(2020, 2, 1), 4.0)


def test_quotes_and_errors(spark):
    def body(**meta):
        return json.dumps({"chart": {"result": [{"meta": meta}]}})

    raw = spark.createDataFrame([
        ("^GSPC", body(regularMarketPrice=110.0, chartPreviousClose=100.0)),
        ("^IXIC", body(regularMarketPrice=90.0, chartPreviousClose=0, previousClose=100.0)),
        ("^TNX", body(regularMarketPrice=4.2)),
        ("^VIX", "{not json"),
        ("CL=F", json.dumps({"chart": {"result": []}})),
    ], "ticker string, body string")
    q = M.quote_change(S.read_quotes(raw))
    t = {r.ticker: r for r in M.snapshot_table(q, D.tickers(spark)).collect()}
    assert len(t) == 8
    assert abs(t["^GSPC"].change_pct - 10) < 1e-12 and abs(t["^IXIC"].change_pct + 10) < 1e-12
    assert t["^TNX"].change_pct == 0.0 and t["^TNX"].error is None
    assert t["^VIX"].error == "malformed document" and t["CL=F"].error == "no result in document"
    assert t["DX-Y.NYB"].error == "no quote"


def test_point_and_pair_arrays(spark):
    df = spark.createDataFrame([('[{"date":"2026-01-02","value":1.5},{"date":"2026-01-09","value":null}]', '[["2014-01-01", 133], ["2014-06-01", 134.5]]')], "p string, q string")
    assert [(str(r.date), r.value) for r in S.series_from_points(df, "p").collect()] == [("2026-01-02", 1.5), ("2026-01-09", None)]
    assert [(str(r.date), r.value) for r in S.series_from_pairs(df, "q").collect()] == [("2014-01-01", 133.0), ("2014-06-01", 134.5)]
    xy = spark.createDataFrame([('[{"x":0.01,"y":-0.02,"date":"2021-03-22"}]',)], "p string")
    assert [tuple(r) for r in S.points_xy(xy, "p").collect()] == [(0.01, -0.02, dt.date(2021, 3, 22))]
    price = spark.createDataFrame([('[{"date":"2026-03-30","price":112.78}]',)], "p string")
    assert S.series_from_points(price, "p").first().value == 112.78


def test_parallel_arrays_keep_holes(spark):
    doc = {"labels": ["Jan 25", "Feb 25", "Mar 25"], "datasets": [{"label": "Core", "data": [1.0, None, 2.0]}, {"label": "All", "data": [None, 3.0, 1.5]}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "d string")
    got = {(r.series, r.pos, r.label, r.value) for r in S.series_from_parallel(df, "d").collect()}
    assert len(got) == 6 and ("Core", 1, "Feb 25", None) in got and ("All", 2, "Mar 25", 1.5) in got


def test_cards_and_order(spark):
    doc = {"rates": [{"name": "10Y", "ticker": "^TNX", "price": 4.32, "change": 0.024, "changePct": 0.56, "trend": [4.28, 4.32], "isPct": True}],
           "fx": [{"name": "DXY", "ticker": "DX", "price": 98.7, "change": 0.0, "changePct": 0.0, "trend": [1.0]}]}
    c = S.cards_from_json(spark.createDataFrame([(json.dumps(doc),)], "d string"), "d")
    rows = {r.ticker: r for r in c.withColumn("class", X.positive_class("change_pct")).collect()}
    assert rows["^TNX"].is_pct and not rows["DX"].is_pct and rows["DX"]["class"] == "positive"
    o = S.with_ordinal(c, ["fx", "rates"], "category").collect()
    assert {(r.category, r.ord) for r in o} == {("fx", 1), ("rates", 2)}
    assert D.display_order(spark).filter("ord = 1").first().entity == "Total Nonfarm"


def test_read_panel(spark, tmp_path):
    p = tmp_path / "panel.csv"
    p.write_text("When,A,B\n2024-01-08,2,3\n2024-01-01,1,NaN\n2024-01-15,x,4\n")
    rows = {str(r.date): (r.y, r.x1) for r in read_panel(spark, str(p), ["y", "x1"]).collect()}
    assert rows == {"2024-01-08": (2.0, 3.0), "2024-01-01": (1.0, None), "2024-01-15": (None, 4.0)}


def test_scalars_without_twin(spark):
    one = spark.range(1)
    r = one.select(
        X.map_default(F.create_map(F.lit("a"), F.lit("A")), F.lit("b"), F.lit("Unknown (b)")).alias("md"),
        X.as_of_text(F.timestamp_seconds(F.lit(0))).alias("now"),
        X.to_zone(F.lit("2026-05-03 20:00:00").cast("timestamp_ntz"), "America/Sao_Paulo").alias("zone"),
        X.nan_to(F.lit(float("nan"))).alias("nan"),
        X.join_names(F.array(F.lit("x1"), F.lit("x2"))).alias("names"),
        X.join_names(F.array().cast("array<string>")).alias("none"),
        X.verdict(F.lit(float("nan"))).alias("v"),
        X.truncate(F.lit("e" * 60)).alias("cut"),
        F.from_json(F.to_json(F.struct(F.lit(1).alias("a"))), "a int").alias("json"),
        X.fmt_adaptive(F.lit(0.00456)).alias("small"),
        X.direction(F.lit(0.0)).alias("flat"),
    ).first()
    assert (r.md, r.now, str(r.zone)) == ("Unknown (b)", "1970-01-01 00:00 UTC", "2026-05-03 17:00:00")
    assert (r.nan, r.names, r.none, r.v, len(r.cut), r.json.a, r.small, r.flat) == (0.0, "x1, x2", "None", "FAIR VALUE", 40, 1, "0.0046", "flat")
    u = one.select(X.time_until(F.lit("2026-05-03 20:00:00"), F.lit("2026-05-01 18:30:30")).alias("u")).first().u
    assert (u.days, u.hours, u.minutes, u.done) == (2, 1, 29, False)


def test_clean_values(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("-",), (None,)], "value string")
    assert [r.value for r in clean_values(df).collect()] == [1.5]
