"""Queries on landed documents and sinks: the tables written in each document shape, read back and compared with themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import scalars as X
from seriesmill.operators import cleaning as C
from seriesmill.plans import sql as Q
from seriesmill.plans.registry import query, tidy
from seriesmill.session import fresh_path
from seriesmill.sources import dimensions as D
from seriesmill.sources import documents as J
from seriesmill.sources import landed as LF
from seriesmill.sources import publish as P
from seriesmill.sources import tables as S
from seriesmill.sources.dimensions import display_order
from seriesmill.streaming import engine as E

_S = f"WITH {Q.SERIES}"
_FLAGS = ["A", "R", "N"]
_KEEP = ("series_id",)


def _loads(spark, sf) -> DataFrame:
    """(load, series_id, date, value): three loads that overlap."""
    li = S.table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin(_FLAGS))
    load = F.array_position(F.array(*[F.lit(f) for f in _FLAGS]), F.col("l_returnflag")) - 1
    keys = [load.alias("load"), F.col("l_suppkey").alias("series_id"), S.period(F.col("l_shipdate"), "month").alias("date")]
    g = li.groupBy(*keys).agg(F.sum(S.cents(F.col("l_extendedprice"))).alias("s"), F.count(F.lit(1)).alias("n"))
    return g.select("load", "series_id", "date", S.mean_of(F.col("s"), F.col("n")).alias("value"))


_LOADED = (
    "l AS (SELECT list_position(['A', 'R', 'N'], l_returnflag) - 1 AS load, l_suppkey AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, "
    f"{Q._mean(Q._cents('l_extendedprice'))} AS value FROM lineitem WHERE l_returnflag IN ('A', 'R', 'N') GROUP BY 1, 2, 3)"
)


@query("landed_series", f"WITH {_LOADED}, top AS (SELECT series_id, max(load) AS load FROM l GROUP BY 1) SELECT CAST(series_id AS VARCHAR) AS series_id, date, value FROM l JOIN top USING (series_id, load) WHERE month(date) <> 12")
def landed_series(spark, sf):
    """Nested series documents: a later one replaces a series; Decembers are written as annual averages and as NaN, and are no points."""
    year, month = F.year("date").cast("string"), F.month("date")
    period = F.when((month == 12) & (F.year("date") % 2 == 0), F.lit("M13")).otherwise(F.format_string("M%02d", month))
    value = F.when((month == 12) & (F.year("date") % 2 == 1), F.lit("NaN")).otherwise(F.col("value").cast("string"))
    point = F.struct(year.alias("year"), period.alias("period"), value.alias("value"))
    series = _loads(spark, sf).groupBy("load", "series_id").agg(F.collect_list(point).alias("data"))
    entry = F.struct(F.col("series_id").cast("string").alias("seriesID"), "data")
    empty = F.struct(F.lit("unused").alias("seriesID"), F.array().cast("array<struct<year: string, period: string, value: string>>").alias("data"))
    body = F.to_json(F.struct(F.struct(F.array(entry, empty).alias("series")).alias("Results")))
    return J.series_from_documents(series.select("load", body.alias("body")), "body", "load")


@query(
    "decoded_ids",
    f"{_S}, i AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{c}', '{n}')" for k, (c, n) in enumerate(D.INDUSTRY_CODES)) + ") AS t(k, code, entity)), "
    "m AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{c}', '{n}')" for k, (c, n) in enumerate(D.METRIC_CODES)) + ") AS t(k, code, metric)), "
    "o AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{n}')" for k, n in enumerate(D.INDUSTRY_ORDER, 1)) + ") AS t(ord, entity)) "
    "SELECT DISTINCT series_id AS supplier, coalesce(i.entity, 'Unknown (999)') AS entity, m.metric, coalesce(i.entity, 'Unknown (999)') || '|' || m.metric AS key, CAST(o.ord AS BIGINT) AS ord "
    "FROM series LEFT JOIN i ON i.k = series_id % 14 JOIN m ON m.k = series_id % 5 LEFT JOIN o ON o.entity = i.entity",
)
def decoded_ids(spark, sf):
    """Ids made of an industry and a metric code, one industry unknown, back to labels, with their display position."""
    codes = F.array(*[F.lit(c) for c, _ in D.INDUSTRY_CODES], F.lit("999"))
    metrics = F.array(*[F.lit(c) for c, _ in D.METRIC_CODES])
    ids = S.supplier_series(spark, sf).select(F.col("series_id").alias("supplier")).distinct()
    ids = ids.withColumn("series_id", F.concat(F.lit("JTS"), F.get(codes, (F.col("supplier") % 14).cast("int")), F.lit("00000"), F.get(metrics, (F.col("supplier") % 5).cast("int"))))
    out = J.decode_series_ids(ids, D.industries(spark), D.metrics(spark))
    return tidy(out.join(display_order(spark), "entity", "left").select("supplier", "entity", "metric", "key", "ord"))


@query(
    "landed_quotes",
    "SELECT event_id, CASE WHEN event_id % 7 > 3 THEN value END AS price, CASE WHEN event_id % 7 > 4 THEN 0.0 WHEN event_id % 7 = 4 THEN value END AS chart_prev, "
    "CASE WHEN event_id % 7 > 3 THEN value END AS prev, CASE event_id % 7 WHEN 0 THEN 'no document' WHEN 1 THEN 'malformed document' WHEN 2 THEN 'no result in document' "
    "WHEN 3 THEN 'no price in document' END AS error FROM events",
)
def landed_quotes(spark, sf):
    """A quote document per event: missing, cut off, empty, without a price, and whole ones with and without a usable close."""
    kind = F.col("event_id") % 7
    meta = F.struct(
        F.when(kind > 3, F.col("value")).alias("regularMarketPrice"),
        F.when(kind > 4, F.lit(0.0)).when(kind == 4, F.col("value")).alias("chartPreviousClose"),
        F.when(kind > 3, F.col("value")).alias("previousClose"),
    )
    result = F.when(kind == 2, F.array().cast("array<struct<meta: struct<regularMarketPrice: double, chartPreviousClose: double, previousClose: double>>>")).otherwise(F.array(F.struct(meta.alias("meta"))))
    whole = F.to_json(F.struct(F.struct(result.alias("result")).alias("chart")))
    body = F.when(kind == 1, F.left(whole, F.lit(20))).when(kind > 1, whole)
    raw = S.table(spark, sf, "events").select("event_id", body.alias("body"))
    return J.read_quotes(raw, ticker="event_id").withColumnRenamed("ticker", "event_id")


def _points(spark, sf) -> DataFrame:
    return S.supplier_series(spark, sf).groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), "value", "x"))).alias("p"))


@query("landed_points", f"{_S} SELECT series_id, date, value FROM series")
def landed_points(spark, sf):
    """``[{date, value}]`` and ``[{date, price}]`` texts."""
    named = F.when(F.col("series_id") % 2 == 0, F.to_json(F.transform("p", lambda p: F.struct(p.date.alias("date"), p.value.alias("value")))))
    text = named.otherwise(F.to_json(F.transform("p", lambda p: F.struct(p.date.alias("date"), p.value.alias("price")))))
    return J.series_from_points(_points(spark, sf).withColumn("text", text), "text", _KEEP)


@query("landed_scatter", f"{_S} SELECT series_id, x, value AS y, date FROM series")
def landed_scatter(spark, sf):
    """``[{x, y, date}]`` texts."""
    text = F.to_json(F.transform("p", lambda p: F.struct(p.x.alias("x"), p.value.alias("y"), p.date.alias("date"))))
    return J.points_xy(_points(spark, sf).withColumn("text", text), "text", _KEEP)


@query("landed_pairs", f"{_S} SELECT series_id, date, value FROM series")
def landed_pairs(spark, sf):
    """``[[date, value]]`` texts."""
    pair = F.transform("p", lambda p: F.concat(F.lit('["'), p.date, F.lit('",'), p.value.cast("string"), F.lit("]")))
    text = F.concat(F.lit("["), F.array_join(pair, ","), F.lit("]"))
    return J.series_from_pairs(_points(spark, sf).withColumn("text", text), "text", _KEEP)


@query(
    "landed_parallel",
    f"{_S}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos FROM series) "
    "SELECT series_id, 'price' AS series, CAST(pos AS BIGINT) AS pos, CAST(date AS VARCHAR) AS label, CASE WHEN pos % 5 <> 4 THEN value END AS value FROM n "
    "UNION ALL SELECT series_id, 'quantity', CAST(pos AS BIGINT), CAST(date AS VARCHAR), x FROM n",
)
def landed_parallel(spark, sf):
    """Labels and two data arrays side by side; every fifth price is a hole."""
    holes = F.transform("p", lambda p, i: F.when(i % 5 != 4, p.value))
    sets = F.array(F.struct(F.lit("price").alias("label"), holes.alias("data")), F.struct(F.lit("quantity").alias("label"), F.transform("p", lambda p: p.x).alias("data")))
    text = F.to_json(F.struct(F.transform("p", lambda p: p.date).alias("labels"), sets.alias("datasets")), {"ignoreNullFields": "false"})
    return tidy(J.series_from_parallel(_points(spark, sf).withColumn("text", text), "text", _KEEP), exact=["value"])


@query(
    "landed_cards",
    "WITH c AS (SELECT c_nationkey AS n_nationkey, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS price, count(*) AS n FROM customer GROUP BY 1) "
    "SELECT r_name AS category, row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS ord, n_name AS name, 'N' || n_nationkey AS ticker, price, "
    "CAST(n AS DOUBLE) AS change, -price AS change_pct, [price, 2.5] AS trend, n_nationkey % 2 = 0 AS is_pct FROM c JOIN nation USING (n_nationkey) JOIN region ON n_regionkey = r_regionkey",
)
def landed_cards(spark, sf):
    """Cards of the nations by region, every second one without the flag."""
    n = S.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(S.mean_of(F.sum(S.cents(F.col("c_acctbal"))), F.count(F.lit(1))).alias("price"), F.count(F.lit(1)).alias("n"))
    n = n.join(S.table(spark, sf, "nation"), "n_nationkey").join(S.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    card = F.struct(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), "n_nationkey").alias("ticker"), "price", F.col("n").cast("double").alias("change"),
        (-F.col("price")).alias("changePct"), F.array("price", F.lit(2.5)).alias("trend"), F.when(F.col("n_nationkey") % 2 == 0, F.lit(True)).alias("isPct"),
    )
    text = F.to_json(F.create_map(F.first("r_name"), F.array_sort(F.collect_list(card))))
    return tidy(J.cards_from_json(n.groupBy("r_regionkey").agg(text.alias("text")), "text"), exact=["price", "change", "change_pct"])


@query("landed_panel", f"WITH {Q.panel('week')} SELECT date, y, {', '.join(S.FACTORS)} FROM panel")
def landed_panel(spark, sf):
    """The weekly panel through wide CSV files in the shared folder."""
    path = fresh_path(spark, "panel-csv")
    S.price_panel(spark, sf, "week").drop("panel_id").write.option("header", True).csv(path)
    return S.read_panel(spark, path, ["y", *S.FACTORS]).drop("panel_id")


@query("stored_snapshot", f"{_S} SELECT series_id, max(date) AS date, arg_max(value, date) AS value FROM series GROUP BY 1")
def stored_snapshot(spark, sf):
    """The latest points as a snapshot file, read back."""
    path = fresh_path(spark, "snapshot-json")
    latest = S.supplier_series(spark, sf).groupBy("series_id").agg(F.max("date").alias("date"), F.max_by("value", "date").alias("value"))
    P.write_snapshot(latest, path)
    return spark.read.schema(latest.schema).json(path)


@query("stored_series", f"WITH {_LOADED} SELECT CAST(load AS VARCHAR) AS metric, series_id, date, value FROM l WHERE load = 1")
def stored_series(spark, sf):
    """Long series stored by metric; a filter reads one folder."""
    path = fresh_path(spark, "series-by-metric")
    P.write_series(_loads(spark, sf).withColumn("metric", F.col("load").cast("string")).drop("load"), path)
    return spark.read.schema("series_id bigint, date date, value double, metric string").parquet(path).filter("metric = '1'")


@query("published_sections", "SELECT l_returnflag AS section, count(*) * CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, l_returnflag")
def published_sections(spark, sf):
    """Three sections; one is published again with other rows, one is emptied, one is left as it is."""
    path = fresh_path(spark, "sections")
    counts = S.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    for flag in _FLAGS:
        P.publish(counts.filter(F.col("l_returnflag") == flag).select("n"), path, flag)
    P.publish(counts.filter("l_returnflag = 'R'").select((F.col("n") * 2).alias("n")), path, "R")
    P.publish(counts.filter("false").select("n"), path, "N")
    return spark.read.schema("n bigint, section string").parquet(path)


_ZONES = {"click": "north", "view": "south"}


@query(
    "event_labels",
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'north' WHEN 'view' THEN 'south' ELSE 'elsewhere' END AS label, strftime(ts, '%Y-%m-%d %H:%M') || ' UTC' AS as_of, "
    "ts - INTERVAL 3 HOUR AS local_ts, CASE WHEN event_id % 3 = 0 THEN -1.0 ELSE value END AS filled FROM events",
)
def event_labels(spark, sf):
    """Default labels, report time stamps, another zone's wall clock, NaN to a default."""
    labels = F.create_map(*[F.lit(x) for kv in _ZONES.items() for x in kv])
    hole = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return S.table(spark, sf, "events").select(
        "event_id",
        X.map_default(labels, F.col("event_type"), F.lit("elsewhere")).alias("label"),
        X.as_of_text(F.col("ts")).alias("as_of"),
        X.to_zone("ts", "America/Sao_Paulo").alias("local_ts"),
        X.nan_to(hole, -1.0).alias("filled"),
    )


@query("point_lookup", f"WITH {Q.SECTORS} SELECT entity, metric, date, value FROM sectors WHERE entity = 'BUILDING' AND metric = '3-MEDIUM'")
def point_lookup(spark, sf):
    return C.get_series(S.sector_series(spark, sf), "BUILDING", "3-MEDIUM").select("entity", "metric", "date", "value")


_FOLDER = (
    f"{_S} SELECT series_id, CASE WHEN month(date) <> 12 THEN date END AS date, value, CASE WHEN month(date) = 12 THEN 'no date: ' || strftime(date, '%Y/%m') END AS reason "
    "FROM series WHERE series_id % 7 <> 0 AND value IS NOT NULL UNION ALL SELECT DISTINCT series_id, CAST(NULL AS DATE), CAST(NULL AS DOUBLE), 'malformed document' FROM series WHERE series_id % 7 = 0"
)


def _folder(spark, sf) -> str:
    """A folder with a document per supplier below a folder of its own: every seventh breaks off, Decembers have no readable date."""
    said = F.when(F.month("date") == 12, F.date_format("date", "yyyy/MM")).otherwise(F.col("date").cast("string"))
    points = F.transform(F.array_sort(F.collect_list(F.struct("date", "value", said.alias("said")))), lambda p: F.struct(p["said"].alias("date"), p["value"].alias("value")))
    docs = S.supplier_series(spark, sf).where("value IS NOT NULL").groupBy("series_id").agg(F.to_json(points).alias("body"))
    path = fresh_path(spark, "landed-folder")
    broken = F.when(F.col("series_id") % 7 == 0, F.substring("body", 1, 20)).otherwise(F.col("body"))
    docs.select("series_id", broken.alias("value")).repartition("series_id").write.partitionBy("series_id").text(path)
    return path


def _of_supplier(rows: DataFrame) -> DataFrame:
    return rows.select(F.regexp_extract("file", "series_id=([0-9]+)/", 1).cast("bigint").alias("series_id"), "date", "value", "reason")


@query("landed_folder", _FOLDER)
def landed_folder(spark, sf):
    """All records of a folder of documents, and why the others could not be read."""
    return _of_supplier(LF.read_landed(spark, [_folder(spark, sf)], "points"))


@query("stream_landed_folder", _FOLDER)
def stream_landed_folder(spark, sf):
    """The same folder as a stream."""
    return _of_supplier(E.run_to_table(LF.stream_landed(spark, _folder(spark, sf), "points"), "landed-rows"))
