"""Queries on quotes, alerts, texts and scalar functions, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import scalars as X
from seriesmill.functions import windows as W
from seriesmill.operators import as_of as AO
from seriesmill.operators import cleaning as C
from seriesmill.operators import long_series as LS
from seriesmill.operators import moving as MV
from seriesmill.operators import phrases as PH
from seriesmill.operators import quotes as M
from seriesmill.operators import tvp as K
from seriesmill.operators import tvp_parallel as TP
from seriesmill.plans import sql as Q
from seriesmill.plans.registry import query, tidy
from seriesmill.sources import tables as S
from seriesmill.streaming import alerts as R
from seriesmill.streaming import engine as E
from seriesmill.streaming import online as O

ASSETS = ["click", "error", "purchase", "signup", "view"]
BANDS = [("click", 5.0, 120.0), ("error", 4.5, 110.0), ("purchase", 5.5, 100.0), ("signup", 6.0, 130.0), ("view", 5.0, 105.0)]
#: Rows of a chunk of ticks; small, so that borders of chunks matter in every result.
TICKS_PER_CHUNK = 2_000
WORDS = ["tariff", "rate cut", "rate", "license"]

TICKS_X = (
    "obs AS (SELECT event_type AS series_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS t, event_id AS date, value AS y, "
    "[CAST(props ->> '$.k' AS DOUBLE)] AS x FROM events WHERE value IS NOT NULL AND props ->> '$.k' IS NOT NULL)"
)


def _ticks_x(spark, sf) -> DataFrame:
    return S.table(spark, sf, "events").select(
        F.col("event_type").alias("asset"), "ts", "event_id", F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
    )


_T = f"WITH RECURSIVE {Q.TICKS}"
_RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', {lo}::DOUBLE, {hi}::DOUBLE)" for a, lo, hi in BANDS) + ") r(asset, lower, upper))"
_ZONE = "CASE WHEN price > upper THEN 'above' WHEN price < lower THEN 'below' ELSE 'in' END"
_ZONED = f"z AS (SELECT t.*, {_ZONE} AS alert FROM {{src}} t JOIN rules USING (asset))"
_ENTER = "alert <> 'in' AND alert <> coalesce(prev, 'in')"


def rules(spark) -> DataFrame:
    return spark.createDataFrame(BANDS, "asset string, lower double, upper double")


_ALERTS = f"{_T}, {_RULES}, {_ZONED.format(src='ticks')} SELECT * FROM z WHERE alert <> 'in'"


@query("threshold_alerts", _ALERTS)
def threshold_alerts(spark, sf):
    return C.threshold_rule(S.ticks(spark, sf), rules(spark))


_CROSS = (
    f"{_T}, {_RULES}, {_ZONED.format(src='ticks')} SELECT asset, ts, event_id, price, alert FROM "
    f"(SELECT *, lag(alert) OVER (PARTITION BY asset ORDER BY ts, event_id) AS prev FROM z) WHERE {_ENTER}"
)


@query("crossings", _CROSS)
def crossings(spark, sf):
    return LS.crossings(S.ticks(spark, sf), rules(spark))


_TW = "WINDOW w AS (PARTITION BY asset ORDER BY ts, event_id)"


@query("tick_pct_change", f"{_T} SELECT asset, event_id, {Q.rnd('(price - lag(price) OVER w) * 100 / lag(price) OVER w', 'pct')} FROM ticks {_TW}")
def tick_pct_change(spark, sf):
    d = LS.long_pct_change(S.ticks(spark, sf), "price", ["asset"], ["ts", "event_id"])
    return tidy(d.select("asset", "event_id", "pct"))


@query(
    "tick_rolling",
    f"{_T}, r AS (SELECT asset, event_id, price, count(*) OVER f AS c, avg(price) OVER f AS m, stddev_samp(price) OVER f AS s FROM ticks "
    "WINDOW f AS (PARTITION BY asset ORDER BY ts, event_id ROWS 51 PRECEDING)) "
    f"SELECT asset, event_id, {Q.rnd('CASE WHEN c = 52 THEN m END', 'roll_mean')}, {Q.rnd('CASE WHEN c = 52 THEN s END', 'roll_std')}, "
    f"{Q.rnd('CASE WHEN c = 52 THEN (price - m) / s END', 'z')} FROM r",
)
def tick_rolling(spark, sf):
    d = MV.moving_stats(S.ticks(spark, sf), 52, "price", ["asset"], ["ts", "event_id"], rows_per_chunk=LS.ROWS_PER_CHUNK)
    return tidy(d.select("asset", "event_id", "roll_mean", "roll_std", "z"))


_TM = "count(*) OVER f AS c, corr(y, x[1]) OVER f AS r, regr_slope(y, x[1]) OVER g AS b, regr_intercept(y, x[1]) OVER g AS a, regr_r2(y, x[1]) OVER g AS r2, count(*) OVER g AS cg"


@query(
    "tick_corr",
    f"WITH {TICKS_X}, r AS (SELECT *, {_TM} FROM obs WINDOW f AS (PARTITION BY series_id ORDER BY t ROWS 499 PRECEDING), g AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 500 PRECEDING AND 1 PRECEDING)) "
    f"SELECT series_id AS asset, date AS event_id, {Q.rnd('CASE WHEN c = 500 THEN r END', 'corr_k')} FROM r",
)
def tick_corr(spark, sf):
    """Correlation over the last 500 ticks of an asset; the cost of a row does not depend on that number."""
    return tidy(MV.moving_corr(_ticks_x(spark, sf), 500, "price", ["k"], ["asset"], ["ts", "event_id"], LS.ROWS_PER_CHUNK).drop("ts"))


@query(
    "tick_ols",
    f"WITH {TICKS_X}, r AS (SELECT *, {_TM} FROM obs WINDOW f AS (PARTITION BY series_id ORDER BY t ROWS 499 PRECEDING), g AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 500 PRECEDING AND 1 PRECEDING)) "
    f"SELECT series_id AS asset, date AS event_id, {Q.rnd('CASE WHEN cg = 500 THEN a END', 'intercept', 5)}, {Q.rnd('CASE WHEN cg = 500 THEN b END', 'beta_k', 5)}, "
    f"{Q.rnd('CASE WHEN cg = 500 THEN r2 END', 'r2', 5)}, {Q.rnd('CASE WHEN cg = 500 THEN y - a - b * x[1] END', 'oos_resid', 5)} FROM r",
)
def tick_ols(spark, sf):
    """Regression on the 500 ticks before each tick of an asset, and its forecast error."""
    return tidy(MV.moving_ols(_ticks_x(spark, sf), 500, "price", ["k"], ["asset"], ["ts", "event_id"], LS.ROWS_PER_CHUNK).drop("ts"), 5)


@query(
    "tick_running",
    f"{_T}, r AS (SELECT asset, event_id, cents, sum(cents) OVER w AS cum, max(cents) OVER w AS running_max FROM "
    f"(SELECT *, CAST(round(price * 100) AS BIGINT) AS cents FROM ticks) {_TW}) "
    f"SELECT asset, event_id, CAST(cum AS BIGINT) AS cum, running_max, {Q.rnd('CAST(cents AS DOUBLE) / running_max - 1', 'drawdown')} FROM r",
)
def tick_running(spark, sf):
    t = S.ticks(spark, sf).withColumn("cents", S.cents(F.col("price")))
    d = LS.long_running(t, "cents", ["asset"], ["ts", "event_id"])
    return tidy(d.select("asset", "event_id", "cum", "running_max", "drawdown"))


_HITS = ", ".join(f"CASE WHEN contains(lower(text), '{w}') THEN '{w}' END" for w in WORDS)
_ANY = " OR ".join(f"contains(lower(text), '{w}')" for w in WORDS)
_KEYWORDS = f"SELECT doc_id, concat_ws(',', {_HITS}) AS matched FROM documents WHERE {_ANY}"


@query("keyword_alerts", _KEYWORDS)
def keyword_alerts(spark, sf):
    return C.keyword_alerts(S.table(spark, sf, "documents").select("doc_id", "text"), WORDS).drop("text")


@query("clean_values", "SELECT event_id, TRY_CAST(props ->> '$.k' AS DOUBLE) AS value FROM events WHERE event_type <> 'view' AND TRY_CAST(props ->> '$.k' AS DOUBLE) IS NOT NULL")
def clean_values(spark, sf):
    """Numbers read from text; the texts of one kind of event are blanked out and are no values."""
    text = F.when(F.col("event_type") == "view", F.lit("-")).otherwise(F.get_json_object("props", "$.k"))
    return C.clean_values(S.table(spark, sf, "events").select("event_id", text.alias("value")))


@query("phrase_alerts", _KEYWORDS)
def phrase_alerts(spark, sf):
    """The same rows by one pass of an automaton, whatever the number of phrases."""
    return PH.phrase_alerts(S.table(spark, sf, "documents").select("doc_id", "text"), WORDS).drop("text")


_FIRST_WORDS = "lower(array_to_string(string_split(text, ' ')[1:3], ' '))"


@query(
    "phrase_counts",
    f"WITH p AS (SELECT DISTINCT {_FIRST_WORDS} AS phrase FROM benchmark WHERE text <> ''), d AS (SELECT doc_id, lower(text) AS low FROM documents) "
    "SELECT phrase, count(*) AS docs, CAST(sum((length(low) - length(replace(low, phrase, ''))) / length(phrase)) AS BIGINT) AS places FROM d JOIN p ON contains(low, phrase) GROUP BY 1",
)
def phrase_counts(spark, sf):
    """How often the first three words of each benchmark item stand in the documents, all items in one pass."""
    first = F.lower(F.array_join(F.slice(F.split("text", " "), 1, 3), " "))
    items = [r.p for r in S.table(spark, sf, "benchmark").where("text <> ''").select(first.alias("p")).distinct().collect()]
    found = PH.phrase_places(S.table(spark, sf, "documents"), items, ["doc_id"]).groupBy("phrase", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return found.groupBy("phrase").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("places"))


@query(
    "session_filter",
    "SELECT event_id, ts, day(ts) = 1 AS first_of_month FROM events WHERE isodow(ts) <= 5 AND hour(ts) BETWEEN 13 AND 20",
)
def session_filter(spark, sf):
    e = S.table(spark, sf, "events").select("event_id", "ts")
    return e.filter(C.in_session("ts")).withColumn("first_of_month", C.first_of_month("ts"))


_BUCKETS = (
    "buckets AS (SELECT asset, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, arg_max(price, struct_pack(ts := ts, id := event_id)) AS price, "
    "count(*) AS ticks FROM ticks GROUP BY 1, 2)"
)
_DONE = "done AS (SELECT * FROM buckets WHERE bucket + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE)"


@query("bucket_latest", f"{_T}, {_BUCKETS} SELECT asset, bucket, price, ticks FROM buckets")
def bucket_latest(spark, sf):
    b = R.latest_per_bucket(S.ticks(spark, sf))
    return b.select("asset", F.col("bucket").cast("timestamp_ntz").alias("bucket"), "price", "ticks")


def _bucket_cross(src: str) -> str:
    return (
        f"{_ZONED.format(src=src)} SELECT asset, bucket, price, alert FROM "
        f"(SELECT *, lag(alert) OVER (PARTITION BY asset ORDER BY bucket) AS prev FROM z) WHERE {_ENTER}"
    )


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("bucket_crossings", f"{_T}, {_RULES}, {_BUCKETS}, {_bucket_cross('buckets')}")
def bucket_crossings(spark, sf):
    return _ntz(R.bucket_crossings(R.latest_per_bucket(S.ticks(spark, sf)), rules(spark)), "bucket")


_QUOTES = (
    "quotes AS (SELECT asset, date, value AS price, CASE WHEN day(date) % 7 = 0 THEN 0 ELSE lag(value) OVER w END AS chart_prev, "
    "lag(value, 2) OVER w AS prev FROM closes WINDOW w AS (PARTITION BY asset ORDER BY date))"
)


def daily_quotes(spark, sf) -> DataFrame:
    """Daily closes as quotes; every seventh day the first previous close is 0, as a broken feed sends it."""
    c = M.daily_closes(S.ticks(spark, sf))
    first = F.when(F.dayofmonth("date") % 7 == 0, F.lit(0.0)).otherwise(W.lagged("value", ["asset"]))
    return c.select("asset", "date", F.col("value").alias("price"), first.alias("chart_prev"), W.lagged("value", ["asset"], n=2).alias("prev"))


_CHG = (
    "qc AS (SELECT *, coalesce(nullif(chart_prev, 0), nullif(prev, 0)) AS prev_close, "
    "coalesce((price - coalesce(nullif(chart_prev, 0), nullif(prev, 0))) / coalesce(nullif(chart_prev, 0), nullif(prev, 0)) * 100, 0) AS change_pct FROM quotes)"
)


@query("quote_change", f"{_T}, {Q.CLOSES}, {_QUOTES}, {_CHG} SELECT asset, date, price, prev_close, {Q.rnd('change_pct')} FROM qc")
def quote_change(spark, sf):
    q = M.quote_change(daily_quotes(spark, sf))
    return tidy(q.drop("chart_prev", "prev"), exact=["price", "prev_close"])


LISTED = [(1, "view", "Views", "TRAFFIC", "price"), (2, "click", "Clicks", "TRAFFIC", "price"), (3, "refund", "Refunds", "MONEY", "price"),
          (4, "purchase", "Purchases", "MONEY", "price"), (5, "error", "Errors", "HEALTH", "pct"), (6, "signup", "Sign-ups", "HEALTH", "price")]
_DIM = "dim AS (SELECT CAST(ord AS BIGINT) AS ord, ticker, name, category FROM (VALUES " + ", ".join(str(r[:4]) for r in LISTED) + ") d(ord, ticker, name, category))"
_LASTQ = "lq AS (SELECT asset AS ticker, arg_max(price, date) AS price, arg_max(change_pct, date) AS change_pct FROM qc GROUP BY 1)"


def _listed(spark) -> DataFrame:
    return spark.createDataFrame(LISTED, "ord int, ticker string, name string, category string, fmt string")


@query(
    "snapshot_table",
    f"{_T}, {Q.CLOSES}, {_QUOTES}, {_CHG}, {_DIM}, {_LASTQ} SELECT dim.*, price, {Q.rnd('change_pct')}, "
    "CASE WHEN price IS NULL THEN 'no quote' END AS error FROM dim LEFT JOIN lq USING (ticker)",
)
def snapshot_table(spark, sf):
    """A fixed display list joined to the latest quotes; one listed ticker has none."""
    q = M.quote_change(daily_quotes(spark, sf)).groupBy(F.col("asset").alias("ticker"))
    last = q.agg(F.max_by("price", "date").alias("price"), F.max_by("change_pct", "date").alias("change_pct"))
    last = last.withColumn("error", F.lit(None).cast("string"))
    return tidy(M.snapshot_table(last, _listed(spark)).drop("fmt"), exact=["price"])


@query(
    "cards",
    f"{_T}, {Q.CLOSES}, c AS (SELECT *, lag(value) OVER (PARTITION BY asset ORDER BY date) AS p, "
    "row_number() OVER (PARTITION BY asset ORDER BY date DESC) AS rn FROM closes), "
    "t AS (SELECT asset, list(value ORDER BY date) AS trend FROM c WHERE rn <= 8 GROUP BY 1) "
    f"SELECT asset, value AS price, {Q.rnd('value - p', 'change')}, {Q.rnd('(value - p) / p * 100', 'change_pct')}, "
    "CASE WHEN value >= p THEN 'positive' ELSE 'negative' END AS class, trend[1] AS trend_first, trend[len(trend)] AS trend_last, len(trend) AS trend_n FROM c JOIN t USING (asset) WHERE rn = 1",
)
def cards(spark, sf):
    c = M.cards(M.daily_closes(S.ticks(spark, sf)))
    ends = {"trend_first": F.element_at("trend", 1), "trend_last": F.element_at("trend", -1), "trend_n": F.size("trend")}
    return tidy(c.withColumns(ends).drop("trend"), exact=["price", "trend_first", "trend_last"])


@query(
    "briefing_inputs",
    f"{_T}, {Q.CLOSES}, c AS (SELECT *, lag(value) OVER (PARTITION BY asset ORDER BY date) AS p, "
    "row_number() OVER (PARTITION BY asset ORDER BY date DESC) AS rn FROM closes), "
    "seen AS (SELECT asset, max(ts) AS last_ts FROM ticks GROUP BY 1) "
    f"SELECT asset, value AS price, {Q.rnd('coalesce((value - p) * 100 / p, 0)', 'change_pct')}, abs(coalesce((value - p) * 100 / p, 0)) >= 50 AS significant, "
    "last_ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 MINUTE AS stale FROM c JOIN seen USING (asset) WHERE rn = 1",
)
def briefing_inputs(spark, sf):
    return tidy(M.briefing_inputs(S.ticks(spark, sf), "2024-01-31 00:00:00", 50.0, "30 minutes"), exact=["price"])


_ROWS = (
    f"{_RULES}, rows_ AS (SELECT asset, CAST(date - DATE '2000-01-01' AS BIGINT) AS ord, date, price, change_pct, {_ZONE} AS category FROM qc JOIN rules USING (asset)), "
    "flagged AS (SELECT *, category IS DISTINCT FROM lag(category) OVER (PARTITION BY asset ORDER BY ord) AS is_header FROM rows_)"
)


def _report_rows(spark, sf) -> DataFrame:
    """One report per asset, one row per day, the zone of the close as its section."""
    q = M.quote_change(daily_quotes(spark, sf)).join(rules(spark), "asset")
    return q.select(
        F.col("asset").alias("report_id"), F.date_diff("date", F.lit("2000-01-01").cast("date")).alias("ord"), F.col("date").cast("string").alias("name"),
        C.zone(F.col("price"), F.col("lower"), F.col("upper")).alias("category"), (F.col("price") * 100).alias("price"), "change_pct",
        F.lit("price").alias("fmt"), F.lit(None).cast("string").alias("error"),
    )


@query("header_flag", f"{_T}, {Q.CLOSES}, {_QUOTES}, {_CHG}, {_ROWS} SELECT asset AS report_id, ord, category, is_header FROM flagged")
def header_flag(spark, sf):
    return tidy(W.header_flag(_report_rows(spark, sf), "category", ["report_id"], "ord").select("report_id", "ord", "category", "is_header"))


_LINE = (
    "'  ' || rpad(CAST(date AS VARCHAR), 20, ' ') || ' ' || lpad(CASE WHEN price * 100 >= 1000 THEN format('{:,.2f}', price * 100) ELSE printf('%.2f', price * 100) END, 12, ' ') "
    "|| '   ' || lpad(printf('%+.2f%%', change_pct), greatest(8, length(printf('%+.2f%%', change_pct)))::INTEGER, ' ')"
)


@query(
    "report_lines",
    f"{_T}, {Q.CLOSES}, {_QUOTES}, {_CHG}, {_ROWS} SELECT asset AS report_id, ord, CAST(2 AS BIGINT) AS part, {_LINE} AS line FROM flagged "
    "UNION ALL SELECT asset, ord, 0, '' FROM flagged WHERE is_header UNION ALL SELECT asset, ord, 1, category FROM flagged WHERE is_header",
)
def report_lines(spark, sf):
    return tidy(M.render_report(_report_rows(spark, sf)))


_AS_OF = "TIMESTAMP '2000-06-30 18:45:30'"


@query(
    "scalar_suite",
    "WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, o_totalprice AS v, o_totalprice / 1000 - 200 AS s, CAST(o_orderdate AS DATE) AS d, "
    "'M' || lpad(CAST(o_orderkey % 15 AS VARCHAR), 2, '0') AS period, CAST(epoch_ms(o_orderdate) // 1000 AS BIGINT) AS e FROM orders), "
    f"m AS (SELECT *, CAST(substr(period, 2) AS BIGINT) AS month, CAST(epoch_ms({_AS_OF}) // 1000 AS BIGINT) AS now FROM o) "
    "SELECT k, month, CASE WHEN month BETWEEN 1 AND 12 THEN make_date(year(d), month, 1) END AS month_start, substr(p, 3, 3) AS mid, right(p, 3) AS tail, "
    "p || '|' || period AS key, strftime(d, '%Y-%m') AS ym, "
    "CASE WHEN e > now THEN (e - now) // 86400 ELSE 0 END AS days, CASE WHEN e > now THEN (e - now) // 3600 % 24 ELSE 0 END AS hours, "
    "CASE WHEN e > now THEN (e - now) // 60 % 60 ELSE 0 END AS minutes, e <= now AS done, "
    f"{Q.rnd('ln(v)', 'ln_v')}, {Q.rnd('sqrt(v)', 'sqrt_v')}, {Q.rnd('log10(v)', 'log10_v')}, {Q.rnd('abs(s)', 'abs_s', 5)}, {Q.rnd('pow(s / 100, 2)', 'pow_s')}, "
    f"{Q.rnd('pow(10, -4 + 5e0 * (k % 200) / 199)', 'grid')}, printf('%+.1f%%', s + 0.003) AS signed, format('{{:,.1f}}', v + 0.003) AS grouped, "
    "CASE WHEN abs(s / 1000) < 0.01 THEN printf('%.4f', s / 1000 + 0.000003) ELSE printf('%.2f', s / 1000 + 0.000003) END AS adaptive, "
    "CASE WHEN s > 0 THEN 'up' WHEN s < 0 THEN 'down' ELSE 'flat' END AS dir, CASE WHEN s >= 0 THEN 'positive' ELSE 'negative' END AS sign, "
    "CASE WHEN k % 2 = 0 THEN printf('%.2f%%', v) WHEN v >= 1000 THEN format('{:,.2f}', v) ELSE printf('%.2f', v) END AS quote, "
    "rpad(period, 6, ' ') || lpad(right(p, 3), 5, ' ') AS padded, left(p, 4) AS cut, "
    f"{Q.rnd('least(greatest(s, -50), 50)', 'clamped', 5)}, {Q.verdict('s / 50')} AS verdict FROM m",
)
def scalar_suite(spark, sf):
    o = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_totalprice").alias("v"),
        (F.col("o_totalprice") / 1000 - 200).alias("s"), F.col("o_orderdate").alias("ts"), F.col("o_orderdate").cast("date").alias("d"),
        F.concat(F.lit("M"), F.lpad((F.col("o_orderkey") % 15).cast("string"), 2, "0")).alias("period"),
    )
    left = X.time_until("ts", F.expr(_AS_OF))
    return tidy(
        o.select(
            "k",
            X.period_month("period").alias("month"),
            X.month_start(F.year("d"), X.period_month("period")).alias("month_start"),
            X.id_part("p", 3, 3).alias("mid"),
            F.right(F.col("p"), F.lit(3)).alias("tail"),
            X.series_key("p", "period").alias("key"),
            X.fmt_date("d", "yyyy-MM").alias("ym"),
            left["days"].alias("days"), left["hours"].alias("hours"), left["minutes"].alias("minutes"), left["done"].alias("done"),
            F.log("v").alias("ln_v"), F.sqrt("v").alias("sqrt_v"), F.log10("v").alias("log10_v"),
            X.round_to(F.abs("s"), 5).alias("abs_s"), F.pow(F.col("s") / 100, F.lit(2.0)).alias("pow_s"),
            F.element_at(X.log_grid(-4, 1, 200), (F.col("k") % 200 + 1).cast("int")).alias("grid"),
            X.fmt_signed(F.col("s") + 0.003, 1).alias("signed"), X.fmt_grouped(F.col("v") + 0.003, 1).alias("grouped"),
            F.when(F.abs(F.col("s") / 1000) < 0.01, X.fmt_adaptive(F.col("s") / 1000 + 0.000003))
            .otherwise(F.format_string("%.2f", F.col("s") / 1000 + 0.000003)).alias("adaptive"),
            X.direction("s").alias("dir"), X.positive_class("s").alias("sign"),
            X.fmt_quote("v", F.when(F.col("k") % 2 == 0, "pct").otherwise("price")).alias("quote"),
            F.concat(X.pad_right("period", 6), X.pad_left(F.right(F.col("p"), F.lit(3)), 5)).alias("padded"),
            X.truncate("p", 4).alias("cut"),
            X.round_to(X.clamp("s", -50.0, 50.0), 5).alias("clamped"),
            X.verdict(F.col("s") / 50).alias("verdict"),
        )
    )


# Streams over the events and documents files, run to the end of the data.


def _tick_stream(spark, sf) -> DataFrame:
    return E.tick_stream(spark, f"{sf}/events.parquet")


@query("stream_alerts", _ALERTS)
def stream_alerts(spark, sf):
    out = R.stream_alerts(_tick_stream(spark, sf).drop("k"), rules(spark))
    return _ntz(E.run_to_table(out, "alerts"), "ts")


@query("stream_keywords", _KEYWORDS)
def stream_keywords(spark, sf):
    docs = E.stream_table(spark, f"{sf}/documents.parquet").select("doc_id", "text")
    return E.run_to_table(R.stream_keywords(docs, WORDS).drop("text"), "keywords")


@query("stream_bucket_latest", f"{_T}, {_BUCKETS}, {_DONE} SELECT asset, bucket, price, ticks FROM done")
def stream_bucket_latest(spark, sf):
    """Intervals the watermark has passed; the newest ones are still open."""
    out = R.latest_per_bucket(_tick_stream(spark, sf)).drop("bucket_end")
    return _ntz(E.run_to_table(out, "buckets"), "bucket")


@query("stream_crossings", f"{_T}, {_RULES}, {_BUCKETS}, {_DONE}, {_bucket_cross('done')}")
def stream_crossings(spark, sf):
    return _ntz(E.run_to_table(R.stream_crossings(_tick_stream(spark, sf), rules(spark)), "crossings"), "bucket")


_ENTRIES = (
    f"{_ZONED.format(src='ticks')}, e AS (SELECT asset, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, alert FROM "
    f"(SELECT *, lag(alert) OVER (PARTITION BY asset ORDER BY ts, event_id) AS prev FROM z) WHERE {_ENTER})"
)


@query("stream_entries", f"{_T}, {_RULES}, {_ENTRIES} SELECT DISTINCT asset, bucket, alert FROM e WHERE bucket + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE")
def stream_entries(spark, sf):
    """Edge alerts on ticks: every interval and zone into which some tick of the interval crosses."""
    out = E.run_to_table(R.stream_entries(_tick_stream(spark, sf), rules(spark)), "entries")
    return _ntz(out.select("asset", "bucket", "alert"), "bucket")


@query(
    "stream_snapshot",
    f"{_T} SELECT asset, max(ts) AS ts, arg_max(event_id, struct_pack(ts := ts, id := event_id)) AS event_id, "
    "arg_max(price, struct_pack(ts := ts, id := event_id)) AS price FROM ticks GROUP BY 1",
)
def stream_snapshot(spark, sf):
    return _ntz(R.stream_snapshot(_tick_stream(spark, sf)), "ts")


_DAYS = (
    "days AS (SELECT event_type AS asset, CAST(ts AS DATE) AS date, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS y, "
    "CAST(sum(100 * CAST(props->>'$.k' AS BIGINT)) AS DOUBLE) / count(*) / 100 AS x FROM events GROUP BY 1, 2)"
)
_OBS = (
    "obs AS (SELECT asset AS series_id, row_number() OVER (PARTITION BY asset ORDER BY date) AS t, date, y, [x] AS x FROM days "
    "WHERE date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)"
)


@query(
    "stream_tvp",
    f"WITH RECURSIVE {_DAYS}, {_OBS}, {Q.kalman(1, 0.001, 100.0)} SELECT kf.series_id AS asset, date, obs.y, {Q.rnd('innov', k=5)}, {Q.rnd('b[1]', 'beta')} "
    "FROM kf JOIN obs ON obs.series_id = kf.series_id AND obs.t = kf.t",
)
def stream_tvp(spark, sf):
    out = E.run_to_table(O.stream_tvp(O.daily_pairs(_tick_stream(spark, sf), decimals=2), 0.001, 100.0), "innovations")
    return tidy(out.select("asset", "date", "y", F.round("innov", 5).alias("innov"), F.col("beta")[0].alias("beta")), exact=["y"])


_ALL_DAYS = "obs AS (SELECT asset AS series_id, row_number() OVER (PARTITION BY asset ORDER BY date) AS t, date, y, [x] AS x FROM days)"


@query(
    "tvp_daily",
    f"WITH RECURSIVE {_DAYS}, {_ALL_DAYS}, {Q.kalman(1, 0.001, 100.0)} SELECT kf.series_id AS asset, date, obs.y, {Q.rnd('innov', k=5)}, {Q.rnd('innov_var', k=3)} "
    "FROM kf JOIN obs ON obs.series_id = kf.series_id AND obs.t = kf.t",
)
def tvp_daily(spark, sf):
    """Batch twin of the stream over all days, the open last one included."""
    f = K.tvp_filter(_daily(spark, sf), "y", ["x"], 0.001, 100.0, ["asset"]).drop("beta", "se")
    return tidy(f.withColumns({"innov": F.round("innov", 5), "innov_var": F.round("innov_var", 3)}), exact=["y"])


def _daily(spark, sf) -> DataFrame:
    E.use_utc(spark)
    t = S.table(spark, sf, "events").select(
        F.col("event_type").alias("asset"), "ts", "event_id", F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
    )
    return O.daily_pairs(t, decimals=2)


_QUOTED = "SELECT user_id, ts, max(value) AS rate FROM events WHERE event_type = 'signup' AND value IS NOT NULL GROUP BY 1, 2"


@query(
    "tick_rate",
    f"SELECT t.event_id, t.user_id, t.value AS price, q.rate, q.ts AS rate_ts, {Q.rnd('t.value * q.rate / 100', 'converted')} FROM "
    f"(SELECT * FROM events WHERE event_type <> 'signup') t ASOF LEFT JOIN ({_QUOTED}) q ON t.user_id = q.user_id AND t.ts >= q.ts",
)
def tick_rate(spark, sf):
    """Every other tick of a user with the user's rate in force, taken from the sign-ups: no window holds a user."""
    e = S.table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts", F.col("value").alias("price"))
    rates = e.where("event_type = 'signup'").select("user_id", "ts", F.col("price").alias("rate"))
    d = AO.as_of_join(e.where("event_type <> 'signup'"), rates, ["user_id"], "ts", ["rate"], "rate_ts", rows_per_chunk=TICKS_PER_CHUNK)
    return tidy(d.select("event_id", "user_id", "price", "rate", "rate_ts", (F.col("price") * F.col("rate") / 100).alias("converted")))


@query(
    "tick_as_large",
    f"{_T} SELECT t.asset, t.event_id, t.price, (SELECT max(s.ts) FROM ticks s WHERE s.asset = t.asset AND (s.ts, s.event_id) < (t.ts, t.event_id) AND s.price >= t.price) AS since "
    "FROM ticks t WHERE t.price IS NOT NULL",
)
def tick_as_large(spark, sf):
    """For every tick the last earlier one of its asset at a price as high."""
    d = AO.last_as_large(S.ticks(spark, sf), "price", ["asset"], ["ts", "event_id"], rows_per_chunk=TICKS_PER_CHUNK)
    return d.select("asset", "event_id", "price", "since")


@query(
    "tick_tvp",
    f"WITH RECURSIVE {TICKS_X}, {Q.kalman(1, 0.0001, 900.0)} SELECT kf.series_id AS asset, date AS event_id, {Q.rnd('b[1]', 'beta', 5)}, {Q.rnd('innov', k=4)}, {Q.rnd('innov_var', k=3)} "
    "FROM kf JOIN obs ON obs.series_id = kf.series_id AND obs.t = kf.t",
)
def tick_tvp(spark, sf):
    """Beta and innovation at every tick of an asset, in parallel over time."""
    f = TP.long_tvp_filter(_ticks_x(spark, sf), "price", ["k"], 0.0001, 900.0, ["asset"], ["ts", "event_id"], rows_per_chunk=TICKS_PER_CHUNK)
    return tidy(f.select("asset", "event_id", F.round(F.col("beta")[0], 5).alias("beta"), F.round("innov", 4).alias("innov"), F.round("innov_var", 3).alias("innov_var")))


@query(
    "tick_tvp_smooth",
    f"WITH RECURSIVE {TICKS_X}, {Q.kalman(1, 0.0001, 900.0)}, {Q.smoother(1, 0.0001, 900.0)} SELECT series_id AS asset, date AS event_id, "
    f"{Q.rnd('sb[1] * x[1]', 'fitted', 4)}, {Q.rnd('sb[1]', 'beta', 5)}, {Q.rnd('sqrt(sv[1])', 'se', 5)} FROM sm",
)
def tick_tvp_smooth(spark, sf):
    """Smoothed beta at every tick of an asset, in parallel over time."""
    f = TP.long_tvp_smooth(_ticks_x(spark, sf), "price", ["k"], 0.0001, 900.0, ["asset"], ["ts", "event_id"], rows_per_chunk=TICKS_PER_CHUNK)
    return tidy(f.select("asset", "event_id", F.round("fitted", 4).alias("fitted"), F.round("beta", 5).alias("beta"), F.round("se", 5).alias("se")))


@query(
    "tick_tvp_loglik",
    f"WITH RECURSIVE {TICKS_X}, {Q.kalman(1, 0.0001, 900.0)} SELECT series_id AS asset, count(*) AS n, "
    f"{Q.rnd('sum(-0.5 * (ln(2 * pi()) + ln(innov_var) + innov * innov / innov_var))', 'loglik', 3)} FROM kf WHERE t > 0 GROUP BY 1",
)
def tick_tvp_loglik(spark, sf):
    """Likelihood of all ticks of an asset, from maps of its chunks alone."""
    f = TP.long_tvp_loglik(_ticks_x(spark, sf), "price", ["k"], 0.0001, 900.0, ["asset"], ["ts", "event_id"], rows_per_chunk=TICKS_PER_CHUNK)
    return tidy(f, 3)


_VARIANCES = [(100.0, 0.001), (900.0, 0.001), (900.0, 0.1)]


@query(
    "tvp_loglik",
    " UNION ALL ".join(
        f"SELECT * FROM (WITH RECURSIVE {_DAYS}, {_ALL_DAYS}, {Q.kalman(1, q, h)} SELECT series_id AS asset, {h}::DOUBLE AS h, {q}::DOUBLE AS q, "
        f"{Q.rnd('sum(-0.5 * (ln(2 * pi()) + ln(innov_var) + innov * innov / innov_var))', 'loglik', 3)} FROM kf GROUP BY 1)"
        for h, q in _VARIANCES
    ),
)
def tvp_loglik(spark, sf):
    """The likelihood of the daily model at three pairs of variances."""
    return tidy(K.tvp_loglik(_daily(spark, sf), "y", ["x"], _VARIANCES, ["asset"]), 3)
