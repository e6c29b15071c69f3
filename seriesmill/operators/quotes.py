"""Market snapshot: quotes to changes, cards, movers and a text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import scalars as X
from seriesmill.functions import windows as W
from seriesmill.operators.aggregates import sparkline


def quote_change(quotes: DataFrame, price="price", first="chart_prev", second="prev") -> DataFrame:
    """Percent change on the previous close; 0 when no previous close is usable.

    A close of 0 is no close: the second source is tried, as for a missing one.
    """
    zero = F.lit(0.0)
    close = F.coalesce(F.nullif(F.col(first), zero), F.nullif(F.col(second), zero))
    chg = F.coalesce(F.try_divide(F.col(price) - close, close) * 100, zero)
    return quotes.withColumns({"prev_close": close, "change_pct": F.when(F.col(price).isNotNull(), chg)})


def snapshot_table(quotes: DataFrame, dim: DataFrame) -> DataFrame:
    """Every listed ticker with its quote; a ticker without one gets an error text."""
    j = dim.join(quotes, "ticker", "left")
    missing = F.when(F.col("price").isNull(), F.coalesce(F.col("error"), F.lit("no quote")))
    return j.withColumn("error", missing)


def daily_closes(ticks: DataFrame, key: str = "asset", ts: str = "ts", tie: str = "event_id", price: str = "price") -> DataFrame:
    """Last price of each asset and day: (asset, date, value)."""
    return ticks.groupBy(key, F.col(ts).cast("date").alias("date")).agg(
        F.max_by(price, F.struct(ts, tie)).alias("value")
    )


def cards(closes: DataFrame, n: int = 8, keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Latest price, absolute and percent change, class and the last ``n`` values per asset."""
    w = W.by(keys)
    prev = F.lag("value").over(w)
    d = closes.withColumn("_prev", prev)
    g = d.groupBy(*keys).agg(F.max_by("value", "date").alias("price"), F.max_by("_prev", "date").alias("_p"))
    chg = F.col("price") - F.col("_p")
    pct = F.coalesce(F.try_divide(chg, F.col("_p")) * 100, F.lit(0.0))
    g = g.withColumns({"change": F.coalesce(chg, F.lit(0.0)), "change_pct": pct}).drop("_p")
    g = g.withColumn("class", X.positive_class("change_pct"))
    return W.join_back(g, sparkline(closes, n, "value", keys), keys)


def briefing_inputs(ticks: DataFrame, as_of: str, move_pct: float, max_age: str, key="asset") -> DataFrame:
    """Per asset: last close, change on the previous close, whether that is a significant move, and whether the data is stale."""
    closes = daily_closes(ticks, key)
    chg = W.pct_change(closes, keys=(key,), default=0.0)
    last = chg.groupBy(key).agg(F.max_by("value", "date").alias("price"), F.max_by("pct", "date").alias("change_pct"))
    seen = ticks.groupBy(key).agg(F.max("ts").alias("last_ts"))
    stale = F.col("last_ts") < F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {max_age}")
    return last.join(seen, key).select(
        key, "price", "change_pct", (F.abs("change_pct") >= move_pct).alias("significant"), stale.alias("stale")
    )


# Title, width of the rules and of the columns of the text report.
TITLE, RULE_WIDTH = "  MARKET DATA SNAPSHOT", 45
NAME_WIDTH, PRICE_WIDTH, CHANGE_WIDTH = 20, 12, 8


def report_row(name: Column, price: Column, change: Column, fmt: Column, error: Column) -> Column:
    """One text row: name on 20 places, price on 12, signed change on 8, or the first 40 characters of the error."""
    bad = F.concat(F.lit("  "), X.pad_right(name, NAME_WIDTH), F.lit("  Error: "), X.truncate(error, 40))
    ok = F.concat(
        F.lit("  "),
        X.pad_right(name, NAME_WIDTH),
        F.lit(" "),
        X.pad_left(X.fmt_quote(price, fmt), PRICE_WIDTH),
        F.lit("   "),
        X.pad_left(X.fmt_signed(change), CHANGE_WIDTH),
    )
    return F.when(error.isNotNull(), bad).otherwise(ok)


def render_report(rows: DataFrame, report: str = "report_id") -> DataFrame:
    """Sectioned text report per ``report``: (report, ord, part, line).

    Sections follow ``ord``; a header line (part 0) opens every run of one category.
    Rows need ord, category, name, price, change_pct, fmt and error.
    """
    flagged = W.header_flag(rows, "category", [report], "ord")
    line = report_row(F.col("name"), F.col("price"), F.col("change_pct"), F.col("fmt"), F.col("error"))
    text = F.when(F.col("is_header"), F.array(F.lit(""), F.col("category"), line)).otherwise(F.array(line))
    body = flagged.withColumn("_lines", text)
    part = F.col("_i") + F.lit(3) - F.size("_lines")
    return body.select(report, "ord", "_lines", F.posexplode("_lines").alias("_i", "line")).select(
        report, "ord", part.alias("part"), "line"
    )


def frame_report(lines: DataFrame, as_of: Column, width: int = RULE_WIDTH, report: str = "report_id") -> DataFrame:
    """Add title, time stamp and rules above and below the body; sort by (ord, part) to print."""
    rule = F.repeat(F.lit("═"), width)
    ids = lines.select(report).distinct()
    head = [rule, F.lit(TITLE), F.concat(F.lit("  "), X.as_of_text(as_of)), rule]
    top = ids.select(report, F.lit(-1).alias("ord"), F.posexplode(F.array(*head)).alias("part", "line"))
    end = ids.select(report, F.lit(2147483647).alias("ord"), F.posexplode(F.array(F.lit(""), rule)).alias("part", "line"))
    return lines.unionByName(top).unionByName(end)
