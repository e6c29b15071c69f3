"""The star-schema tables and the series and panels derived from them.

Prices are stored with two decimals, so sums are taken over whole cents. Integer
sums do not depend on the order of the rows: a result is the same for every
partitioning, retry and cluster size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FACTORS = ["x1", "x2", "x3", "x4", "x5"]
TOTAL = "TOTAL"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scaled(c: Column, decimals: int) -> Column:
    """A number with so many decimal places as a whole number; ``rint`` stays in primitive arithmetic where ``round`` would
    go through decimals. Only for columns that hold no more places: further ones would be lost."""
    return F.rint(c * 10**decimals).cast("bigint")


def cents(c: Column) -> Column:
    """Whole cents of a column stored with two decimals."""
    return scaled(c, 2)


def mean_of(total: Column, n: Column, decimals: int = 2) -> Column:
    """Mean in currency units from a sum of scaled numbers and a row count; null when n is 0."""
    return F.try_divide(total.cast("double"), n) / 10**decimals


def period(ts: Column, grain: str) -> Column:
    """First day of the week or month; works on dates, so no time zone enters."""
    return F.trunc(ts.cast("date"), grain)


def _sums(priority: Column, amount: Column, n: Column) -> list[Column]:
    """Per-factor sums of (cents, rows), conditional, so no pivot pass is needed."""
    out = [F.sum(amount).alias("s_y"), F.sum(n).alias("n_y")]
    for name, p in zip(FACTORS, PRIORITIES):
        out += [
            F.sum(F.when(priority == p, amount)).alias(f"s_{name}"),
            F.sum(F.when(priority == p, n)).alias(f"n_{name}"),
        ]
    return out


def _means(cols: Sequence[str] = ("y", *FACTORS)) -> list[Column]:
    return [mean_of(F.col(f"s_{c}"), F.col(f"n_{c}")).alias(c) for c in cols]


def price_panel(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """One target and five factors per period over all orders.

    (panel_id, date, y, x1..x5). One pass with map-side combine; the result is
    bounded by the calendar, whatever the number of orders.
    """
    o = table(spark, sf_dir, "orders").select(
        period(F.col("o_orderdate"), grain).alias("date"), "o_orderpriority", cents(F.col("o_totalprice")).alias("c")
    )
    # The key comes out of the aggregate: a literal would be folded away, and joins on it would lose their key.
    key = F.max(F.lit("ALL")).alias("panel_id")
    agg = o.groupBy("date").agg(key, *_sums(F.col("o_orderpriority"), F.col("c"), F.lit(1)))
    return agg.select("panel_id", "date", *_means())


def _orders_by_segment(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """(segment, date, priority, cents, n)."""
    keys = ["segment", period(F.col("o_orderdate"), grain).alias("date"), F.col("o_orderpriority").alias("priority")]
    return orders_with_segment(spark, sf_dir).groupBy(*keys).agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))


def orders_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderdate, o_orderpriority, cents, segment) per order.

    Orders meet customers as they are: combining per customer first would hardly shrink them and cost a shuffle of its
    own. A small customer table is broadcast, so orders stay where they are until they are summed per segment; beyond
    the threshold both sides are shuffled once and adaptive execution splits a customer with too many orders.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", cents(F.col("o_totalprice")).alias("cents"))
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    return orders.join(cust, "o_custkey").drop("o_custkey")


def segment_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, metric, week, month, cents, n): one pass from which weekly and monthly sums both come; weeks are cut at month ends."""
    keys = [F.col("segment").alias("entity"), F.col("o_orderpriority").alias("metric"), period(F.col("o_orderdate"), "week").alias("week"), period(F.col("o_orderdate"), "month").alias("month")]
    return orders_with_segment(spark, sf_dir).groupBy(*keys).agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))


def segment_panels(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    """The same panel once per market segment: (panel_id, date, y, x1..x5)."""
    keys = ["segment", period(F.col("o_orderdate"), grain).alias("date")]
    agg = orders_with_segment(spark, sf_dir).groupBy(*keys).agg(*_sums(F.col("o_orderpriority"), F.col("cents"), F.lit(1)))
    return agg.select(F.col("segment").alias("panel_id"), "date", *_means())


def supplier_series(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    """Many series: mean price and mean quantity per supplier and period.

    (series_id, date, value, x). Partial aggregation leaves at most one row per
    supplier and period in the shuffle of each input partition.
    """
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy(F.col("l_suppkey").alias("series_id"), period(F.col("l_shipdate"), grain).alias("date"))
        .agg(
            F.sum(cents(F.col("l_extendedprice"))).alias("s"),
            F.sum(cents(F.col("l_quantity"))).alias("q"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            "series_id",
            "date",
            mean_of(F.col("s"), F.col("n")).alias("value"),
            mean_of(F.col("q"), F.col("n")).alias("x"),
        )
    )


def sector_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity x metric series with a total over all entities.

    (series_id, entity, metric, date, value, n): entity is the market segment,
    metric the order priority, value the mean order price of the month.
    """
    s = _orders_by_segment(spark, sf_dir, "month").withColumnRenamed("segment", "entity")
    both = s.select(F.explode(F.array(F.col("entity"), F.lit(TOTAL))).alias("entity"), "priority", "date", "cents", "n")
    return (
        both.groupBy("entity", F.col("priority").alias("metric"), "date")
        .agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
        .select(
            F.concat_ws("|", "entity", "metric").alias("series_id"),
            "entity",
            "metric",
            "date",
            mean_of(F.col("cents"), F.col("n")).alias("value"),
            "n",
        )
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a quote stream: (asset, ts, event_id, price). One asset may hold most rows."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("asset"), "ts", "event_id", F.col("value").alias("price")
    )


def read_panel(spark: SparkSession, path: str, names: Sequence[str], fmt: str = "csv", date_format: str | None = None) -> DataFrame:
    """Read wide price files, one panel per file: columns are renamed by position, dates parsed, NaN made null.

    The file name is the panel id. Cells that are no number become null. A date that cannot be read (ISO, or
    ``date_format``), or is missing, stops the job with its file and text: a row without a date would silently shift every return after it.
    The row order of the file does not matter because every later operator orders by date itself.
    """
    reader = spark.read
    raw = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    if len(raw.columns) != 1 + len(names):
        raise ValueError(f"expected {1 + len(names)} columns, found {len(raw.columns)}")
    raw = raw.select("*", F.col("_metadata.file_name").alias("panel_id")).toDF("date", *names, "panel_id")
    text = F.col("date").cast("string")
    if fmt != "csv":
        parsed = F.col("date").cast("date")
    elif date_format:
        parsed = F.try_to_timestamp("date", F.lit(date_format)).cast("date")
    else:
        parsed = F.try_to_timestamp("date").cast("date")
    bad = F.raise_error(F.concat(F.lit("not a date in "), F.col("panel_id"), F.lit(": "), F.coalesce(text, F.lit("nothing"))))
    date = F.coalesce(parsed, bad.cast("date"))
    return raw.select(
        "panel_id",
        date.alias("date"),
        *[F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")).alias(c) for c in names],
    )
