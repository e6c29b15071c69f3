"""Landed JSON documents to series, quotes and cards, all with explicit schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions import scalars as X

SERIES_SCHEMA = (
    "Results struct<series: array<struct<seriesID: string, "
    "data: array<struct<year: string, period: string, value: string>>>>>"
)
QUOTE_SCHEMA = (
    "chart struct<result: array<struct<meta: struct<"
    "regularMarketPrice: double, chartPreviousClose: double, previousClose: double>>>>"
)
CARD_SCHEMA = (
    "map<string, array<struct<name: string, ticker: string, price: double, change: double, "
    "changePct: double, trend: array<double>, isPct: boolean>>>"
)


def read_series_json(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Nested series documents, one row per observation: (series_id, date, value).

    Files, folders and patterns are given in order; the files of a folder or pattern follow in the order of their full
    paths. A later file replaces a series of an earlier one, as does a later entry of the same file; series without data
    replace nothing. One reader takes all files; their order is a small table by full path, and a file that is read
    without being in it stops the job. The winner is picked by a mergeable aggregate per series, never by sorting all
    rows of a series in one task.
    """
    files = files_of(spark, paths)
    if len(set(files)) < len(files):
        raise ValueError("a file is given twice, so it has no place in the order")
    order = spark.createDataFrame(list(enumerate(files)), "file_no int, file string")
    # The reader gives paths as encoded URIs, in which a plus is a plus.
    read = _plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    docs = spark.read.schema(SERIES_SCHEMA).option("multiLine", True).json([_literal(f) for f in files]).withColumn("file", read)
    placed = docs.join(order.withColumn("file", _plain(F.col("file"))), "file", "left")
    lost = F.raise_error(F.concat(F.lit("file without a place in the order: "), F.col("file"))).cast("int")
    return _latest_series(placed.withColumn("file_no", F.coalesce("file_no", lost)))


def _plain(uri: Column) -> Column:
    """A path with one slash behind its scheme, however many it came with."""
    return F.regexp_replace(uri, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _literal(path: str) -> str:
    """A path as a pattern that matches nothing else."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def files_of(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files behind paths, folders and patterns, in order; hidden files and folders are left out. Nothing found: an error."""
    out = []
    for path in paths:
        start = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = start.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.globStatus(start)
        here = []
        for status in found or []:
            if not status.isDirectory():
                here.append(status.getPath().toString())
                continue
            top, inside = status.getPath().toString(), fs.listFiles(status.getPath(), True)
            while inside.hasNext():
                file = inside.next().getPath().toString()
                if not any(part.startswith(("_", ".")) for part in file[len(top) :].split("/")):
                    here.append(file)
        if not here:
            raise FileNotFoundError(f"no file at {path}")
        out += sorted(here)
    return out


def series_from_documents(df: DataFrame, body: str, order: str) -> DataFrame:
    """The same for documents held as text, one per row; a document with a higher ``order`` replaces series of a lower one."""
    parsed = F.from_json(body, SERIES_SCHEMA).alias("d")
    return _latest_series(df.select(F.col(order).alias("file_no"), parsed).select("file_no", "d.*"))


def _latest_series(docs: DataFrame) -> DataFrame:
    series = docs.select("file_no", F.posexplode("Results.series").alias("entry", "s"))
    series = series.select(F.col("s.seriesID").alias("series_id"), "file_no", "entry", F.col("s.data").alias("data"))
    series = series.filter(F.size("data") > 0)
    latest = series.groupBy("series_id").agg(F.max_by("data", F.struct("file_no", "entry")).alias("data"))
    points = latest.select("series_id", F.explode("data").alias("p"))
    return points.select(
        "series_id",
        X.month_start(F.col("p.year").try_cast("int"), X.period_month(F.col("p.period"))).alias("date"),
        X.nan_to(F.col("p.value").try_cast("double"), None).alias("value"),
    ).filter("date is not null and value is not null")


def decode_series_ids(series: DataFrame, industry: DataFrame, metric: DataFrame) -> DataFrame:
    """Add entity and metric labels from the parts of the id; unknown codes are labelled as such."""
    from seriesmill.operators.joins import label_codes

    s = series.withColumn("industry_code", X.id_part(F.col("series_id"), 4, 3)).withColumn(
        "metric_code", F.right(F.col("series_id"), F.lit(3))
    )
    s = label_codes(s, industry, code="industry_code", out="entity")
    s = label_codes(s, metric, code="metric_code", out="metric")
    return s.withColumn("key", X.series_key("entity", "metric"))


def read_quotes(raw: DataFrame, body: str = "body", ticker: str = "ticker") -> DataFrame:
    """Quote documents to (ticker, price, chart_prev, prev, error); a bad document becomes an error row that tells why."""
    q = raw.select(ticker, body, F.from_json(body, QUOTE_SCHEMA).alias("q"))
    meta = F.try_element_at(F.col("q.chart.result"), F.lit(1))["meta"]
    out = q.select(
        F.col(ticker).alias("ticker"),
        meta["regularMarketPrice"].alias("price"),
        meta["chartPreviousClose"].alias("chart_prev"),
        meta["previousClose"].alias("prev"),
        F.when(F.col(body).isNull() | (F.trim(body) == ""), F.lit("no document"))
        .when(F.try_parse_json(body).isNull(), F.lit("malformed document"))
        .when(F.coalesce(F.size("q.chart.result"), F.lit(0)) <= 0, F.lit("no result in document"))
        .when(meta["regularMarketPrice"].isNull(), F.lit("no price in document"))
        .alias("error"),
    )
    return out


def series_from_points(df: DataFrame, col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``[{date, value}]`` text to rows. ``price`` is accepted as the name of the value."""
    arr = F.from_json(col, "array<struct<date: string, value: double, price: double>>")
    return df.select(*keep, F.inline(arr)).select(
        *keep, F.col("date").try_cast("date").alias("date"), F.coalesce("value", "price").alias("value")
    )


def points_xy(df: DataFrame, col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``[{x, y, date}]`` text to rows (scatter points)."""
    arr = F.from_json(col, "array<struct<x: double, y: double, date: string>>")
    return df.select(*keep, F.inline(arr)).withColumn("date", F.col("date").try_cast("date"))


def series_from_pairs(df: DataFrame, col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``[[date, value]]`` text to rows."""
    pairs = F.from_json(col, "array<array<string>>")
    arr = F.transform(
        pairs,
        lambda p: F.struct(
            F.try_element_at(p, F.lit(1)).try_cast("date").alias("date"),
            F.try_element_at(p, F.lit(2)).try_cast("double").alias("value"),
        ),
    )
    return df.select(*keep, F.inline(arr))


def zip_arrays(*cols: str | Column) -> Column:
    """Positional zip of equally long arrays."""
    return F.arrays_zip(*cols)


def series_from_parallel(df: DataFrame, col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``{labels: [...], datasets: [{label, data: [...]}]}`` text to (pos, label, series, value).

    Holes (null data) stay as rows with a null value.
    """
    doc = F.from_json(col, "struct<labels: array<string>, datasets: array<struct<label: string, data: array<double>>>>")
    ds = df.select(*keep, doc.alias("d")).select(*keep, F.col("d.labels").alias("labels"), F.explode("d.datasets").alias("s"))
    z = ds.select(*keep, F.col("s.label").alias("series"), F.col("labels").alias("label"), F.col("s.data").alias("value"))
    return z.select(*keep, "series", F.posexplode(zip_arrays("label", "value")).alias("pos", "z")).select(
        *keep, "series", "pos", F.col("z.label").alias("label"), F.col("z.value").alias("value")
    )


def cards_from_json(df: DataFrame, col: str) -> DataFrame:
    """Cards grouped by class to rows, with the position inside the class."""
    m = df.select(F.explode(F.from_json(col, CARD_SCHEMA)).alias("category", "items"))
    c = m.select("category", F.posexplode("items").alias("ord", "c"))
    return c.select(
        "category",
        "ord",
        F.col("c.name").alias("name"),
        F.col("c.ticker").alias("ticker"),
        F.col("c.price").alias("price"),
        F.col("c.change").alias("change"),
        F.col("c.changePct").alias("change_pct"),
        F.col("c.trend").alias("trend"),
        F.coalesce("c.isPct", F.lit(False)).alias("is_pct"),
    )


def with_ordinal(df: DataFrame, order: list[str], col: str) -> DataFrame:
    """Attach the position of ``col`` in a fixed list; rows outside the list get null."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)).cast("int")
    return df.withColumn("ord", F.nullif(pos, F.lit(0)))
