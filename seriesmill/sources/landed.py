"""Folders of landed documents as one source, in batch and as a stream, with the same rows either way.

Files, folders (with all below them) and patterns are read by Spark's own file source, whole files at a time, so any
store that Spark reaches will do, files are spread over tasks by size, and a stream picks up what lands later. Every
record becomes a row; a file or a record that cannot be read becomes a row too, with the reason, so that nothing is lost
and nothing stops; files without a byte are no documents, as Spark's file sources leave them out. The parsers are plain
expressions: no aggregate, no Python.

Rows start with ``file`` and ``landed`` (time of the file); ``reason`` is null for good rows. ``newest`` keeps, per key,
what the last landed file says.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions import scalars as X
from seriesmill.sources.documents import CARD_SCHEMA, QUOTE_SCHEMA, SERIES_SCHEMA, _plain

BODY = "file string, landed timestamp, body string"
_WHOLE = {"wholetext": "true", "recursiveFileLookup": "true"}


def _bodies(raw: DataFrame) -> DataFrame:
    file = _plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    return raw.select(file.alias("file"), F.col("_metadata.file_modification_time").alias("landed"), F.col("value").alias("body"))


def bodies(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, landed, body) of all files at the paths; a file that several paths reach comes once."""
    return _bodies(spark.read.format("text").options(**_WHOLE).load(list(paths))).dropDuplicates(["file"])


def stream_bodies(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream over a folder or a pattern of folders; each file comes once, however often the stream restarts."""
    reader = spark.readStream.format("text").options(**_WHOLE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _bodies(reader.load(path))


# --- parsers -------------------------------------------------------------------------------------


def _trouble(parsed: Column, inside: Column, what: str, is_list: bool) -> Column:
    """Why a document gives no record; null if it gives some."""
    text = F.btrim("body", F.lit(" \t\r\n"))
    return (
        F.when(text == "", F.lit("no document"))
        .when(F.try_parse_json("body").isNull(), F.lit("malformed document"))
        .when(~text.startswith("[") if is_list else F.lit(False), F.lit(f"no {what} in document"))
        .when(parsed.isNull() | inside.isNull() | (F.size(inside) <= 0), F.lit(f"no {what} in document"))
    )


def _records(docs: DataFrame, schema: str, inside: Callable[[Column], Column], what: str) -> DataFrame:
    """(file, landed, trouble, pos, r): the records of each document; a document in trouble is one row without a record."""
    parsed = docs.select("file", "landed", "body", F.from_json("body", schema).alias("d"))
    held = parsed.select("file", "landed", _trouble(F.col("d"), inside(F.col("d")), what, schema.startswith("array")).alias("trouble"), inside(F.col("d")).alias("rs"))
    return held.select("file", "landed", "trouble", F.posexplode_outer(F.when(F.col("trouble").isNull(), F.col("rs"))).alias("pos", "r"))


def _dated(rows: DataFrame, date: Column, value: Column, text: Column, said: Column, *more: Column) -> DataFrame:
    reason = F.coalesce(
        "trouble",
        F.when(date.isNull(), F.concat(F.lit("no date: "), F.coalesce(said, F.lit("nothing")))),
        F.when(value.isNull() | F.isnan(value), F.concat(F.lit("no number: "), F.coalesce(text, F.lit("nothing")))),
    )
    return rows.select("file", "landed", F.col("pos").cast("bigint").alias("pos"), *more, date.alias("date"), X.nan_to(value, None).alias("value"), reason.alias("reason"))


def parse_points(docs: DataFrame) -> DataFrame:
    """``[{date, value | price}]`` to (file, landed, pos, date, value, reason)."""
    r = _records(docs, "array<struct<date: string, value: string, price: string>>", lambda d: d, "point")
    text = F.coalesce("r.value", "r.price")
    return _dated(r, F.col("r.date").try_cast("date"), text.try_cast("double"), text, F.col("r.date"))


def parse_pairs(docs: DataFrame) -> DataFrame:
    """``[[date, value]]`` to the same columns."""
    r = _records(docs, "array<array<string>>", lambda d: d, "pair")
    said, text = (F.try_element_at("r", F.lit(k)) for k in (1, 2))
    return _dated(r, said.try_cast("date"), text.try_cast("double"), text, said)


def parse_series(docs: DataFrame) -> DataFrame:
    """Nested series documents to (file, landed, pos, series_id, date, value, reason); ``pos`` is the entry of the series."""
    r = _records(docs, SERIES_SCHEMA, lambda d: d["Results"]["series"], "series")
    points = r.select("file", "landed", "pos", F.col("r.seriesID").alias("series_id"),
                      F.coalesce("trouble", F.when(F.coalesce(F.size("r.data"), F.lit(0)) <= 0, F.lit("no point in series"))).alias("trouble"),
                      F.explode_outer("r.data").alias("p"))
    date = X.month_start(F.col("p.year").try_cast("int"), X.period_month(F.col("p.period")))
    said = F.concat_ws(" ", "p.year", "p.period")
    return _dated(points, date, F.col("p.value").try_cast("double"), F.col("p.value"), said, F.col("series_id"))


def parse_parallel(docs: DataFrame) -> DataFrame:
    """``{labels, datasets: [{label, data}]}`` to (file, landed, series, pos, label, value, reason); holes stay, with a null value."""
    r = _records(docs, "struct<labels: array<string>, datasets: array<struct<label: string, data: array<double>>>>", lambda d: F.transform(
        d["datasets"], lambda s: F.struct(s["label"].alias("series"), F.size(s["data"]).alias("n"), F.size(d["labels"]).alias("m"), F.arrays_zip(d["labels"].alias("label"), s["data"].alias("value")).alias("zs"))), "series")
    uneven = F.when(F.col("r.n") != F.col("r.m"), F.concat(F.col("r.n").cast("string"), F.lit(" values for "), F.col("r.m").cast("string"), F.lit(" labels")))
    z = r.select("file", "landed", F.coalesce("trouble", uneven).alias("reason"), F.col("r.series").alias("series"), F.posexplode_outer("r.zs").alias("pos", "z"))
    return z.select("file", "landed", "series", F.col("pos").cast("bigint").alias("pos"), F.col("z.label").alias("label"), F.col("z.value").alias("value"), "reason")


def parse_quotes(docs: DataFrame) -> DataFrame:
    """Quote documents to (file, landed, price, chart_prev, prev, reason), one row each."""
    r = _records(docs, QUOTE_SCHEMA, lambda d: d["chart"]["result"], "result").where("pos IS NULL OR pos = 0")
    meta = F.col("r.meta")
    return r.select("file", "landed", meta["regularMarketPrice"].alias("price"), meta["chartPreviousClose"].alias("chart_prev"), meta["previousClose"].alias("prev"),
                    F.coalesce("trouble", F.when(meta["regularMarketPrice"].isNull(), F.lit("no price in document"))).alias("reason"))


def parse_cards(docs: DataFrame) -> DataFrame:
    """Cards by class to (file, landed, category, pos, name, ticker, price, change, change_pct, trend, is_pct, reason)."""
    r = _records(docs, CARD_SCHEMA, lambda d: F.map_entries(d), "card")
    c = r.select("file", "landed", "trouble", F.col("r.key").alias("category"), F.posexplode_outer("r.value").alias("pos", "c"))
    return c.select(
        "file", "landed", "category", F.col("pos").cast("bigint").alias("pos"), F.col("c.name").alias("name"), F.col("c.ticker").alias("ticker"), F.col("c.price").alias("price"),
        F.col("c.change").alias("change"), F.col("c.changePct").alias("change_pct"), F.col("c.trend").alias("trend"), F.coalesce("c.isPct", F.lit(False)).alias("is_pct"),
        F.coalesce("trouble", F.when(F.col("c.price").isNull(), F.lit("no price on card"))).alias("reason"),
    )


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "points": parse_points, "pairs": parse_pairs, "series": parse_series, "parallel": parse_parallel, "quotes": parse_quotes, "cards": parse_cards,
}


def read_landed(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """All records of the documents at the paths, bad ones with their reason."""
    return PARSERS[kind](bodies(spark, paths))


def stream_landed(spark: SparkSession, path: str, kind: str, max_files: int | None = None) -> DataFrame:
    """The same rows as a stream."""
    return PARSERS[kind](stream_bodies(spark, path, max_files))


def good(rows: DataFrame) -> DataFrame:
    return rows.where("reason IS NULL").drop("reason")


def bad(rows: DataFrame) -> DataFrame:
    """(file, reason, records): what could not be read, and how often."""
    return rows.where("reason IS NOT NULL").groupBy("file", "reason").agg(F.count(F.lit(1)).alias("records"))


def newest(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key the values of the file that landed last (of equal times the last path), by a mergeable aggregate."""
    held = rows.where("reason IS NULL")
    return held.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("landed", "file", "pos")).alias("v")).select(*keys, *[F.col("v")[c].alias(c) for c in values])
