"""Sinks: series maps, snapshots and section tables that can be published again safely."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators.aggregates import to_array


def series_map(df: DataFrame, key: str = "series_id") -> DataFrame:
    """(key, json): ordered points of each series as JSON text."""
    pts = to_array(df, keys=(key,))
    return pts.select(key, F.to_json("points", {"dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"}).alias("json"))


def write_series_map(df: DataFrame, path: str, key: str = "series_id") -> None:
    """One JSON object per line with the key and its points; written in parallel by all tasks."""
    to_array(df, keys=(key,)).withColumnRenamed(key, "key").write.mode("overwrite").json(path)


def write_snapshot(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def write_series(df: DataFrame, path: str, by: str = "metric") -> None:
    """Long series stored by metric, so a filter on the metric reads only its folder. No exchange before writing."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of a table, wherever Spark keeps it; a missing one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish(df: DataFrame, path: str, section: str) -> None:
    """Replace one section of a table and leave the others as they are; repeating it changes nothing.

    The rows are computed once and written beside the table under a hidden name; then the old section is moved aside and
    the new one takes its place, so readers never meet a half-written one. An empty result leaves no section.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    held = f"{root}/section={quote(section, safe=' ')}"
    new, old = (f"{root}/_{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    df.write.parquet(new)
    empty = spark.read.schema(df.schema).parquet(new).isEmpty()
    _move(spark, held, old)
    if empty:
        remove(spark, new)
    else:
        _move(spark, new, held)
    remove(spark, old)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; a missing one is fine."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = a.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(a) and not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def write_report(lines: DataFrame, path: str, report: str = "report_id") -> None:
    """Text files, one folder per report, in display order."""
    out = lines.repartitionByRange(report, "ord", "part").sortWithinPartitions(report, "ord", "part")
    out.select(report, "line").write.mode("overwrite").partitionBy(report).text(path)
