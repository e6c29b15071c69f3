"""Alerts, buckets and snapshots on quote streams.

Stateless rules run tick by tick. Rules that need the past work on the latest
price per asset and polling interval: that reduction is a mergeable aggregate, so
an asset that sends most ticks reaches the keyed state as one row per interval.
The aggregate releases an interval when the watermark has passed it, and later
batches only release later intervals; the keyed processors therefore need no
buffer of their own and see their rows in time order whatever the arrival order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from seriesmill.operators.cleaning import keyword_alerts, threshold_rule, zone
from seriesmill.operators.long_series import entered
from seriesmill.session import fresh_path
from seriesmill.sources.publish import remove
from seriesmill.streaming.engine import run_to_table, use_rocksdb

POLL = "15 minutes"  # fixed value: the alert is checked four times an hour
DELAY = "10 minutes"

stream_alerts = threshold_rule
stream_keywords = keyword_alerts


def latest_per_bucket(ticks: DataFrame, every: str = POLL, delay: str = DELAY) -> DataFrame:
    """Latest price per asset and interval: (asset, bucket, bucket_end, price, ticks). Batch or stream."""
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    g = t.withWatermark("ts", delay).groupBy(F.window("ts", every).alias("w"), "asset")
    agg = g.agg(F.max_by("price", F.struct("ts", "event_id")).alias("price"), F.count(F.lit(1)).alias("ticks"))
    return agg.select("asset", F.col("w.start").alias("bucket"), F.col("w.end").alias("bucket_end"), "price", "ticks")


def bucket_crossings(buckets: DataFrame, rules: DataFrame) -> DataFrame:
    """Batch twin of the stream: polls at which an asset crosses out of its band.

    The window holds one row per asset and interval, which the calendar bounds.
    """
    z = buckets.join(rules, "asset").withColumn("alert", zone(F.col("price"), F.col("lower"), F.col("upper")))
    prev = F.lag("alert").over(Window.partitionBy("asset").orderBy("bucket"))
    hit = z.withColumn("_prev", prev).filter(entered(F.col("alert"), F.col("_prev")))
    return hit.select("asset", "bucket", "price", "alert")


class CrossingProcessor(StatefulProcessor):
    """Remembers the last zone of an asset and reports the polls that enter another outer zone."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "zone string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        polls = pd.concat(list(rows)).sort_values("bucket")
        before = self.last.get()[0] if self.last.exists() else "in"
        prev = polls["alert"].shift(1, fill_value=before)
        self.last.update((str(polls["alert"].iloc[-1]),))
        hit = (polls["alert"] != "in") & (polls["alert"] != prev)
        yield polls.loc[hit, ["asset", "bucket", "price", "alert"]]

    def close(self) -> None:
        pass


def stream_crossings(ticks: DataFrame, rules: DataFrame, every: str = POLL, delay: str = DELAY) -> DataFrame:
    use_rocksdb(ticks.sparkSession)
    z = latest_per_bucket(ticks, every, delay).join(rules, "asset")
    z = z.withColumn("alert", zone(F.col("price"), F.col("lower"), F.col("upper"))).select("asset", "bucket", "price", "alert")
    return z.groupBy("asset").transformWithStateInPandas(
        CrossingProcessor(), "asset string, bucket timestamp, price double, alert string", "Append", "None"
    )


def latest_quotes(ticks: DataFrame) -> DataFrame:
    """Latest price per asset; ties in time go to the higher event id."""
    last = F.max(F.struct("ts", "event_id", "price")).alias("q")
    return ticks.groupBy("asset").agg(last).select("asset", "q.ts", "q.event_id", "q.price")


def stream_snapshot(ticks: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Replace a snapshot table on every trigger and return its current state.

    A trigger merges its batch into the version before and writes version ``batch_id``, a row per asset; versions
    before the last one are then removed, so the table does not grow with the number of triggers. A batch that is
    replayed reads the same earlier version and writes the same rows again. A row that comes late cannot win
    against a newer one, so none is dropped.
    """
    spark = ticks.sparkSession
    path = path or fresh_path(spark, "snapshot")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        older = [v for v in snapshot_versions(session, path) if v < batch_id]
        rows = batch.select("asset", "ts", "event_id", "price")
        if older:
            rows = rows.unionByName(session.read.schema(rows.schema).parquet(_version(path, older[-1])))
        latest_quotes(rows).write.mode("overwrite").parquet(_version(path, batch_id))
        for v in older[:-1]:
            remove(session, _version(path, v))

    query = (
        ticks.select("asset", "ts", "event_id", "price")
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint or fresh_path(spark, "snapshot-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_snapshot(spark, path)


def _version(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/version={number}"


def snapshot_versions(spark, path: str) -> list[int]:
    """Numbers of the finished versions, ascending: at most the last three."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("version=")]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def read_snapshot(spark, path: str) -> DataFrame:
    """The newest finished version."""
    return spark.read.parquet(_version(path, snapshot_versions(spark, path)[-1]))


ZONES = ("above", "below", "in")
TICK = "struct<ts: timestamp, event_id: bigint, price: double>"


def zone_summaries(ticks: DataFrame, rules: DataFrame, every: str = POLL, delay: str = DELAY) -> DataFrame:
    """(asset, bucket, above_first, above_last, below_first, ..., in_last): first and last tick of each zone per asset and
    interval. A mergeable aggregate, so a busy asset leaves each task as one row per interval. Batch or stream."""
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).join(rules, "asset")
    t = t.select("asset", "ts", F.struct("ts", "event_id", "price").alias("tick"), zone(F.col("price"), F.col("lower"), F.col("upper")).alias("zone"))
    ends = [f(F.when(F.col("zone") == z, F.col("tick"))).alias(f"{z}_{n}") for z in ZONES for f, n in ((F.min, "first"), (F.max, "last"))]
    g = t.groupBy(F.window("ts", every).alias("w"), "asset").agg(*ends)
    return g.select("asset", F.col("w.start").alias("bucket"), *[f"{z}_{n}" for z in ZONES for n in ("first", "last")])


def entries(summary: dict, before: str) -> tuple[list[tuple[str, tuple]], str]:
    """The outer zones an asset enters within one interval, with the tick, and the zone it ends in.

    However short an excursion is, its first tick is in the summary. Several excursions into one zone within an interval
    give one alert: with the first tick of the zone, or with its last one where the interval already began inside it.
    """
    first = {z: summary[f"{z}_first"] for z in ZONES if summary[f"{z}_first"] is not None}
    last = {z: summary[f"{z}_last"] for z in first}
    begins, ends = min(first, key=first.get), max(last, key=last.get)
    out = []
    for z in ("above", "below"):
        if z not in first:
            continue
        if z != begins or before != z:
            out.append((z, first[z]))
        elif any(first[o] < last[z] for o in first if o != z):  # left and came back
            out.append((z, last[z]))
    return out, ends


class EntryProcessor(StatefulProcessor):
    """Remembers the zone of the last tick of an asset; its rows are interval summaries."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "zone string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.last.get()[0] if self.last.exists() else "in"
        out = []
        for row in pd.concat(list(rows)).sort_values("bucket").to_dict("records"):
            summary = {k: _tick(v) for k, v in row.items() if k not in ("asset", "bucket")}
            hits, before = entries(summary, before)
            out += [(row["asset"], row["bucket"], z, t[0], t[1], t[2]) for z, t in hits]
        self.last.update((before,))
        yield pd.DataFrame(out, columns=["asset", "bucket", "alert", "ts", "event_id", "price"])

    def close(self) -> None:
        pass


def _tick(value) -> tuple | None:
    if value is None or (isinstance(value, float) and value != value):
        return None
    return (value["ts"], value["event_id"], value["price"]) if isinstance(value, dict) else tuple(value)


def stream_entries(ticks: DataFrame, rules: DataFrame, every: str = POLL, delay: str = DELAY) -> DataFrame:
    """(asset, bucket, alert, ts, event_id, price): edge alerts on ticks, one per asset, interval and outer zone entered."""
    use_rocksdb(ticks.sparkSession)
    return zone_summaries(ticks, rules, every, delay).groupBy("asset").transformWithStateInPandas(
        EntryProcessor(), "asset string, bucket timestamp, alert string, ts timestamp, event_id bigint, price double", "Append", "None"
    )


__all__ = [
    "CrossingProcessor",
    "EntryProcessor",
    "bucket_crossings",
    "entries",
    "latest_per_bucket",
    "latest_quotes",
    "read_snapshot",
    "run_to_table",
    "stream_alerts",
    "snapshot_versions",
    "stream_crossings",
    "stream_entries",
    "stream_keywords",
    "stream_snapshot",
    "zone_summaries",
]
