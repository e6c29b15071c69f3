"""Running a stream over landed files to the end of the available data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesmill.session import fresh_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream with its stored schema."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A file source needs a folder or a pattern; the pattern below matches just this path, file or folder.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def use_utc(spark: SparkSession) -> None:
    """Zone-less event times are UTC; event-time windows need the session to read them so."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def tick_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Events as quotes with an event-time column."""
    use_utc(spark)
    return stream_table(spark, path, max_files).select(
        F.col("event_type").alias("asset"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
    )


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed processors keep their state in RocksDB, on local disk with snapshots in the checkpoint folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _late_rows(query: StreamingQuery, late: dict[int, int]) -> None:
    """Rows too late for the watermark, by batch."""
    for p in query.recentProgress:
        late[p.batchId] = max(late.get(p.batchId, 0), sum(op.numRowsDroppedByWatermark for op in p.stateOperators))


def run_to_table(out: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None, counts: dict | None = None) -> DataFrame:
    """Process everything available, append to a table in the shared folder and return that table.

    The sink is transactional: a restarted run continues from its checkpoint
    without repeating or losing rows. ``counts`` gets the number of rows that came
    too late for the watermark, under ``late``.
    """
    spark = out.sparkSession
    path = path or fresh_path(spark, label)
    query = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or fresh_path(spark, f"{label}-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    late: dict[int, int] = {}
    # Only the latest reports are kept by the query, so they are taken down while it runs.
    while not query.awaitTermination(0.2):
        _late_rows(query, late)
    _late_rows(query, late)
    if counts is not None:
        counts["late"] = sum(late.values())
    return spark.read.schema(out.schema).parquet(path)
