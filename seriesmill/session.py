"""Session settings and the shared folder for checkpoints and stream tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "seriesmill", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter makes it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Test tables are small but windows over them are not cheap: keep more than one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root of the folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session with a local master gets a fresh
    folder below its own working files; any other master is refused, as executors would not see each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_seriesmill_shared", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.sparkContext.getConf().get('spark.local.dir', '/tmp').split(',')[0]}/seriesmill-{uuid.uuid4().hex}"
        spark._seriesmill_shared = root
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def clear_shared(spark: SparkSession, path: str) -> None:
    """Remove a stored intermediate table or stream folder, once nothing reads it any more. Only below the shared folder."""
    if not path.startswith(shared_folder(spark).rstrip("/") + "/"):
        raise ValueError("not below the shared folder")
    from seriesmill.sources.publish import remove

    remove(spark, path)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
