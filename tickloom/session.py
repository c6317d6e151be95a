"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(name: str = "tickloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, root: str | None = None) -> str:
    """A fresh folder under ``root``, else under ``spark.checkpoint.dir``.

    The cluster names shared storage there. A local master has one machine only, so it may use a
    temporary folder; any other master without a named folder is an error, as executors could
    not see a folder of the driver's.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("no shared folder: set spark.checkpoint.dir to storage that all "
                             "executors see, or pass root")
        root = tempfile.mkdtemp(prefix="tickloom-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(frame: DataFrame, label: str = "stage", root: str | None = None) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: lineage ends here, and a lost
    executor costs the tasks it was running only."""
    path = f"{shared_folder(frame.sparkSession, root)}/{label}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
