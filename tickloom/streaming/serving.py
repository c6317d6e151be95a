"""A serving table kept up by a stream: versions of days, and manifests that name the current ones.

Each micro-batch writes new versions of the days it has rows for, next to the old ones, and then
one manifest that lists the current version of every day. A manifest appears by a rename, so it is
there as a whole or not at all. A reader takes the newest manifest and reads what it lists, however
many batches follow meanwhile; versions that no manifest in use lists are removed by age.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.sinks.tables import merge_serving
from tickloom.streaming import jobs

MANIFESTS = "_manifests"


class Folder:
    """Files below a path of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._of = path.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._of(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._store.exists(self._at(name))

    def names(self, name: str = "") -> dict[str, int]:
        """Names in a folder with the milliseconds of their last change."""
        if not self.exists(name):
            return {}
        return {f.getPath().getName(): f.getModificationTime()
                for f in self._store.listStatus(self._at(name))}

    def read(self, name: str) -> bytes:
        stream = self._store.open(self._at(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write(self, name: str, data: bytes) -> None:
        """Whole or not at all; takes the place of a file of that name."""
        part = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self._store.create(self._at(part), True)
        stream.write(data)
        stream.close()
        if not self._store.rename(self._at(part), self._at(name)):
            self._store.delete(self._at(name), False)  # a retry of the same batch
            self._store.rename(self._at(part), self._at(name))

    def delete(self, name: str) -> None:
        self._store.delete(self._at(name), True)


def manifest(spark: SparkSession, table: str, before: int | None = None) -> dict[str, int]:
    """Current version of each day, by the newest manifest (of a batch under ``before``)."""
    folder = Folder(spark, table)
    numbers = [int(n.removesuffix(".json")) for n in folder.names(MANIFESTS)
               if n.removesuffix(".json").isdigit()]
    numbers = [n for n in numbers if before is None or n < before]
    if not numbers:
        return {}
    return json.loads(folder.read(f"{MANIFESTS}/{max(numbers):012d}.json"))


def _read(spark: SparkSession, table: str, days: dict[str, int]) -> DataFrame:
    paths = [f"{table}/day={day}/v={v}" for day, v in sorted(days.items())]
    return spark.read.option("basePath", table).parquet(*paths).drop("day", "v")


def serve(stream: DataFrame, table: str, checkpoint: str, keep_days: int = 7,
          metrics: tuple[str, ...] = (), every: str | None = None,
          remove_after: float | None = None) -> StreamingQuery:
    """Keep a serving table at its newest row per (symbol, timestamp).

    A micro-batch's cost follows the days it has rows for, not the table; nothing is overwritten
    while it is read (``served``). Rows expire by the newest write of their micro-batch. A repeated
    batch starts from the manifest before its own and replaces its versions and its manifest. With
    ``remove_after`` seconds, each batch removes what has not been listed for that long.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = batch.select(F.to_date("timestamp").cast("string").alias("day")).distinct()
        days = [r["day"] for r in found.collect() if r["day"]]  # the days of one micro-batch
        if not days:
            return
        current = manifest(spark, table, number)
        old = {d: v for d, v in current.items() if d in days}
        before = _read(spark, table, old) if old else None
        as_of = batch.agg(F.max("processed_at")).scalar()
        (merge_serving(before, batch.filter(F.col("timestamp").isNotNull()), as_of, keep_days, metrics)
         .withColumns({"day": F.to_date("timestamp"), "v": F.lit(number)})
         .hint("rebalance", F.col("day")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day", "v").parquet(table))
        folder = Folder(spark, table)
        listed = {d: v for d, v in current.items() if d not in days}
        listed |= {d: number for d in days if folder.exists(f"day={d}/v={number}")}
        folder.write(f"{MANIFESTS}/{number:012d}.json", json.dumps(listed).encode())
        if remove_after is not None:
            remove_versions(spark, table, remove_after)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return jobs.start(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                      .trigger(**trigger), stream.sparkSession)


def served(spark: SparkSession, table: str, as_of: Column) -> DataFrame:
    """The serving table's rows that have not expired at ``as_of``, by the manifest that is newest
    now: later batches do not change what this frame reads."""
    days = manifest(spark, table)
    if not days:
        raise ValueError(f"{table} has no manifest: no batch has been served yet")
    return _read(spark, table, days).filter(F.col("ttl") > F.unix_seconds(as_of.cast("timestamp")))


def remove_versions(spark: SparkSession, table: str, older_than: float, now: float | None = None
                    ) -> list[str]:
    """Remove the manifests that were replaced ``older_than`` seconds ago or more, and the versions
    that none of the others lists: give readers that long. Versions of a batch that has no manifest
    yet stay. Returns what was removed."""
    folder, gone = Folder(spark, table), []
    written = {int(n.removesuffix(".json")): t for n, t in folder.names(MANIFESTS).items()
               if n.removesuffix(".json").isdigit()}
    if not written:
        return gone
    if now is None:
        now = int(spark._jvm.java.lang.System.currentTimeMillis()) / 1000
    numbers = sorted(written)
    used = {n for n, following in zip(numbers, numbers[1:])
            if written[following] > (now - older_than) * 1000} | {numbers[-1]}
    listed = {(day, v) for n in used
              for day, v in json.loads(folder.read(f"{MANIFESTS}/{n:012d}.json")).items()}
    for day in folder.names():
        versions = folder.names(day) if day.startswith("day=") else ()
        gone += [f"{day}/{v}" for v in versions if v.startswith("v=")
                 and (day[4:], int(v[2:])) not in listed and int(v[2:]) <= numbers[-1]]
    gone += [f"{MANIFESTS}/{n:012d}.json" for n in numbers if n not in used]
    for name in gone:
        folder.delete(name)
    return gone
