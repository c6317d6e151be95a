"""Sources, sinks and multi-output jobs. The source format is a parameter: files here, a
message bus on a cluster; everything after it is the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.schemas import BAR

#: Executors may still be joining when a stream starts: a cluster counts as this many cores at least.
MIN_PARTITIONS = 8
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """File stream; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def start(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a stream with no more shuffle partitions than the cluster has cores.

    Each partition costs every micro-batch a task, a commit of its state and a Python worker, with or
    without rows, and a stream has no adaptive execution that would join small ones. A query takes
    the session's settings as it starts, and its number of partitions from its first start.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), max(MIN_PARTITIONS, spark.sparkContext.defaultParallelism)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def to_files(df: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds",
             fmt: str = "parquet", parts: tuple[str, ...] = (), name: str | None = None,
             **options: str) -> StreamingQuery:
    """Append files with exactly-once commits; ``every=None`` takes what is there and stops."""
    writer = (df.writeStream.format(fmt).outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint))
    for key, value in options.items():
        writer = writer.option(key, value)
    if parts:
        writer = writer.partitionBy(*parts)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return start(writer.trigger(**trigger), df.sparkSession)


def to_console(df: DataFrame, checkpoint: str, every: str | None = "10 seconds"
               ) -> StreamingQuery:
    """Debug output."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return start(df.writeStream.format("console").outputMode("append").option("truncate", "false")
                 .option("checkpointLocation", checkpoint).trigger(**trigger), df.sparkSession)


# Keeps microseconds in JSON; readers must be given the same format.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def archive(df: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds",
            folder: str = "yyyy-MM-dd-HH") -> StreamingQuery:
    """Compressed JSON in source / type / hour folders. A trigger's rows of a folder go to one
    task, so that it gets one file a trigger and the folders are written side by side."""
    parts = ("source", "data_type", "hour")
    keyed = df.withColumn("hour", F.date_format("ts", folder)).repartition(*parts)
    return to_files(keyed, path, checkpoint, every, "json", parts,
                    compression="gzip", timestampFormat=JSON_TIME)


def load_incrementally(spark: SparkSession, landing: str, target: str, checkpoint: str,
                       pattern: str = "*price_data*", schema: T.StructType = BAR
                       ) -> StreamingQuery:
    """Each landed file matching ``pattern`` once, into ``target``/loaded; text that does not
    parse goes to ``target``/rejected. Both carry the micro-batch number as a folder, which a
    retry overwrites. Run it from a schedule: it takes what is new and stops."""
    broken = "_corrupt_record"
    wide = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    rows = read_stream(spark, landing, wide, "json", pathGlobFilter=pattern,
                       recursiveFileLookup="true", mode="PERMISSIVE",
                       columnNameOfCorruptRecord=broken)
    return fan_out(rows, {
        f"{target}/loaded": lambda b: b.filter(F.col(broken).isNull()).drop(broken),
        f"{target}/rejected": lambda b: b.filter(F.col(broken).isNotNull()).select(broken)},
        checkpoint)


def fan_out(stream: DataFrame, outputs: dict, checkpoint: str, every: str | None = None
            ) -> StreamingQuery:
    """Several outputs from one read of the stream.

    ``outputs`` maps a folder to a function DataFrame -> DataFrame. The micro-batch number is
    a folder level and is overwritten on a retry, so a repeated batch leaves no double rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for path, make in outputs.items():
                make(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return start(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                 .trigger(**trigger), stream.sparkSession)


def run_all(queries: list[StreamingQuery]) -> None:
    """Wait for several queries and stop all when one fails, instead of hiding the failure
    behind the first one."""
    try:
        for q in queries:
            while q.isActive:
                q.awaitTermination(5)
                for other in queries:
                    if other.exception() is not None:
                        raise other.exception()
    finally:
        for q in queries:
            q.stop()


def counted(stream: DataFrame, name: str) -> DataFrame:
    """Record counts of each micro-batch, reported with the query's progress."""
    return stream.observe(name, F.count(F.lit(1)).alias("records"),
                          F.count_if(F.col("symbol").isNull()).alias("failed"))
