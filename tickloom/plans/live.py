"""The stream job: validated bars, indicators and anomalies, market windows, and their outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import quality
from tickloom.streaming import aggregates as agg, jobs, processors as proc

SCORES = ("price_zscore", "volume_zscore", "is_anomaly", "anomaly_severity")


def quotes(bars: DataFrame) -> DataFrame:
    """Valid bars as the quotes that the keyed processors take."""
    return quality.validate_stream(bars).select(
        "symbol", "id", "ts", F.col("close").alias("price"), "volume", "market")


def market(bars: DataFrame, delay: str = "10 minutes", length: str = "1 minute") -> DataFrame:
    """Market windows over the indicators and anomalies of the stream. Keyed state and windows
    share one watermark, so the query appends each window once, when it has closed."""
    rows = agg.with_watermark(quotes(bars), delay)
    return agg.market_windows(proc.stream_rolling(rows, ("market",), watermarked=True), length)


def written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What a query appends to ``path``, as a stream of its own. The files' log names each row
    once, also where the writer was stopped and has written a batch again."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)  # there before the writer
    return jobs.read_stream(spark, path, schema)


def start(bars: DataFrame, output: str, checkpoint: str, delay: str = "10 minutes",
          every: str | None = "30 seconds") -> list[StreamingQuery]:
    """Start the job's queries; ``jobs.run_all`` waits for them.

    The keyed state is kept once: its result is appended to ``realtime_anomalies``, and the other
    outputs are queries on what is appended there. Indicators and the flagged rows for debugging
    are written in one pass of each micro-batch; the market windows have their own watermark.
    Without ``every`` the first query ends before the others start, so that they see all of it.
    """
    spark = bars.sparkSession
    jobs.use_rocksdb(spark)
    flagged = proc.stream_rolling(quotes(bars), ("market",))
    path = f"{output}/realtime_anomalies"
    rows = written(spark, path, flagged.schema)
    first = jobs.to_files(flagged, path, f"{checkpoint}/flagged", every)
    if not every:
        jobs.run_all([first])
    windows = agg.market_windows(agg.with_watermark(rows, delay))
    return [
        first,
        jobs.fan_out(rows, {
            f"{output}/realtime_indicators": lambda b: b.drop(*SCORES),
            f"{output}/anomalies_debug": lambda b: b.filter("is_anomaly")},
            f"{checkpoint}/split", every),
        jobs.to_files(windows, f"{output}/realtime_market", f"{checkpoint}/market", every)]
