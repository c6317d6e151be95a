"""Batch writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_processed(df: DataFrame, output: str, table: str) -> str:
    """Overwrite one table folder with snappy Parquet. Adaptive execution sizes the files;
    a fixed coalesce would also cut the parallelism of the work before it."""
    path = f"{output.rstrip('/')}/{table}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, *parts: str, fmt: str = "parquet",
                      mode: str = "append", max_rows: int = 5_000_000) -> None:
    """Hive-style folders. The rebalance groups rows by folder, so a task writes few files,
    and splits an oversized folder between tasks."""
    (df.hint("rebalance", *[F.col(p) for p in parts]).write.mode(mode)
     .option("maxRecordsPerFile", max_rows).partitionBy(*parts).format(fmt).save(path))


def write_lake(df: DataFrame, path: str, ts: str = "ts") -> None:
    """data_type / symbol / year / month / day / hour folders."""
    keyed = df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
                            "hour": F.hour(ts)})
    write_partitioned(keyed, path, "data_type", "symbol", "year", "month", "day", "hour")


def write_by_source_market(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, "source", "market", fmt="json")


def load_table(df: DataFrame, table: str, mode: str = "append", fmt: str = "parquet",
               path: str | None = None) -> None:
    """Append to a catalog table: the write commits as a whole or not at all."""
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def merge_serving(current: DataFrame | None, incoming: DataFrame, as_of: Column,
                  keep_days: int = 7, metrics: tuple[str, ...] = ()) -> DataFrame:
    """State of the serving table after an upsert: newest write per (symbol, timestamp),
    metrics as ``metric_*`` columns, expired rows gone.

    max_by merges repeated writes of a key before the shuffle.
    """
    ttl = F.unix_seconds((F.col("processed_at") + F.make_dt_interval(F.lit(keep_days)))
                         .cast("timestamp"))
    items = incoming.select(
        "symbol", "timestamp", F.col("price").cast("decimal(20,8)").alias("price"), "volume",
        "data_type", "processed_at", ttl.alias("ttl"),
        *[F.col(m).alias(f"metric_{m}") for m in metrics])
    both = items if current is None else current.unionByName(items, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in ("symbol", "timestamp")]
    row = F.struct(*rest)
    return (both.groupBy("symbol", "timestamp")
            .agg(F.max_by(row, F.struct("processed_at", *[c for c in rest if c != "processed_at"]))
                 .alias("r"))
            .select("symbol", "timestamp", "r.*")
            .filter(F.col("ttl") > F.unix_seconds(as_of.cast("timestamp"))))


def alert_history(alerts: DataFrame, as_of: Column, keep_days: int = 90) -> DataFrame:
    """History rows: key columns, the whole alert as JSON, expiry."""
    return alerts.select(
        "alert_id", F.col("ts").alias("timestamp"), "symbol", "alert_type", "severity",
        F.to_json(F.struct("*")).alias("alert_data"),
        F.unix_seconds((as_of + F.make_dt_interval(F.lit(keep_days))).cast("timestamp"))
        .alias("ttl"))


def write_dead_letters(split: DataFrame, path: str) -> None:
    """Ok and ProcessingFailed rows into their own folders, in one pass over the input."""
    write_partitioned(split, path, "result", fmt="json")


def read_delivered(spark: SparkSession, path: str, schema: str, result: str = "Ok") -> DataFrame:
    """One of the folders of ``write_dead_letters``; the other one is not opened."""
    return spark.read.schema(f"{schema}, result string").json(path).filter(
        F.col("result") == result).drop("result")


# Tags that a run has unless it is given others.
DEFAULT_TAGS = {"framework": "scikit-learn", "project": "financial_app", "version": "1.0.0"}


def run_row(spark: SparkSession, run_id: str, experiment: str, params: dict, metrics: dict,
            started_at, tags: dict | None = None) -> DataFrame:
    """One row of the run table. ``tags`` add to the default ones or replace them."""
    return spark.createDataFrame(
        [(run_id, experiment, {k: str(v) for k, v in params.items()},
          {k: float(v) for k, v in metrics.items()}, started_at,
          {**DEFAULT_TAGS, **{k: str(v) for k, v in (tags or {}).items()}})],
        "run_id string, experiment string, params map<string,string>, "
        "metrics map<string,double>, started_at timestamp_ntz, tags map<string,string>")
