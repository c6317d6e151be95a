"""Readers of raw bars and stored results. Schemas are declared, nothing is inferred."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import BAR, BAR_WITH_CORRUPT


def date_filter(raw: DataFrame, day: str) -> DataFrame:
    """Rows whose timestamp text contains ``day``. On a typed time use ``between_days``,
    which prunes files."""
    return raw.filter(F.col("timestamp").contains(day))


def between_days(df: DataFrame, first: date, last: date, ts: str = "ts") -> DataFrame:
    """Typed range predicate (last day inclusive); reaches the Parquet scan."""
    return df.filter((F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(last + timedelta(days=1))))


def read_raw_bars(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Multi-line JSON; what cannot be parsed is kept in ``_corrupt_record``. A missing path
    gives an empty table of the same schema."""
    try:
        raw = (spark.read.schema(BAR_WITH_CORRUPT).option("multiLine", True)
               .option("mode", "PERMISSIVE").json(path))
    except Exception as error:  # the path check is eager
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], BAR_WITH_CORRUPT)
    return date_filter(raw, day) if day else raw


def extract_recent_files(spark: SparkSession, path: str, newer_than: datetime,
                         schema: T.StructType = BAR) -> DataFrame:
    """JSON files (plain or .gz, arrays or single objects) modified after a time (UTC)."""
    return (spark.read.schema(schema).option("multiLine", True)
            .option("modifiedAfter", newer_than.strftime("%Y-%m-%dT%H:%M:%S"))
            .option("recursiveFileLookup", True).json(path))


def day_paths(prefix: str, last: date, days_back: int) -> list[str]:
    """prefix/yyyy/MM/dd of each day, newest last."""
    return [f"{prefix.rstrip('/')}/{d:%Y/%m/%d}"
            for d in (last - timedelta(days=n) for n in range(days_back, -1, -1))]


def read_day_range(spark: SparkSession, table: str, last: date, days_back: int) -> DataFrame:
    """Stored rows of the last days in one scan; ``day`` is the partition column."""
    first = last - timedelta(days=days_back)
    return spark.read.parquet(table).filter(F.col("day").between(F.lit(first), F.lit(last)))
