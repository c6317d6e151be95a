"""Timestamp parsing and event-time cut-offs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The accepted timestamp formats.
SPACED, ZULU = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_time(text: Column) -> Column:
    """Either format, else NULL; never raises.

    The eleventh character tells which format can fit. A failed parse is an exception inside
    Spark, so trying one format after the other costs far more than looking first.
    """
    return F.when(F.substring(text, 11, 1) == "T", F.try_to_timestamp(text, F.lit(ZULU))).otherwise(
        F.try_to_timestamp(text, F.lit(SPACED))).cast("timestamp_ntz")


def parse_time_loose(text: Column) -> Column:
    """ISO-like text of any precision, else NULL. Sessions run in UTC."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long")).cast("timestamp_ntz")


def latest(df: DataFrame, ts: str = "ts") -> Column:
    """max(ts) as a scalar subquery: the repeatable stand-in for "now"."""
    return df.agg(F.max(ts).alias("as_of")).scalar()


def since(df: DataFrame, interval: str, ts: str = "ts", as_of: Column | None = None) -> DataFrame:
    """Rows not older than ``as_of - interval``; as_of defaults to the newest row."""
    end = as_of if as_of is not None else latest(df, ts)
    return df.filter(F.col(ts) >= end - F.expr(f"INTERVAL {interval}"))
