"""Named queries with, where SQL can say it, an independent oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its oracle SQL if there is one."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Times without zone are compared with SQL, so the session must not shift them.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return add
