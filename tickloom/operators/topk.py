"""Sorted and limited results. orderBy + limit plans as a top-k, not a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.times import since


def latest_rows(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(F.col("ts").desc(), "symbol").limit(n)


def top_volume(ticks: DataFrame, back: str = "5 MINUTES", n: int = 10) -> DataFrame:
    return since(ticks, back).orderBy(F.col("volume").desc(), "ts", "symbol").limit(n)


def top_movers(ticks: DataFrame, back: str = "2 MINUTES", n: int = 10) -> DataFrame:
    change = F.col("change_percent")
    tag = F.when(change > 0, "up").when(change < 0, "down").otherwise("neutral")
    return (since(ticks, back).withColumn("trend", tag)
            .orderBy(F.abs(change).desc_nulls_last(), "ts", "symbol").limit(n))


def value_series(df: DataFrame, symbols: list[str], value: str, back: str) -> DataFrame:
    """time, value, metric rows of the chosen symbols, in time order."""
    return (since(df, back).filter(F.col("symbol").isin(symbols))
            .select(F.col("ts").alias("time"), F.col(value).alias("value"),
                    F.col("symbol").alias("metric")).orderBy("time", "metric"))


def top_by_market_cap(listing: DataFrame, n: int = 10) -> DataFrame:
    return listing.orderBy(F.col("market_cap").desc(), "id").limit(n)


def best_run(runs: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    key = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return runs.orderBy(key, "run_id").limit(1)


def keep_last_runs(runs: DataFrame, keep: int = 10) -> DataFrame:
    """The newest runs of each experiment; the window filter is cut on the map side."""
    newest = Window.partitionBy("experiment").orderBy(F.col("started_at").desc(),
                                                      F.col("run_id").desc())
    return runs.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= keep)


def best_prediction(predictions: DataFrame, by: tuple[str, ...], order: tuple[str, ...]
                    ) -> DataFrame:
    """Model with the highest confidence; on a tie the earlier one in ``order``."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    key = F.struct(F.col("confidence"), (-place).alias("p"))
    rest = [c for c in predictions.columns if c not in by]
    return (predictions.groupBy(*by).agg(F.max_by(F.struct(*rest), key).alias("b"))
            .select(*by, "b.*"))
