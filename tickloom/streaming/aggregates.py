"""Time-window aggregates and repeats, the same functions for streams and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.series import Series
from tickloom.operators.summaries import sentiment


def with_watermark(stream: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP with a watermark (a no-op on tables)."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def market_windows(rows: DataFrame, length: str = "1 minute", slide: str | None = None,
                   by: str = "market") -> DataFrame:
    """Counts, averages, gainers, losers, anomalies and sentiment per window and market.

    Input: ts, market, symbol, price, volume, price_change_pct, volatility, is_anomaly.
    """
    change = F.col("price_change_pct")
    win = F.window("ts", length, slide) if slide else F.window("ts", length)
    out = rows.groupBy(win.alias("w"), by).agg(
        F.count("symbol").alias("symbol_count"), F.avg("price").alias("avg_price"),
        F.avg("volume").alias("avg_volume"), F.avg(change).alias("avg_change_pct"),
        F.avg("volatility").alias("avg_volatility"),
        F.count_if(change > 0).alias("gainers"), F.count_if(change < 0).alias("losers"),
        F.count_if("is_anomaly").alias("anomalies"))
    return out.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), by, "symbol_count",
        "avg_price", "avg_volume", "avg_change_pct", "avg_volatility", "gainers", "losers",
        "anomalies",
        sentiment(F.col("avg_change_pct")).alias("market_sentiment"))


def closed_windows(windows: DataFrame, rows: DataFrame, delay: str) -> DataFrame:
    """What append mode has emitted by the end of ``rows``: windows the watermark has passed."""
    mark = rows.agg(F.max(F.col("ts").cast("timestamp_ntz")).alias("m")).scalar()
    return windows.filter(F.col("window_end") <= mark - F.expr(f"INTERVAL {delay}"))


def stream_dedup(stream: DataFrame, delay: str, keys: tuple[str, ...] = ("symbol", "ts")
                 ) -> DataFrame:
    """First row of each key; the state is bounded by the watermark."""
    return with_watermark(stream, delay).dropDuplicatesWithinWatermark(list(keys))


def threshold_alarm(metrics: DataFrame, limit: float, length: str = "300 seconds",
                    periods: int = 2, by: str = "stream", series: Series | None = None
                    ) -> DataFrame:
    """Periods in which the average has been over the limit for ``periods`` running.

    A period without rows breaks the run, so the run is checked against the clock, not
    against the neighbouring row.
    """
    s = series or Series(keys=(by,), ts="period", unit="DAY")
    averaged = metrics.groupBy(by, F.window("ts", length).alias("w")).agg(
        F.avg("value").alias("statistic")).select(
        by, F.col("w.start").cast("timestamp_ntz").alias("period"), "statistic")

    def step(df: DataFrame, cut: Series) -> DataFrame:
        over = F.when(F.col("statistic") > limit, 1).otherwise(0)
        first = cut.lag("period", periods - 1)
        span = F.expr(f"INTERVAL {length}") * (periods - 1)
        return df.withColumn("in_alarm", (F.sum(over).over(cut.frame(periods)) == periods)
                             & F.coalesce(first == F.col("period") - span, F.lit(False)))

    return s.run(averaged, periods, step)
