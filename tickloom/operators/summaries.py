"""Aggregations: partial and final hash aggregates, no per-group collection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import fixed, ratio
from tickloom.functions.times import since
from tickloom.operators.lookups import latest_per_symbol
from tickloom.operators.quantiles import exact_quantiles


def sentiment(change: Column, limit: float = 1.0) -> Column:
    return (F.when(change > limit, "BULLISH").when(change < -limit, "BEARISH")
            .otherwise("NEUTRAL"))


def market_rollup(latest: DataFrame) -> DataFrame:
    """One row per market over already reduced rows."""
    change = F.col("price_change_pct")
    return (latest.groupBy("market").agg(
        fixed(F.avg("close"), 2).alias("avg_price"),
        fixed(F.avg("volume"), 0).alias("avg_volume"),
        fixed(F.avg(change), 2).alias("avg_change_pct"),
        fixed(F.avg("volatility_20"), 2).alias("avg_volatility"),
        fixed(F.avg("rsi"), 2).alias("avg_rsi"),
        F.count("symbol").alias("symbol_count"),
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
        F.count_if(F.col("anomaly_type") != "NONE").alias("anomalies"))
        .withColumn("market_sentiment", sentiment(F.col("avg_change_pct"))))


def market_summary(flagged: DataFrame) -> DataFrame:
    return market_rollup(latest_per_symbol(flagged))


def quick_market_avg(bars: DataFrame) -> DataFrame:
    return bars.groupBy("market").agg(F.avg("close").alias("avg_close"),
                                      F.count(F.lit(1)).alias("records"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.union, counts)


def price_overview(prices: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return prices.agg(F.count(F.lit(1)).alias("total_records"),
                      distinct("symbol").alias("unique_symbols"),
                      F.min("ts").alias("earliest_timestamp"),
                      F.max("ts").alias("latest_timestamp"))


def indicator_overview(indicators: DataFrame) -> DataFrame:
    return indicators.agg(F.count(F.lit(1)).alias("total_indicators"),
                          F.count_distinct("symbol").alias("unique_symbols"),
                          F.avg("rsi").alias("avg_rsi"), F.avg("macd").alias("avg_macd"))


def hourly_ohlcv(prices: DataFrame, back: str | None = "24 HOURS") -> DataFrame:
    recent = since(prices, back) if back else prices
    return (recent.groupBy("symbol", F.date_trunc("HOUR", "ts").cast("timestamp_ntz")
                           .alias("hour_bucket"))
            .agg(F.avg("close").alias("avg_price"), F.max("high").alias("max_price"),
                 F.min("low").alias("min_price"), F.sum("volume").alias("total_volume")))


def quality_price(prices: DataFrame) -> DataFrame:
    return prices.agg(F.count(F.lit(1)).alias("total_records"),
                      F.count_if(F.col("symbol").isNull()).alias("null_symbols"),
                      F.count_if(F.col("close") <= 0).alias("invalid_prices"),
                      F.count_if(F.col("volume") < 0).alias("negative_volume")).select(
        F.lit("Price Data Quality").alias("check_type"), "*")


def quality_indicators(indicators: DataFrame) -> DataFrame:
    rsi = F.col("rsi")
    return indicators.agg(F.count(F.lit(1)).alias("total_records"),
                          F.count_if(F.col("symbol").isNull()).alias("null_symbols"),
                          F.count_if((rsi < 0) | (rsi > 100)).alias("invalid_rsi"),
                          F.count_if(F.col("macd").isNull()).alias("null_macd")).select(
        F.lit("Technical Indicators Quality").alias("check_type"), "*")


def quality_union(prices: DataFrame, indicators: DataFrame) -> DataFrame:
    """By position; the first branch names the columns."""
    return quality_price(prices).union(quality_indicators(indicators))


def symbol_volatility(bars: DataFrame) -> DataFrame:
    return (bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("record_count"),
                                       F.avg("close").alias("avg_price"),
                                       F.stddev_samp("close").alias("price_volatility"))
            .orderBy(F.col("record_count").desc(), "symbol"))


def stats_by_symbol(prices: DataFrame, symbol: str | None = None) -> DataFrame:
    chosen = prices.filter(F.col("symbol") == symbol.upper()) if symbol else prices
    return chosen.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.min("close").alias("min_price"), F.max("close").alias("max_price"),
        F.avg("close").alias("avg_price"), F.min("volume").alias("min_volume"),
        F.max("volume").alias("max_volume"), F.avg("volume").alias("avg_volume"),
        F.min("ts").alias("earliest"), F.max("ts").alias("latest"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def activity(events: DataFrame) -> DataFrame:
    """First and last event of each user."""
    return events.groupBy("user_id").agg(F.min("ts").alias("created_at"),
                                         F.max("ts").alias("last_seen"))


def activity_stats(users: DataFrame, as_of: Column, active_days: int = 1) -> DataFrame:
    def after(col: str, days: int) -> Column:
        return F.col(col) >= as_of - F.make_dt_interval(F.lit(days))

    active = after("last_seen", active_days)
    return users.agg(F.count(F.lit(1)).alias("total_users"),
                     F.count_if(active).alias("active_users"),
                     F.count_if(~active).alias("inactive_users"),
                     F.count_if(after("created_at", 30)).alias("created_last_30_days"),
                     F.count_if(after("last_seen", 7)).alias("seen_last_7_days"))


def ingest_stats(bars: DataFrame) -> DataFrame:
    """Counts by source, by market and in total, reading the table once."""
    pairs = bars.groupBy("source", "market").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.array(F.struct(F.lit("source").alias("dimension"), F.col("source").alias("value")),
                    F.struct(F.lit("market").alias("dimension"), F.col("market").alias("value")),
                    F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("value")))
    return (pairs.select(F.explode(kinds).alias("k"), "n").groupBy("k.dimension", "k.value")
            .agg(F.sum("n").alias("records")))


def feed_heartbeat(ticks: DataFrame, back: str = "1 MINUTE") -> DataFrame:
    return since(ticks, back).agg(F.count(F.lit(1)).alias("total_updates"),
                                  F.count_distinct("symbol").alias("active_symbols"),
                                  F.max("ts").alias("last_update"))


def quality_score(ticks: DataFrame, back: str = "5 MINUTES") -> DataFrame:
    good = F.count_if(F.col("price").isNotNull() & (F.col("price") > 0))
    return since(ticks, back).agg(
        ratio(good * 100.0, F.count(F.lit(1))).alias("quality_score"))


def anomaly_counts(anomalies: DataFrame, back: str = "1 HOUR") -> DataFrame:
    return (since(anomalies, back).groupBy("anomaly_type", "severity")
            .agg(F.count(F.lit(1)).alias("anomaly_count"))
            .orderBy(F.col("anomaly_count").desc(), "anomaly_type", "severity"))


def _per_minute(ticks: DataFrame, symbols: list[str], back: str) -> DataFrame:
    recent = since(ticks.filter(F.col("symbol").isin(symbols)), back)
    return recent.groupBy(F.date_trunc("MINUTE", "ts").cast("timestamp_ntz").alias("time"),
                          "symbol")


def minute_price_trend(ticks: DataFrame, symbols: list[str], back: str = "1 HOUR") -> DataFrame:
    return _per_minute(ticks, symbols, back).agg(F.avg("price").alias("avg_price"))


def minute_volume(ticks: DataFrame, symbols: list[str], back: str = "1 HOUR") -> DataFrame:
    return _per_minute(ticks, symbols, back).agg(F.sum("volume").alias("total_volume"))


def ingest_rate(events: DataFrame, minutes: int = 5, stream: str = "event_type") -> DataFrame:
    """Records per second per stream and window."""
    return (events.groupBy(stream, F.window("ts", f"{minutes} minutes").alias("w"))
            .agg(F.count(F.lit(1)).alias("records"))
            .select(stream, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    "records", (F.col("records") / (60.0 * minutes)).alias("per_second")))


def latency_quantiles(metrics: DataFrame, window: str = "1 day", value: str = "value",
                      stream: str = "event_type") -> DataFrame:
    """p50 and p95 per stream and window."""
    keyed = metrics.select(stream, F.window("ts", window)["start"].cast("timestamp_ntz")
                           .alias("window_start"), value)
    return (exact_quantiles(keyed, [stream, "window_start"], value, [0.5, 0.95])
            .select(stream, "window_start", F.col("rows").alias("records"),
                    F.col("quantiles")[0].alias("p50"), F.col("quantiles")[1].alias("p95")))


def prediction_statistics(predictions: DataFrame, as_of: Column, days: int = 7,
                          limit: float = 5.0) -> DataFrame:
    """Stored predictions of the last days per horizon, and how many are large."""
    recent = predictions.filter(F.col("ts") >= as_of - F.make_dt_interval(F.lit(days)))
    return recent.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(F.abs("predicted_change_pct") > limit).alias("significant"))


def prediction_report(predictions: DataFrame, by: str = "symbol") -> DataFrame:
    """Agreement of the horizons: spread, confidence, consistency and direction."""
    change = F.col("predicted_change_pct")
    return predictions.groupBy(by).agg(
        F.avg(change).alias("avg_predicted_change"), F.max(change).alias("max_predicted_change"),
        F.min(change).alias("min_predicted_change"), F.avg("confidence").alias("avg_confidence"),
        (1 - F.stddev_pop(change) / (F.avg(F.abs(change)) + 1e-6))
        .alias("prediction_consistency"),
        F.when(F.avg(change) > 0, "bullish").otherwise("bearish").alias("trend_direction"))


def expected_minus_actual(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Names that should exist and do not."""
    return expected.exceptAll(actual)


def union_sources(*feeds: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
