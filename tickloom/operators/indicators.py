"""Technical indicators over bars.

Each ``*_step`` works on an already spread table (see ``series``) so several can share one
shuffle; the plain functions spread, apply and collect. Short histories give partial frames
unless a name says ``full``. A zero denominator gives NULL and the neutral label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import percent, ratio
from tickloom.operators.ema import Averages, Blocks, ema, macd_signal, spread_for
from tickloom.operators.series import DAILY, Series

SMA_PERIODS = (5, 10, 20, 50, 200)
EMA_PERIODS = (12, 26, 50)


def band_label(value: Column, above, below) -> Column:
    """OVERBOUGHT over the upper limit, OVERSOLD under the lower, else NEUTRAL."""
    return (F.when(value > above, "OVERBOUGHT").when(value < below, "OVERSOLD")
            .otherwise("NEUTRAL"))


def crossover_label(line: Column, base: Column, line_before: Column, base_before: Column,
                    up: str, down: str, none: str) -> Column:
    return (F.when((line > base) & (line_before <= base_before), up)
            .when((line < base) & (line_before >= base_before), down)
            .otherwise(none))


def rsi_from(gain: Column, loss: Column) -> Column:
    return 100 - ratio(F.lit(100.0), 1 + ratio(gain, loss))


# -- steps on a spread table ---------------------------------------------------------


def sma_step(df: DataFrame, s: Series, col: str = "close", periods=SMA_PERIODS) -> DataFrame:
    return df.withColumns({f"sma_{p}": F.avg(col).over(s.frame(p)) for p in periods})


def rsi_step(df: DataFrame, s: Series, col: str = "close", period: int = 14) -> DataFrame:
    change = F.col("price_change")
    frame = s.frame(period)
    return (df.withColumn("price_change", F.col(col) - s.lag(col))
            .withColumns({"gain": F.when(change > 0, change).otherwise(0.0),
                          "loss": F.when(change < 0, -change).otherwise(0.0)})
            .withColumns({"avg_gain": F.avg("gain").over(frame),
                          "avg_loss": F.avg("loss").over(frame)})
            .withColumn("rsi", rsi_from(F.col("avg_gain"), F.col("avg_loss")))
            .withColumn("rsi_signal", band_label(F.col("rsi"), 70, 30))
            .drop("gain", "loss"))


def bollinger_step(df: DataFrame, s: Series, col: str = "close", period: int = 20,
                   width: float = 2.0) -> DataFrame:
    frame = s.frame(period)
    price, low, high = F.col(col), F.col("bb_lower"), F.col("bb_upper")
    return (df.withColumns({"bb_middle": F.avg(col).over(frame),
                            "bb_std": F.stddev_samp(col).over(frame)})
            .withColumns({"bb_upper": F.col("bb_middle") + width * F.col("bb_std"),
                          "bb_lower": F.col("bb_middle") - width * F.col("bb_std")})
            .withColumns({"bb_position": ratio(price - low, high - low),
                          "bb_signal": band_label(price, high, low),
                          "bb_width": ratio(high - low, F.col("bb_middle"))}))


def stochastic_step(df: DataFrame, s: Series, period: int = 14, smooth: int = 3) -> DataFrame:
    frame = s.frame(period)
    low, high = F.min("low").over(frame), F.max("high").over(frame)
    k, d = F.col("stoch_k"), F.col("stoch_d")
    return (df.withColumns({"lowest_low": low, "highest_high": high})
            .withColumn("stoch_k", ratio(100 * (F.col("close") - F.col("lowest_low")),
                                         F.col("highest_high") - F.col("lowest_low")))
            .withColumn("stoch_d", F.avg("stoch_k").over(s.frame(smooth)))
            .withColumn("stoch_signal", crossover_label(
                k, d, s.lag("stoch_k"), s.lag("stoch_d"),
                "BULLISH_CROSSOVER", "BEARISH_CROSSOVER", "NO_SIGNAL")))


def williams_step(df: DataFrame, s: Series, period: int = 14) -> DataFrame:
    frame = s.frame(period)
    high, low = F.col("highest_high"), F.col("lowest_low")
    return (df.withColumns({"highest_high": F.max("high").over(frame),
                            "lowest_low": F.min("low").over(frame)})
            .withColumn("williams_r", ratio(-100 * (high - F.col("close")), high - low))
            .withColumn("williams_signal", band_label(F.col("williams_r"), -20, -80)))


def atr_step(df: DataFrame, s: Series, period: int = 14) -> DataFrame:
    # greatest() skips NULL, so the first row's range is high - low.
    before = F.col("prev_close")
    return (df.withColumn("prev_close", s.lag("close"))
            .withColumn("true_range", F.greatest(F.col("high") - F.col("low"),
                                                 F.abs(F.col("high") - before),
                                                 F.abs(F.col("low") - before)))
            .withColumn("atr", F.avg("true_range").over(s.frame(period)))
            .withColumn("atr_percent", percent(F.col("atr"), F.col("close"))))


def batch_step(df: DataFrame, s: Series) -> DataFrame:
    """Averages, volatility, change, trends, crosses and RSI of the batch job."""
    close, before = F.col("close"), F.col("prev_close")
    return (rsi_step(df, s)
            .withColumns({"sma_20": F.avg("close").over(s.frame(20)),
                          "sma_50": F.avg("close").over(s.frame(50)),
                          "volatility_20": F.stddev_samp("close").over(s.frame(20)),
                          "prev_close": s.lag("close")})
            .withColumns({"price_change_pct": F.when(before > 0, percent(close - before, before))
                          .otherwise(0.0),
                          "_s20": s.lag("sma_20"), "_s50": s.lag("sma_50")})
            .withColumns({"trend_short": F.when(F.col("sma_20") > F.col("_s20"), "UP")
                          .otherwise("DOWN"),
                          "trend_long": F.when(F.col("sma_50") > F.col("_s50"), "UP")
                          .otherwise("DOWN"),
                          "ma_crossover": crossover_label(
                              F.col("sma_20"), F.col("sma_50"), F.col("_s20"), F.col("_s50"),
                              "GOLDEN_CROSS", "DEATH_CROSS", "NONE")})
            .drop("_s20", "_s50"))


def realtime_step(df: DataFrame, s: Series, rows: int = 20) -> DataFrame:
    """Change, averages and volatility over the last 20 rows, as the live feed shows them."""
    frame, before = s.frame(rows), s.lag("close")
    return (df.withColumns({"_before": before, "sma_20": F.avg("close").over(frame),
                            "volatility": F.stddev_samp("close").over(frame),
                            "volume_sma": F.avg("volume").over(frame)})
            .withColumns({"price_change": F.col("close") - F.col("_before"),
                          "price_change_pct": F.when(
                              F.col("_before") > 0,
                              percent(F.col("close") - F.col("_before"), F.col("_before")))
                          .otherwise(0.0)})
            .drop("_before"))


# -- whole-table functions -----------------------------------------------------------


def sma(bars: DataFrame, series: Series = DAILY, col: str = "close",
        periods=SMA_PERIODS) -> DataFrame:
    return series.run(bars, max(periods), lambda d, s: sma_step(d, s, col, periods))


def rsi(bars: DataFrame, series: Series = DAILY, period: int = 14) -> DataFrame:
    return series.run(bars, period + 1, lambda d, s: rsi_step(d, s, period=period))


def bollinger(bars: DataFrame, series: Series = DAILY, period: int = 20,
              width: float = 2.0) -> DataFrame:
    return series.run(bars, period, lambda d, s: bollinger_step(d, s, period=period, width=width))


def stochastic(bars: DataFrame, series: Series = DAILY, period: int = 14,
               smooth: int = 3) -> DataFrame:
    return series.run(bars, period + smooth + 1,
                      lambda d, s: stochastic_step(d, s, period, smooth))


def williams_r(bars: DataFrame, series: Series = DAILY, period: int = 14) -> DataFrame:
    return series.run(bars, period, lambda d, s: williams_step(d, s, period))


def atr(bars: DataFrame, series: Series = DAILY, period: int = 14) -> DataFrame:
    return series.run(bars, period + 1, lambda d, s: atr_step(d, s, period))


def batch_indicators(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return series.run(bars, 52, batch_step)


def realtime_indicators(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return series.run(bars, 21, realtime_step)


def macd_step(df: DataFrame, sized: Blocks, col: str, fast: int, slow: int,
              signal: int) -> DataFrame:
    return (df.withColumns({"_fast": ema(sized, col, fast), "_slow": ema(sized, col, slow)})
            .withColumn("macd_line", F.col("_fast") - F.col("_slow"))
            .withColumn("signal_line", macd_signal(sized, "macd_line", col, signal))
            .withColumns({"macd_histogram": F.col("macd_line") - F.col("signal_line"),
                          "macd_signal": crossover_label(
                              F.col("macd_line"), F.col("signal_line"),
                              sized.lag("macd_line"), sized.lag("signal_line"),
                              "BULLISH_CROSSOVER", "BEARISH_CROSSOVER", "NO_SIGNAL")})
            .drop("_fast", "_slow"))


def macd(bars: DataFrame, series: Series = DAILY, col: str = "close", fast: int = 12,
         slow: int = 26, signal: int = 9) -> DataFrame:
    wide, sized = spread_for(bars, series, Averages(col, macd=(fast, slow, signal)))
    return sized.own(macd_step(wide, sized, col, fast, slow, signal))


def composite_label(df: DataFrame) -> DataFrame:
    rsi_, bb, cross = F.col("rsi_signal"), F.col("bb_signal"), F.col("macd_signal")
    return df.withColumn("composite_signal", (
        F.when((rsi_ == "OVERSOLD") & (bb == "OVERSOLD") & (cross == "BULLISH_CROSSOVER"),
               "STRONG_BUY")
        .when((rsi_ == "OVERBOUGHT") & (bb == "OVERBOUGHT") & (cross == "BEARISH_CROSSOVER"),
              "STRONG_SELL")
        .when((rsi_ == "OVERSOLD") | (bb == "OVERSOLD"), "BUY")
        .when((rsi_ == "OVERBOUGHT") | (bb == "OVERBOUGHT"), "SELL")
        .otherwise("HOLD")))


def all_indicators(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    """Every indicator and the composite signal, from one spread of the table."""
    wide, s = spread_for(bars, series, Averages("close", EMA_PERIODS, macd=(12, 26, 9)),
                         max(SMA_PERIODS))
    wide = wide.withColumns({f"ema_{p}": ema(s, "close", p) for p in EMA_PERIODS})
    for step in (sma_step, rsi_step, stochastic_step, williams_step):
        wide = step(wide, s)
    wide = macd_step(wide, s, "close", 12, 26, 9)
    wide = atr_step(bollinger_step(wide, s), s)
    return s.own(composite_label(wide))


def trading_signals(indicators: DataFrame) -> DataFrame:
    """Signal strength and confidence; the first fitting rule wins."""
    signal, r, pos = F.col("composite_signal"), F.col("rsi"), F.col("bb_position")
    line, base = F.col("macd_line"), F.col("signal_line")
    strength = (F.when(signal == "STRONG_BUY", 4).when(signal == "STRONG_SELL", -4)
                .when(signal == "BUY", 2).when(signal == "SELL", -2).otherwise(0))
    confidence = (F.when((r < 30) & (pos < 0.2) & (line > base), 0.9)
                  .when((r > 70) & (pos > 0.8) & (line < base), 0.9)
                  .when((r < 40) | (pos < 0.3), 0.7)
                  .when((r > 60) | (pos > 0.7), 0.7)
                  .otherwise(0.5))
    return indicators.withColumns({"signal_strength": strength, "confidence_level": confidence})
