"""Model features and targets per series; rows with an incomplete feature are dropped."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import percent, ratio
from tickloom.operators.ema import Averages, ema_adjusted, spread_for, with_carries
from tickloom.operators.indicators import rsi_from
from tickloom.operators.series import DAILY, Series
from tickloom.session import staged

ANOMALY_FEATURES = ("price", "volume", "price_change", "volume_change", "volatility",
                    "price_volume_ratio")
PREDICTION_FEATURES = ("price", "volume", "price_change", "volume_change", "sma_5", "sma_20",
                       "ema_12", "ema_26", "rsi", "macd", "bollinger_upper", "bollinger_lower",
                       "volatility", "momentum_5", "momentum_10")
HORIZONS = (1, 5, 10, 20)


def _growth(s: Series, col: str, rows: int = 1) -> Column:
    before = s.lag(col, rows)
    return ratio(F.col(col) - before, before)


def anomaly_features(prices: DataFrame, series: Series = DAILY, rows: int = 20) -> DataFrame:
    """Changes, full-window statistics and ratios. Input: symbol, ts, price, volume."""
    def step(df: DataFrame, s: Series) -> DataFrame:
        frame = s.frame(rows)
        return df.withColumns({
            "price_change": _growth(s, "price"), "volume_change": _growth(s, "volume"),
            "price_ma": s.full(F.avg("price").over(frame), rows),
            "price_std": s.full(F.stddev_samp("price").over(frame), rows),
            "volume_ma": s.full(F.avg("volume").over(frame), rows),
            "volume_std": s.full(F.stddev_samp("volume").over(frame), rows)})

    out = series.run(prices, max(rows, 2), step).withColumns({
        "price_change_abs": F.abs("price_change"), "volume_change_abs": F.abs("volume_change"),
        "volatility": ratio(F.col("price_std"), F.col("price_ma")),
        "price_volume_ratio": ratio(F.col("price"), F.col("volume"))})
    return out.na.drop()


def rsi_full(df: DataFrame, s: Series, col: str = "price", rows: int = 14) -> Column:
    """RSI of a complete window; 100 when there were gains and no losses."""
    frame = s.frame(rows)
    gain, loss = F.avg("_gain").over(frame), F.avg("_loss").over(frame)
    value = F.when((loss == 0) & (gain > 0), 100.0).otherwise(rsi_from(gain, loss))
    return s.full(value, rows)


def _gains(df: DataFrame, s: Series, col: str) -> DataFrame:
    change = F.col(col) - s.lag(col)
    return (df.withColumn("_change", change).withColumns({
        "_gain": F.when(F.col("_change") > 0, F.col("_change")).otherwise(0.0),
        "_loss": F.when(F.col("_change") < 0, -F.col("_change")).otherwise(0.0)}))


def add_rsi_full(prices: DataFrame, series: Series = DAILY, rows: int = 14) -> DataFrame:
    def step(df: DataFrame, s: Series) -> DataFrame:
        df = _gains(df, s, "price")
        return df.withColumn("rsi", rsi_full(df, s, rows=rows)).drop("_change", "_gain", "_loss")

    return series.run(prices, rows + 1, step)


def prediction_features(prices: DataFrame, series: Series = DAILY) -> DataFrame:
    """The models' features. The signal averages the difference of two averages over blocks of
    their own sums, so the rows are staged once with that difference."""
    wide, s = spread_for(prices, series, Averages("price", (12, 26), adjusted=True), 22)
    price = F.col("price")
    wide = _gains(wide, s, "price")
    wide = wide.withColumns({
        "price_change": _growth(s, "price"), "volume_change": _growth(s, "volume"),
        "sma_5": s.full(F.avg("price").over(s.frame(5)), 5),
        "sma_20": s.full(F.avg("price").over(s.frame(20)), 20),
        "bollinger_std": s.full(F.stddev_samp("price").over(s.frame(20)), 20),
        "ema_12": ema_adjusted(s, "price", 12), "ema_26": ema_adjusted(s, "price", 26),
        "rsi": rsi_full(wide, s),
        "momentum_5": ratio(price, s.lag("price", 5)) - 1,
        "momentum_10": ratio(price, s.lag("price", 10)) - 1})
    wide = staged(wide.withColumn("macd", F.col("ema_12") - F.col("ema_26")), "macd")
    wide, s = with_carries(wide, s, Averages("macd", (9,), adjusted=True))
    wide = wide.withColumn("macd_signal", ema_adjusted(s, "macd", 9))
    mid, dev = F.col("sma_20"), F.col("bollinger_std")
    return s.own(wide).drop("_change", "_gain", "_loss").withColumns({
        "bollinger_middle": mid, "bollinger_upper": mid + dev * 2,
        "bollinger_lower": mid - dev * 2, "volatility": ratio(dev, mid)}).na.drop()


def prediction_targets(prices: DataFrame, horizons=HORIZONS, series: Series = DAILY) -> DataFrame:
    """Price, change % and direction some rows ahead; direction is 0 where that is unknown."""
    def step(df: DataFrame, s: Series) -> DataFrame:
        return df.withColumns({f"price_target_{h}d": s.lag("price", h) for h in horizons})

    ahead = replace(series, newest_first=True).run(prices, max(horizons), step)
    out = ahead.withColumns({f"price_change_{h}d": percent(
        F.col(f"price_target_{h}d") - F.col("price"), F.col("price")) for h in horizons})
    return out.withColumns({f"direction_{h}d": F.when(F.col(f"price_change_{h}d") > 0, 1)
                            .otherwise(0) for h in horizons})


def chronological_split(df: DataFrame, share: float = 0.7, series: Series = DAILY) -> DataFrame:
    """``is_train`` for the first share of each series, by time."""
    placed = series.numbered(df)
    return (placed.withColumn("is_train", F.col("_at") < F.floor(F.col("_total") * F.lit(share)))
            .drop("_at", "_total"))
