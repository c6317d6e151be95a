"""Window indicators over bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import BARS, bars, r, rounded, rounded_sql, rsql, with_ctes
from checks.registry import query
from tickloom.operators import anomalies as an, indicators as ind
from tickloom.operators.ema import add_ema, add_ema_adjusted

W = "PARTITION BY symbol ORDER BY ts"


def frame(n: int, end: int = 0) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def ema_sql(x: str, p: int, rn: str = "rn") -> str:
    """Closed form; rn counts from 0. The first row has weight 1, later rows alpha."""
    d = f"(1.0 - 2.0 / ({p} + 1))"
    return (f"(sum(CASE WHEN {rn} = 0 THEN 1.0 ELSE 2.0 / ({p} + 1) END * {x} "
            f"* pow({d}, -{rn})) OVER (PARTITION BY symbol ORDER BY ts "
            f"ROWS UNBOUNDED PRECEDING) * pow({d}, {rn}))")


def ema_adjusted_sql(x: str, p: int, rn: str = "rn") -> str:
    d = f"(1.0 - 2.0 / ({p} + 1))"
    return (f"(sum({x} * pow({d}, -{rn})) OVER (PARTITION BY symbol ORDER BY ts "
            f"ROWS UNBOUNDED PRECEDING) * pow({d}, {rn}) * (2.0 / ({p} + 1)) "
            f"/ (1.0 - pow({d}, {rn} + 1)))")


NUMBERED = f"nb AS (SELECT *, row_number() OVER ({W}) - 1 AS rn FROM bars)"

RSI = f"""
ch AS (SELECT *, close - lag(close) OVER ({W}) AS price_change FROM bars),
gl AS (SELECT *, CASE WHEN price_change > 0 THEN price_change ELSE 0 END AS gain,
              CASE WHEN price_change < 0 THEN -price_change ELSE 0 END AS loss FROM ch),
ag AS (SELECT *, avg(gain) OVER {frame(14)} AS avg_gain, avg(loss) OVER {frame(14)} AS avg_loss
       FROM gl),
rs AS (SELECT *, 100 - 100.0 / (1 + avg_gain / nullif(avg_loss, 0)) AS rsi FROM ag),
rsi AS (SELECT *, CASE WHEN rsi > 70 THEN 'OVERBOUGHT' WHEN rsi < 30 THEN 'OVERSOLD'
                      ELSE 'NEUTRAL' END AS rsi_signal FROM rs)
"""

BATCH = f"""
{RSI.strip()},
av AS (SELECT *, avg(close) OVER {frame(20)} AS sma_20, avg(close) OVER {frame(50)} AS sma_50,
              stddev_samp(close) OVER {frame(20)} AS volatility_20,
              lag(close) OVER ({W}) AS prev_close FROM rsi),
lg AS (SELECT *, lag(sma_20) OVER ({W}) AS l20, lag(sma_50) OVER ({W}) AS l50,
              CASE WHEN prev_close > 0 THEN (close - prev_close) / prev_close * 100 ELSE 0 END
                AS price_change_pct FROM av),
batch AS (SELECT *, CASE WHEN sma_20 > l20 THEN 'UP' ELSE 'DOWN' END AS trend_short,
              CASE WHEN sma_50 > l50 THEN 'UP' ELSE 'DOWN' END AS trend_long,
              CASE WHEN sma_20 > sma_50 AND l20 <= l50 THEN 'GOLDEN_CROSS'
                   WHEN sma_20 < sma_50 AND l20 >= l50 THEN 'DEATH_CROSS' ELSE 'NONE' END
                AS ma_crossover FROM lg)
"""


def zscore_cte(source: str, n: int, out: str) -> str:
    return f"""
zs AS (SELECT *, avg(close) OVER {frame(n)} AS price_mean,
              stddev_samp(close) OVER {frame(n)} AS price_stddev,
              avg(volume) OVER {frame(n)} AS volume_mean,
              stddev_samp(volume) OVER {frame(n)} AS volume_stddev FROM {source}),
{out} AS (SELECT *, (close - price_mean) / nullif(price_stddev, 0) AS price_zscore,
              (volume - volume_mean) / nullif(volume_stddev, 0) AS volume_zscore FROM zs)
"""


def anomaly_cte(source: str) -> str:
    return f"""
{zscore_cte(source, 101, 'z1').strip()},
z2 AS (SELECT *, coalesce(abs(price_zscore) > 3, false) AS price_anomaly,
              coalesce(abs(volume_zscore) > 3, false) AS volume_anomaly FROM z1),
z3 AS (SELECT *, CASE WHEN price_anomaly AND volume_anomaly THEN 'PRICE_VOLUME'
                     WHEN price_anomaly THEN 'PRICE' WHEN volume_anomaly THEN 'VOLUME'
                     ELSE 'NONE' END AS anomaly_type FROM z2),
flagged AS (SELECT *, CASE anomaly_type WHEN 'PRICE_VOLUME' THEN 'HIGH' WHEN 'NONE' THEN 'LOW'
                     ELSE 'MEDIUM' END AS risk_level FROM z3)
"""


SMA_COLS = [f"sma_{p}" for p in ind.SMA_PERIODS]


@query("sma", with_ctes(BARS, body="SELECT symbol, ts, " + ", ".join(
    f"{rsql(f'avg(close) OVER {frame(p)}')} AS sma_{p}" for p in ind.SMA_PERIODS) + " FROM bars"))
def _(spark, sf):
    return ind.sma(bars(spark, sf)).select("symbol", "ts", *rounded(*SMA_COLS))


@query("ema", with_ctes(BARS, NUMBERED, body="SELECT symbol, ts, " + ", ".join(
    f"{rsql(ema_sql('close', p))} AS ema_{p}" for p in ind.EMA_PERIODS) + " FROM nb"))
def _(spark, sf):
    df = add_ema(bars(spark, sf), ind.DAILY)
    return df.select("symbol", "ts", *rounded("ema_12", "ema_26", "ema_50"))


@query("ema_adjusted", with_ctes(BARS, NUMBERED, body="SELECT symbol, ts, " + ", ".join(
    f"{rsql(ema_adjusted_sql('close', p))} AS ema_{p}" for p in (12, 26)) + " FROM nb"))
def _(spark, sf):
    df = add_ema_adjusted(bars(spark, sf), ind.DAILY)
    return df.select("symbol", "ts", *rounded("ema_12", "ema_26"))


@query("rsi", with_ctes(BARS, RSI, body=f"""
SELECT symbol, ts, {rounded_sql('price_change', 'avg_gain', 'avg_loss', 'rsi')}, rsi_signal
FROM rsi"""))
def _(spark, sf):
    return ind.rsi(bars(spark, sf)).select(
        "symbol", "ts", *rounded("price_change", "avg_gain", "avg_loss", "rsi"), "rsi_signal")


MACD = f"""
{NUMBERED},
m1 AS (SELECT *, {ema_sql('close', 12)} - {ema_sql('close', 26)} AS macd_line FROM nb),
m2 AS (SELECT *, {ema_sql('macd_line', 9)} AS signal_line FROM m1),
m3 AS (SELECT *, macd_line - signal_line AS macd_histogram, lag(macd_line) OVER ({W}) AS ll,
              lag(signal_line) OVER ({W}) AS ls FROM m2),
macd AS (SELECT *, CASE WHEN macd_line > signal_line AND ll <= ls THEN 'BULLISH_CROSSOVER'
                       WHEN macd_line < signal_line AND ll >= ls THEN 'BEARISH_CROSSOVER'
                       ELSE 'NO_SIGNAL' END AS macd_signal FROM m3)
"""


@query("macd", with_ctes(BARS, MACD, body=f"""
SELECT symbol, ts, {rounded_sql('macd_line', 'signal_line', 'macd_histogram')}, macd_signal
FROM macd"""))
def _(spark, sf):
    return ind.macd(bars(spark, sf)).select(
        "symbol", "ts", *rounded("macd_line", "signal_line", "macd_histogram"), "macd_signal")


BOLLINGER = f"""
b1 AS (SELECT *, avg(close) OVER {frame(20)} AS bb_middle,
              stddev_samp(close) OVER {frame(20)} AS bb_std FROM bars),
b2 AS (SELECT *, bb_middle + 2 * bb_std AS bb_upper, bb_middle - 2 * bb_std AS bb_lower FROM b1),
bb AS (SELECT *, (close - bb_lower) / nullif(bb_upper - bb_lower, 0) AS bb_position,
              (bb_upper - bb_lower) / nullif(bb_middle, 0) AS bb_width,
              CASE WHEN close > bb_upper THEN 'OVERBOUGHT' WHEN close < bb_lower THEN 'OVERSOLD'
                   ELSE 'NEUTRAL' END AS bb_signal FROM b2)
"""
BB = ("bb_middle", "bb_std", "bb_upper", "bb_lower", "bb_position", "bb_width")


@query("bollinger", with_ctes(BARS, BOLLINGER, body=f"""
SELECT symbol, ts, {rounded_sql(*BB)}, bb_signal FROM bb"""))
def _(spark, sf):
    return ind.bollinger(bars(spark, sf)).select("symbol", "ts", *rounded(*BB), "bb_signal")


STOCHASTIC = f"""
k1 AS (SELECT *, min(low) OVER {frame(14)} AS lowest_low, max(high) OVER {frame(14)} AS
              highest_high FROM bars),
k2 AS (SELECT *, 100 * (close - lowest_low) / nullif(highest_high - lowest_low, 0) AS stoch_k
       FROM k1),
k3 AS (SELECT *, avg(stoch_k) OVER {frame(3)} AS stoch_d FROM k2),
k4 AS (SELECT *, lag(stoch_k) OVER ({W}) AS lk, lag(stoch_d) OVER ({W}) AS ld FROM k3),
st AS (SELECT *, CASE WHEN stoch_k > stoch_d AND lk <= ld THEN 'BULLISH_CROSSOVER'
                     WHEN stoch_k < stoch_d AND lk >= ld THEN 'BEARISH_CROSSOVER'
                     ELSE 'NO_SIGNAL' END AS stoch_signal FROM k4)
"""


@query("stochastic", with_ctes(BARS, STOCHASTIC, body=f"""
SELECT symbol, ts, {rounded_sql('stoch_k', 'stoch_d')}, stoch_signal FROM st"""))
def _(spark, sf):
    return ind.stochastic(bars(spark, sf)).select(
        "symbol", "ts", *rounded("stoch_k", "stoch_d"), "stoch_signal")


@query("williams_r", with_ctes(BARS, f"""
w1 AS (SELECT *, min(low) OVER {frame(14)} AS ll, max(high) OVER {frame(14)} AS hh FROM bars),
w2 AS (SELECT *, -100 * (hh - close) / nullif(hh - ll, 0) AS williams_r FROM w1)""", body=f"""
SELECT symbol, ts, {rsql('williams_r')} AS williams_r,
       CASE WHEN williams_r > -20 THEN 'OVERBOUGHT' WHEN williams_r < -80 THEN 'OVERSOLD'
            ELSE 'NEUTRAL' END AS williams_signal FROM w2"""))
def _(spark, sf):
    return ind.williams_r(bars(spark, sf)).select(
        "symbol", "ts", *rounded("williams_r"), "williams_signal")


ATR = f"""
a1 AS (SELECT *, lag(close) OVER ({W}) AS prev_close FROM bars),
a2 AS (SELECT *, greatest(high - low, abs(high - prev_close), abs(low - prev_close))
              AS true_range FROM a1),
atr AS (SELECT *, avg(true_range) OVER {frame(14)} AS atr FROM a2)
"""


@query("atr", with_ctes(BARS, ATR, body=f"""
SELECT symbol, ts, {rounded_sql('true_range', 'atr')},
       {rsql('atr / nullif(close, 0) * 100')} AS atr_percent FROM atr"""))
def _(spark, sf):
    return ind.atr(bars(spark, sf)).select(
        "symbol", "ts", *rounded("true_range", "atr", "atr_percent"))


BATCH_NUM = ("sma_20", "sma_50", "volatility_20", "price_change", "price_change_pct", "rsi")
BATCH_TXT = ("trend_short", "trend_long", "ma_crossover", "rsi_signal")


@query("batch_indicators", with_ctes(BARS, BATCH, body=f"""
SELECT symbol, ts, {rounded_sql(*BATCH_NUM)}, {', '.join(BATCH_TXT)} FROM batch"""))
def _(spark, sf):
    return ind.batch_indicators(bars(spark, sf)).select(
        "symbol", "ts", *rounded(*BATCH_NUM), *BATCH_TXT)


ALL_NUM = (*SMA_COLS, "ema_12", "ema_26", "ema_50", "rsi", "stoch_k", "stoch_d", "williams_r",
           "macd_line", "signal_line", "macd_histogram", "bb_position", "bb_width", "atr",
           "atr_percent")
ALL_TXT = ("rsi_signal", "stoch_signal", "williams_signal", "macd_signal", "bb_signal",
           "composite_signal")

ALL = with_ctes(BARS, RSI, MACD, BOLLINGER, STOCHASTIC, ATR, f"""
wl AS (SELECT symbol, ts,
              -100 * (max(high) OVER {frame(14)} - close)
              / nullif(max(high) OVER {frame(14)} - min(low) OVER {frame(14)}, 0) AS williams_r
       FROM bars)""", f"""
sm AS (SELECT symbol, ts, {', '.join(f'avg(close) OVER {frame(p)} AS sma_{p}'
                                     for p in ind.SMA_PERIODS)},
              {', '.join(f'{ema_sql("close", p)} AS ema_{p}' for p in ind.EMA_PERIODS)}
       FROM nb)""", f"""
al AS (SELECT sm.*, close, rsi, rsi_signal, stoch_k, stoch_d, stoch_signal, williams_r,
              CASE WHEN williams_r > -20 THEN 'OVERBOUGHT' WHEN williams_r < -80 THEN 'OVERSOLD'
                   ELSE 'NEUTRAL' END AS williams_signal,
              macd_line, signal_line, macd_histogram, macd_signal, bb_position, bb_width,
              bb_signal, atr, atr / nullif(close, 0) * 100 AS atr_percent
       FROM sm JOIN rsi USING (symbol, ts)
            JOIN (SELECT symbol, ts, stoch_k, stoch_d, stoch_signal FROM st) USING (symbol, ts)
            JOIN wl USING (symbol, ts)
            JOIN (SELECT symbol, ts, macd_line, signal_line, macd_histogram, macd_signal
                  FROM macd) USING (symbol, ts)
            JOIN (SELECT symbol, ts, bb_position, bb_width, bb_signal FROM bb) USING (symbol, ts)
            JOIN (SELECT symbol, ts, atr FROM atr) USING (symbol, ts))""", """
alls AS (SELECT *, CASE
  WHEN rsi_signal = 'OVERSOLD' AND bb_signal = 'OVERSOLD' AND macd_signal = 'BULLISH_CROSSOVER'
    THEN 'STRONG_BUY'
  WHEN rsi_signal = 'OVERBOUGHT' AND bb_signal = 'OVERBOUGHT'
       AND macd_signal = 'BEARISH_CROSSOVER' THEN 'STRONG_SELL'
  WHEN rsi_signal = 'OVERSOLD' OR bb_signal = 'OVERSOLD' THEN 'BUY'
  WHEN rsi_signal = 'OVERBOUGHT' OR bb_signal = 'OVERBOUGHT' THEN 'SELL'
  ELSE 'HOLD' END AS composite_signal FROM al)""", body="{body}")


def all_sql(body: str) -> str:
    return ALL.replace("{body}", body.strip())


@query("all_indicators", all_sql(f"""
SELECT symbol, ts, {rounded_sql(*ALL_NUM)}, {', '.join(ALL_TXT)} FROM alls"""))
def _(spark, sf):
    return ind.all_indicators(bars(spark, sf)).select("symbol", "ts", *rounded(*ALL_NUM), *ALL_TXT)


@query("trading_signals", all_sql("""
SELECT symbol, ts, composite_signal,
  CASE composite_signal WHEN 'STRONG_BUY' THEN 4 WHEN 'STRONG_SELL' THEN -4 WHEN 'BUY' THEN 2
       WHEN 'SELL' THEN -2 ELSE 0 END AS signal_strength,
  CASE WHEN rsi < 30 AND bb_position < 0.2 AND macd_line > signal_line THEN 0.9
       WHEN rsi > 70 AND bb_position > 0.8 AND macd_line < signal_line THEN 0.9
       WHEN rsi < 40 OR bb_position < 0.3 THEN 0.7
       WHEN rsi > 60 OR bb_position > 0.7 THEN 0.7
       ELSE 0.5 END::DOUBLE AS confidence_level
FROM alls"""))
def _(spark, sf):
    return ind.trading_signals(ind.all_indicators(bars(spark, sf))).select(
        "symbol", "ts", "composite_signal", "signal_strength", "confidence_level")


ZCOLS = ("price_zscore", "volume_zscore")


@query("zscore_anomalies", with_ctes(BARS, anomaly_cte("bars"), body=f"""
SELECT symbol, ts, {rounded_sql(*ZCOLS)}, anomaly_type, risk_level FROM flagged"""))
def _(spark, sf):
    return an.zscore_anomalies(bars(spark, sf)).select(
        "symbol", "ts", *rounded(*ZCOLS), "anomaly_type", "risk_level")


@query("critical_anomalies", with_ctes(BARS, anomaly_cte("bars"), body=f"""
SELECT symbol, ts, {rsql('close')} AS close, anomaly_type, risk_level FROM flagged
WHERE risk_level = 'HIGH' ORDER BY ts DESC, symbol LIMIT 5"""))
def _(spark, sf):
    return an.critical_anomalies(an.zscore_anomalies(bars(spark, sf))).select(
        "symbol", "ts", r("close").alias("close"), "anomaly_type", "risk_level")


@query("zscore_severity", with_ctes(BARS, zscore_cte("bars", 51, "z1"), body=f"""
SELECT symbol, ts, {rounded_sql(*ZCOLS)},
       coalesce(abs(price_zscore) > 3, false) OR coalesce(abs(volume_zscore) > 3, false)
         AS is_anomaly,
       CASE WHEN abs(price_zscore) > 5 THEN 'CRITICAL' WHEN abs(price_zscore) > 3 THEN 'HIGH'
            WHEN abs(volume_zscore) > 3 THEN 'MEDIUM' ELSE 'LOW' END AS anomaly_severity
FROM z1"""))
def _(spark, sf):
    return an.zscore_severity(bars(spark, sf)).select(
        "symbol", "ts", *rounded(*ZCOLS), "is_anomaly", "anomaly_severity")


RT = ("price_change", "price_change_pct", "sma_20", "volatility", "volume_sma")


@query("realtime_indicators", with_ctes(BARS, f"""
rt AS (SELECT *, lag(close) OVER ({W}) AS pc, avg(close) OVER {frame(20)} AS sma_20,
              stddev_samp(close) OVER {frame(20)} AS volatility,
              avg(volume) OVER {frame(20)} AS volume_sma FROM bars)""", body=f"""
SELECT symbol, ts, {rsql('close - pc')} AS price_change,
       {rsql('CASE WHEN pc > 0 THEN (close - pc) / pc * 100 ELSE 0 END')} AS price_change_pct,
       {rounded_sql('sma_20', 'volatility', 'volume_sma')} FROM rt"""))
def _(spark, sf):
    return ind.realtime_indicators(bars(spark, sf)).select("symbol", "ts", *rounded(*RT))
