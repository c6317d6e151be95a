"""Pure label rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rsi_label(rsi: Column) -> Column:
    return F.when(rsi > 70, "Overbought").when(rsi < 30, "Oversold").otherwise("Neutral")


def macd_label(line: Column, signal: Column, histogram: Column) -> Column:
    """Line against signal and the histogram's sign must agree."""
    return (F.when((line > signal) & (histogram > 0), "Bullish")
            .when((line < signal) & (histogram < 0), "Bearish").otherwise("Neutral"))


def prediction_confidence(change: Column) -> Column:
    """Smaller predicted moves are trusted more."""
    size = F.abs(change)
    return F.when(size < 1, 0.9).when(size < 5, 0.7).otherwise(0.5)


def partition_key(stream: Column, symbol: Column, event_type: Column, ts: Column) -> Column:
    """Routing key per stream; crypto is spread over minutes as well."""
    def bucket(value: Column, n: int) -> Column:
        head = F.conv(F.substring(F.md5(value.cast("binary")), 1, 8), 16, 10).cast("bigint")
        return (head % n).cast("string")

    minute = F.date_format(ts, "yyyyMMddHHmm")
    return (F.when(stream == "financial", F.concat_ws(
        "_", F.lit("symbol"), symbol, F.lpad(bucket(symbol, 100), 2, "0")))
        .when(stream == "crypto", F.concat_ws(
            "_", F.lit("crypto"), symbol, F.lpad(bucket(minute, 100), 2, "0")))
        .otherwise(F.concat_ws("_", F.lit("event"), event_type, bucket(event_type, 10))))
