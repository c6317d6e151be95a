"""Declared schemas. Reads never infer."""

from pyspark.sql import types as T

BAR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("market", T.StringType()),
])

# BAR plus the column that keeps unparsable input instead of losing it.
BAR_WITH_CORRUPT = T.StructType(BAR.fields + [T.StructField("_corrupt_record", T.StringType())])

QUOTE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("data_type", T.StringType()),
])

DATA_POINT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

INTRADAY_DOCUMENT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("last_refreshed", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("data_points", T.ArrayType(DATA_POINT)),
])

INDICATOR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("rsi", T.DoubleType()),
    T.StructField("macd", T.DoubleType()),
    T.StructField("macd_signal", T.DoubleType()),
    T.StructField("macd_histogram", T.DoubleType()),
    T.StructField("sma_20", T.DoubleType()),
    T.StructField("sma_50", T.DoubleType()),
])

JOB_OUTPUT = T.StructType([
    T.StructField("price_data", T.ArrayType(BAR)),
    T.StructField("technical_indicators", T.ArrayType(INDICATOR)),
])
