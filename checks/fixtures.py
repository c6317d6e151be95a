"""Adapters that present the driver's tables as bars, ticks, users and documents.

Each adapter has a Spark form and a SQL form (a CTE of the same name) that must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rounding of results for comparison: the small bias sends a tie the same way in both engines
# even if the two values differ in the last bit.
_BIAS = 0.500001


def r(value: str | Column, places: int = 4) -> Column:
    col = F.col(value) if isinstance(value, str) else value
    scale = float(10 ** places)
    return F.floor(col * scale + _BIAS) / scale


def rsql(value: str, places: int = 4) -> str:
    scale = float(10 ** places)
    return f"floor(({value}) * {scale} + {_BIAS}) / {scale}"


def rounded(*names: str) -> list[Column]:
    return [r(n).alias(n) for n in names]


def rounded_sql(*names: str) -> str:
    return ", ".join(f"{rsql(n)} AS {n}" for n in names)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


# -- bars ----------------------------------------------------------------------------
# One bar per brand and ship date. The order of trades inside a day is (order, line, price in
# cents), packed into one bigint so that the aggregate can hash in place.


def bars(spark: SparkSession, sf: str) -> DataFrame:
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    seq = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1048576 + cents % 1048576
    trades = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("symbol"), F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("long").alias("quantity"), seq.alias("seq"))
    day = trades.groupBy("symbol", "ts").agg(
        F.min_by("price", "seq").alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", "seq").alias("close"),
        F.sum("quantity").alias("volume"))
    number = F.regexp_extract("symbol", r"(\d+)$", 1).cast("int")
    return day.withColumns({
        "source": F.when(number % 2 == 0, "feed_a").otherwise("feed_b"),
        "market": F.when(number % 3 == 0, "stocks").when(number % 3 == 1, "crypto")
        .otherwise("forex")})


BARS = """
trades AS (
  SELECT p_brand AS symbol, l_shipdate AS ts, l_extendedprice / l_quantity AS price,
         CAST(l_quantity AS BIGINT) AS quantity,
         (l_orderkey * 8 + l_linenumber) * 1048576
           + CAST(round(l_extendedprice * 100) AS BIGINT) % 1048576 AS seq
  FROM lineitem JOIN part ON l_partkey = p_partkey),
bars AS (
  SELECT symbol, ts, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, seq) AS close, CAST(sum(quantity) AS BIGINT) AS volume,
         CASE WHEN CAST(regexp_extract(symbol, '([0-9]+)$', 1) AS INT) % 2 = 0
              THEN 'feed_a' ELSE 'feed_b' END AS source,
         CASE CAST(regexp_extract(symbol, '([0-9]+)$', 1) AS INT) % 3
              WHEN 0 THEN 'stocks' WHEN 1 THEN 'crypto' ELSE 'forex' END AS market
  FROM trades GROUP BY symbol, ts)
"""

# -- ticks ---------------------------------------------------------------------------


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.upper("event_type").alias("symbol"), "ts",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"))


TICKS = """
ticks AS (
  SELECT event_id AS id, upper(event_type) AS symbol, ts, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events)
"""

# -- dirty text inputs ---------------------------------------------------------------


def raw_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as landed: text times in two formats, bad times, negative volumes, crossed
    high/low, missing symbols, and a corrected copy of every bar of the 15th."""
    b, day = bars(spark, sf), F.dayofmonth("ts")
    text = (F.when(day == 31, "n/a")
            .when(day % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    dirty = b.select(
        F.when(~((day == 28) & (F.month("ts") == 2)), F.col("symbol")).alias("symbol"),
        text.alias("timestamp"), "open",
        F.when(day == 29, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        "low", "close",
        F.when(day == 30, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        "source", "market", day.alias("day"))
    # The copy is made by exploding, so the bars are computed once. The time text goes through
    # the explode as well: filters on it then run on bars and are not pushed down to trades.
    def row(close):
        return F.struct(F.col("timestamp"), close.alias("close"))

    copies = F.when(F.col("day") == 15, F.array(row(F.col("close")), row(F.col("low")))).otherwise(
        F.array(row(F.col("close"))))
    return dirty.withColumn("r", F.explode(copies)).select(
        "symbol", "r.timestamp", "open", "high", "low", "r.close", "volume", "source", "market")


RAW_BARS = """
raw0 AS (
  SELECT CASE WHEN NOT (day(ts) = 28 AND month(ts) = 2) THEN symbol END AS symbol,
         CASE WHEN day(ts) = 31 THEN 'n/a'
              WHEN day(ts) % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
         open, CASE WHEN day(ts) = 29 THEN low - 1 ELSE high END AS high, low, close,
         CASE WHEN day(ts) = 30 THEN -volume ELSE volume END AS volume, source, market,
         day(ts) AS d
  FROM bars),
raw_bars AS (
  SELECT * EXCLUDE (d) FROM raw0
  UNION ALL SELECT * EXCLUDE (d) REPLACE (low AS close) FROM raw0 WHERE d = 15)
"""


def price_records(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks as untyped records with the usual faults."""
    t, i = ticks(spark, sf), F.col("id")
    return t.select(
        F.when(i % 7 == 0, F.concat(F.lit("  "), F.lower("symbol"), F.lit(" ")))
        .otherwise(F.col("symbol")).alias("symbol"),
        F.when(i % 101 == 0, "2030-01-01 00:00:00").when(i % 103 == 0, "bad")
        .when(i % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        F.col("price").cast("string").alias("open"),
        (F.col("price") + 1).cast("string").alias("high"),
        (F.col("price") - 1).cast("string").alias("low"),
        F.when(i % 13 == 0, F.col("price") + 2).otherwise(F.col("price")).cast("string")
        .alias("close"),
        F.when(i % 17 == 0, "-5").when(i % 19 == 0, "many")
        .otherwise(F.col("volume").cast("string")).alias("volume"),
        F.when(i % 23 == 0, F.lit(None)).when(i % 5 == 0, " feed_x ").otherwise("feed_y")
        .alias("source"))


PRICE_RECORDS = """
price_records AS (
  SELECT CASE WHEN id % 7 = 0 THEN '  ' || lower(symbol) || ' ' ELSE symbol END AS symbol,
         CASE WHEN id % 101 = 0 THEN '2030-01-01 00:00:00' WHEN id % 103 = 0 THEN 'bad'
              WHEN id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
         CAST(price AS VARCHAR) AS open, CAST(price + 1 AS VARCHAR) AS high,
         CAST(price - 1 AS VARCHAR) AS low,
         CAST(CASE WHEN id % 13 = 0 THEN price + 2 ELSE price END AS VARCHAR) AS close,
         CASE WHEN id % 17 = 0 THEN '-5' WHEN id % 19 = 0 THEN 'many'
              ELSE CAST(volume AS VARCHAR) END AS volume,
         CASE WHEN id % 23 = 0 THEN NULL WHEN id % 5 = 0 THEN ' feed_x ' ELSE 'feed_y' END
           AS source
  FROM ticks)
"""


def indicator_records(spark: SparkSession, sf: str) -> DataFrame:
    t, i = ticks(spark, sf), F.col("id")
    return t.select(
        "symbol",
        F.when(i % 103 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("timestamp"),
        (F.col("price") * 4).cast("string").alias("rsi"),
        F.when(i % 29 == 0, "none").otherwise((F.col("volume") - 50).cast("string"))
        .alias("macd"),
        F.when(i % 11 != 0, F.lit("1.5")).alias("macd_signal"),
        F.lit("-0.25").alias("macd_histogram"),
        F.col("price").cast("string").alias("sma_20"),
        (F.col("price") - 1).cast("string").alias("sma_50"))


INDICATOR_RECORDS = """
indicator_records AS (
  SELECT symbol, CASE WHEN id % 103 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
           AS "timestamp",
         CAST(price * 4 AS VARCHAR) AS rsi,
         CASE WHEN id % 29 = 0 THEN 'none' ELSE CAST(volume - 50 AS VARCHAR) END AS macd,
         CASE WHEN id % 11 <> 0 THEN '1.5' END AS macd_signal, '-0.25' AS macd_histogram,
         CAST(price AS VARCHAR) AS sma_20, CAST(price - 1 AS VARCHAR) AS sma_50
  FROM ticks)
"""

SQL_TIME = """coalesce(try_strptime("timestamp", '%Y-%m-%d %H:%M:%S'),
  try_strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ'))"""
