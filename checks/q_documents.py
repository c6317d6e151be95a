"""Payload parsers, document statistics, routing and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import BARS, TICKS, bars, r, rounded, rounded_sql, rsql, ticks, with_ctes
from checks.q_indicators import RSI, MACD, W
from checks.q_tables import INDICATORS, METRICS, OHLC, QUOTES, indicators, quotes
from checks.registry import query
from tickloom.functions import labels
from tickloom.functions.times import latest, since
from tickloom.operators import (anomalies as an, documents as docs, lookups as lk, quality as q)
from tickloom.session import shared_folder
from tickloom.sinks import tables as sink
from tickloom.sources import payloads as pl

OHLC4 = rounded_sql(*OHLC)


def text(col: str):
    return F.col(col).cast("string")


def day_text(fmt: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format("ts", fmt)


def per_month(spark, sf, value, order="ts"):
    """Payload parts collected per symbol and month: at most 31 bars each."""
    b = bars(spark, sf)
    return b.groupBy("symbol", F.date_trunc("MONTH", "ts").alias("month")).agg(
        F.sort_array(F.collect_list(F.struct(order, value.alias("v")))).alias("items"))


# -- payloads ------------------------------------------------------------------------


@query("parse_quote_payload", with_ctes(BARS, body=f"""
SELECT symbol, {rsql('open')} AS open, {rsql('high')} AS high, {rsql('low')} AS low,
  {rsql('close')} AS price, CASE WHEN day(ts) % 7 = 0 THEN 0 ELSE volume END AS volume,
  strftime(ts, '%Y-%m-%d') AS latest_trading_day, 0.0::DOUBLE AS previous_close,
  {rsql('close - open')} AS change, {rsql('(close - open) / open * 100')} AS change_percent
FROM bars"""))
def _(spark, sf):
    b = bars(spark, sf)
    change = F.col("close") - F.col("open")
    fields = F.create_map(
        F.lit("01. symbol"), F.col("symbol"), F.lit("02. open"), text("open"),
        F.lit("03. high"), text("high"), F.lit("04. low"), text("low"),
        F.lit("05. price"), text("close"),
        F.lit("06. volume"), F.when(F.dayofmonth("ts") % 7 != 0, text("volume")),
        F.lit("07. latest trading day"), day_text("yyyy-MM-dd"),
        F.lit("09. change"), change.cast("string"),
        F.lit("10. change percent"),
        F.concat((change / F.col("open") * 100).cast("string"), F.lit("%")))
    landed = b.select("symbol", F.to_json(F.create_map(
        F.lit("Global Quote"), F.map_filter(fields, lambda k, v: v.isNotNull()))).alias("payload"))
    return pl.parse_quote_payload(landed).select(
        "symbol", *rounded("open", "high", "low", "price"), "volume", "latest_trading_day",
        "previous_close", *rounded("change", "change_percent"))


def keyed_landed(spark, sf, series: str, zone_key: str, volume_key: str, extra: bool):
    pairs = [F.lit("1. open"), text("open"), F.lit("2. high"), text("high"),
             F.lit("3. low"), text("low"), F.lit("4. close"), text("close"),
             F.lit(volume_key), text("volume")]
    if extra:
        pairs += [F.lit("5. adjusted close"), text("close")]
    value = F.struct(day_text().alias("k"), F.create_map(*pairs).alias("m"))
    months = bars(spark, sf).groupBy("symbol", F.date_trunc("MONTH", "ts").alias("month")).agg(
        F.collect_list(value).alias("items"))
    entries = F.map_from_entries("items")
    meta = F.when(F.month("month") % 2 == 0, F.create_map(F.lit(zone_key), F.lit("UTC"))).otherwise(
        F.create_map(F.lit("3. Last Refreshed"), F.date_format("month", "yyyy-MM")))
    return months.select("symbol", F.to_json(F.struct(
        meta.alias("Meta Data"), entries.alias(series))).alias("payload"))


ZONE = """CASE WHEN month(ts) % 2 = 0 THEN 'UTC' ELSE 'US/Eastern' END AS timezone,
  CASE WHEN month(ts) % 2 = 0 THEN '' ELSE strftime(ts, '%Y-%m') END AS last_refreshed"""


@query("parse_intraday_payload", with_ctes(BARS, body=f"""
SELECT symbol, '5min' AS "interval", {ZONE}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
  {OHLC4}, volume FROM bars"""))
def _(spark, sf):
    landed = keyed_landed(spark, sf, "Time Series (5min)", "6. Time Zone", "5. volume", False)
    return pl.parse_intraday_payload(landed, interval="5min").select(
        "symbol", "interval", "timezone", "last_refreshed", "timestamp", *rounded(*OHLC), "volume")


@query("parse_daily_payload", with_ctes(BARS, body=f"""
SELECT symbol, {ZONE}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, {OHLC4},
  {rsql('close')} AS adjusted_close, volume, 0.0::DOUBLE AS dividend_amount,
  1.0::DOUBLE AS split_coefficient FROM bars"""))
def _(spark, sf):
    landed = keyed_landed(spark, sf, "Time Series (Daily)", "5. Time Zone", "6. volume", True)
    return pl.parse_daily_payload(landed).select(
        "symbol", "timezone", "last_refreshed", "date", *rounded(*OHLC, "adjusted_close"),
        "volume", "dividend_amount", "split_coefficient")


@query("parse_stock_chart", with_ctes(BARS, body=f"""
SELECT symbol, strftime(ts, '%Y-%m-%d') || CASE WHEN day(ts) % 2 = 0 THEN ' 09:30' ELSE ' 00:00'
  END AS "timestamp", {OHLC4}, volume, 'stock_chart' AS source, 'stocks' AS market FROM bars"""))
def _(spark, sf):
    value = F.struct(day_text("yyyy-MM-dd").alias("date"),
                     F.when(F.dayofmonth("ts") % 2 == 0, "09:30").alias("minute"),
                     *OHLC, "volume")
    landed = per_month(spark, sf, value).select(
        "symbol", F.to_json(F.transform("items", lambda i: i["v"])).alias("payload"))
    return pl.parse_stock_chart(landed).select(
        "symbol", "timestamp", *rounded(*OHLC), "volume", "source", "market")


def millis():
    return (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).alias("ms")


@query("parse_price_series", with_ctes(BARS, """
nm AS (SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('month', ts) ORDER BY ts) AS i,
         count(*) OVER (PARTITION BY symbol, date_trunc('month', ts)) AS n FROM bars)""", body=f"""
SELECT symbol, ts, {rsql('close')} AS open, {rsql('close')} AS high, {rsql('close')} AS low,
  {rsql('close')} AS close, CASE WHEN i <= n - 2 THEN volume ELSE 0 END AS volume,
  'price_series' AS source, 'crypto' AS market FROM nm"""))
def _(spark, sf):
    value = F.struct(millis(), "close", "volume")
    items = per_month(spark, sf, value)
    prices = F.transform("items", lambda i: F.array(i["v"]["ms"].cast("double"), i["v"]["close"]))
    volumes = F.transform("items", lambda i: F.array(i["v"]["ms"].cast("double"),
                                                     i["v"]["volume"].cast("double")))
    # The last two points of a month have no volume.
    short = F.slice(volumes, F.lit(1), F.greatest(F.size("items") - 2, F.lit(0)))
    landed = items.select("symbol", F.to_json(F.struct(
        prices.alias("prices"), short.alias("total_volumes"))).alias("payload"))
    return pl.parse_price_series(landed).select(
        "symbol", "ts", *rounded(*OHLC), "volume", "source", "market")


@query("parse_klines", with_ctes(BARS, body=f"""
SELECT symbol, ts, {OHLC4}, volume, 'klines' AS source, 'crypto' AS market FROM bars"""))
def _(spark, sf):
    value = F.array(millis().cast("string"), text("open"), text("high"), text("low"),
                    text("close"), F.concat(text("volume"), F.lit(".75")))
    landed = per_month(spark, sf, value).select(
        "symbol", F.to_json(F.transform("items", lambda i: i["v"])).alias("payload"))
    return pl.parse_klines(landed).select(
        "symbol", "ts", *rounded(*OHLC), "volume", "source", "market")


@query("split_job_output", with_ctes(BARS, body=f"""
SELECT 'price_data' AS kind, symbol, strftime(ts, '%Y-%m-%d') AS "timestamp",
  {rsql('close')} AS close, NULL::DOUBLE AS sma_20 FROM bars
UNION ALL SELECT 'technical_indicators', symbol, strftime(ts, '%Y-%m-%d'), NULL,
  {rsql('high')} FROM bars WHERE month(ts) % 3 <> 0"""))
def _(spark, sf):
    value = F.struct(day_text("yyyy-MM-dd").alias("timestamp"), "close", "high")
    items = per_month(spark, sf, value)
    prices = F.transform("items", lambda i: F.struct(
        F.col("symbol"), i["v"]["timestamp"].alias("timestamp"), i["v"]["close"].alias("close")))
    inds = F.transform("items", lambda i: F.struct(
        F.col("symbol"), i["v"]["timestamp"].alias("timestamp"), i["v"]["high"].alias("sma_20")))
    landed = items.select(F.to_json(F.struct(
        prices.alias("price_data"),
        F.when(F.month("month") % 3 != 0, inds).alias("technical_indicators"))).alias("payload"))
    return pl.split_job_output(landed).select(
        "kind", F.coalesce("p.symbol", "i.symbol").alias("symbol"),
        F.coalesce("p.timestamp", "i.timestamp").alias("timestamp"),
        r("p.close").alias("close"), r("i.sma_20").alias("sma_20"))


@query("decode_base64_batch", with_ctes(TICKS, body="""
SELECT id, CASE WHEN id % 89 <> 0 AND id % 97 <> 0 THEN symbol END AS symbol,
  CASE WHEN id % 89 <> 0 AND id % 97 <> 0 THEN price END AS price,
  id % 89 <> 0 AND id % 97 <> 0 AS decoded FROM ticks"""))
def _(spark, sf):
    t, i = ticks(spark, sf), F.col("id")
    good = F.base64(F.to_json(F.struct("symbol", "price")).cast("binary"))
    records = t.select("id", F.when(i % 89 == 0, "@@@").when(
        i % 97 == 0, F.base64(F.lit("not json").cast("binary"))).otherwise(good).alias("data"))
    return pl.decode_base64_batch(records, "symbol string, price double")


@query("decode_stream_payload", with_ctes(BARS, body=f"""
SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", {OHLC4}, volume, source, market,
  ts AS arrived_at FROM bars"""))
def _(spark, sf):
    b = bars(spark, sf)
    message = F.struct("symbol", day_text().alias("timestamp"), *OHLC, "volume", "source",
                       "market")
    stream = b.select(F.to_json(message).cast("binary").alias("value"),
                      F.col("ts").alias("arrived_at"))
    return pl.decode_stream_payload(stream).select(
        "symbol", "timestamp", *rounded(*OHLC), "volume", "source", "market", "arrived_at")


# -- documents -----------------------------------------------------------------------


def bar_documents(spark, sf, unit: str):
    """Points of a symbol and month or quarter (at most 92 bars); closes of some days are 0."""
    b, day = bars(spark, sf), F.dayofmonth("ts")
    point = F.struct(F.when(day % 11 == 0, 0.0).otherwise(F.col("close")).alias("close"),
                     F.when(day % 5 == 0, 0).otherwise(F.col("volume")).alias("volume"))
    items = b.groupBy("symbol", F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("period")).agg(
        F.sort_array(F.collect_list(F.struct("ts", point.alias("p")))).alias("items"))
    return items.select("symbol", "period",
                        F.transform("items", lambda i: i["p"]).alias("data_points"))


def doc_cte(unit: str) -> str:
    return f"""
pt AS (SELECT symbol, date_trunc('{unit}', ts)::TIMESTAMP AS period, ts,
         CASE WHEN day(ts) % 11 <> 0 THEN close END AS close,
         CASE WHEN day(ts) % 5 <> 0 THEN volume END AS volume FROM bars),
dc AS (SELECT symbol, period, count(*) AS points,
         coalesce(list(close ORDER BY ts) FILTER (close IS NOT NULL), []) AS c,
         coalesce(list(volume ORDER BY ts) FILTER (volume IS NOT NULL), []) AS v
       FROM pt GROUP BY ALL)
"""


T3 = """CASE WHEN len(c) >= 5 THEN CASE
  WHEN (list_avg(c[-3:]) - list_avg(c[1:3])) / list_avg(c[1:3]) * 100 > 2 THEN 'uptrend'
  WHEN (list_avg(c[-3:]) - list_avg(c[1:3])) / list_avg(c[1:3]) * 100 < -2 THEN 'downtrend'
  ELSE 'sideways' END END"""
OLDER = """(CASE WHEN len(c) >= 10 THEN list_avg(c[len(c) - 9:len(c) - 5])
  ELSE coalesce(list_sum(c[1:len(c) - 5]), 0) / greatest(len(c) - 5, 1) END)"""
T5 = f"""CASE WHEN len(c) < 5 THEN 'insufficient_data'
  WHEN list_avg(c[-5:]) > {OLDER} * 1.02 THEN 'uptrend'
  WHEN list_avg(c[-5:]) < {OLDER} * 0.98 THEN 'downtrend' ELSE 'sideways' END"""


@query("intraday_stats", with_ctes(BARS, doc_cte("month"), body=f"""
SELECT symbol, period, {rsql('list_min(c)')} AS min_price, {rsql('list_max(c)')} AS max_price,
  {rsql('list_avg(c)')} AS avg_price, {rsql('list_max(c) - list_min(c)')} AS price_range,
  CASE WHEN len(c) > 0 THEN len(c) END::INT AS data_points_count,
  CASE WHEN len(c) > 0 AND len(v) > 0 THEN list_sum(v) END::BIGINT AS total_volume,
  CASE WHEN len(c) > 0 AND len(v) > 0 THEN floor(list_avg(v) + 0.5) END AS avg_volume,
  CASE WHEN len(c) > 0 AND len(v) > 0 THEN list_max(v) END AS max_volume, {T3} AS trend
FROM dc"""))
def _(spark, sf):
    out = docs.intraday_stats(bar_documents(spark, sf, "MONTH"))
    return out.drop("data_points").withColumns(
        {c: r(c) for c in ("min_price", "max_price", "avg_price", "price_range")})


@query("daily_doc_indicators", with_ctes(BARS, doc_cte("quarter"), body=f"""
SELECT symbol, period, points::INT AS points,
  CASE WHEN len(c) >= 20 THEN {rsql('list_avg(c[-20:])')} END AS sma_20,
  CASE WHEN len(c) >= 20 THEN {rsql("list_aggregate(c, 'stddev_samp')")} END AS volatility,
  CASE WHEN len(c) >= 20 THEN {T5} END AS trend_direction FROM dc"""))
def _(spark, sf):
    out = docs.daily_doc_indicators(bar_documents(spark, sf, "QUARTER"))
    return out.drop("data_points").withColumns({c: r(c) for c in ("sma_20", "volatility")})


def closes_of(spark, sf, unit):
    d = bar_documents(spark, sf, unit)
    closes = F.filter(F.transform("data_points", lambda p: p["close"]), lambda v: v != 0)
    return d.select("symbol", "period", closes.alias("c"))


@query("trend_3x3", with_ctes(BARS, doc_cte("week"), body=f"""
SELECT symbol, period, {T3} AS trend FROM dc"""))
def _(spark, sf):
    return closes_of(spark, sf, "WEEK").select(
        "symbol", "period", docs.trend_3x3(F.col("c")).alias("trend"))


@query("trend_5v5", with_ctes(BARS, doc_cte("month"), body=f"""
SELECT symbol, period, {T5} AS trend FROM dc"""))
def _(spark, sf):
    return closes_of(spark, sf, "MONTH").select(
        "symbol", "period", docs.trend_5v5(F.col("c")).alias("trend"))


@query("validate_document", with_ctes(BARS, doc_cte("month"), body="""
SELECT symbol, period, points::INT AS points FROM dc
WHERE month(period) % 4 <> 0 AND month(period) % 5 <> 0"""))
def _(spark, sf):
    d, month = bar_documents(spark, sf, "MONTH"), F.month("period")
    broken = d.select(F.when(month % 4 != 0, F.col("symbol")).alias("symbol"), "period",
                      F.when(month % 5 == 0, F.slice("data_points", 1, 0))
                      .otherwise(F.col("data_points")).alias("data_points"))
    return q.validate_document(broken).select("symbol", "period",
                                              F.size("data_points").alias("points"))


# -- quotes --------------------------------------------------------------------------

QE = """
qe AS (SELECT id, symbol, price, volume, CASE WHEN id % 3 = 0 THEN -price * 0.6 ELSE price * 0.01
         END AS change FROM quotes),
qe2 AS (SELECT *, coalesce(change / nullif(price, 0) * 100, 0) AS change_percent FROM qe)
"""


def quote_events(spark, sf):
    d = quotes(spark, sf).withColumn("change", F.when(F.col("id") % 3 == 0, -F.col("price") * 0.6)
                                     .otherwise(F.col("price") * 0.01))
    return d.withColumn("change_percent", F.coalesce(
        F.try_divide("change", "price") * 100, F.lit(0.0)))


@query("quote_enrich", with_ctes(TICKS, QUOTES, QE, body=f"""
SELECT id, symbol, CASE WHEN price > 0 THEN {rsql('price - change')} END AS previous_close,
  CASE WHEN price > 0 THEN {rsql('abs(change / price) * 100')} END AS price_volatility_indicator,
  CASE WHEN price > 0 THEN {rsql('volume / 1000000', 8)} END AS volume_normalized,
  CASE WHEN price > 0 THEN CASE WHEN price < 10 THEN 'small_cap_indicator' WHEN price < 100
    THEN 'mid_cap_indicator' ELSE 'large_cap_indicator' END END AS market_cap_tier FROM qe2"""))
def _(spark, sf):
    return q.quote_enrich(quote_events(spark, sf)).select(
        "id", "symbol", *rounded("previous_close", "price_volatility_indicator"),
        r("volume_normalized", 8).alias("volume_normalized"), "market_cap_tier")


@query("quote_flags", with_ctes(TICKS, QUOTES, QE, body="""
SELECT id, concat_ws(',', CASE WHEN price <= 0 THEN 'negative_or_zero_price' END,
  CASE WHEN volume < 0 THEN 'negative_volume' END,
  CASE WHEN abs(change_percent) > 50 THEN 'extreme_price_movement' END,
  CASE WHEN volume = 0 THEN 'zero_volume' END) AS flags FROM qe2"""))
def _(spark, sf):
    return q.quote_flags(quote_events(spark, sf)).select(
        "id", F.array_join("anomaly_flags", ",").alias("flags"))


TYPED = """
ty AS (SELECT *, CASE id % 6 WHEN 0 THEN 'real_time_quote' WHEN 1 THEN 'intraday'
  WHEN 2 THEN 'crypto_quote' WHEN 3 THEN 'daily' WHEN 4 THEN 'mystery' END AS data_type
  FROM quotes)
"""


def typed_events(spark, sf):
    m = F.col("id") % 6
    kind = (F.when(m == 0, "real_time_quote").when(m == 1, "intraday").when(m == 2, "crypto_quote")
            .when(m == 3, "daily").when(m == 4, "mystery"))
    return quotes(spark, sf).withColumn("data_type", kind)


@query("route_by_type", with_ctes(TICKS, QUOTES, TYPED, body="""
SELECT id, CASE WHEN coalesce(data_type, '') IN ('real_time_quote', 'intraday', 'crypto_quote',
    'daily') THEN data_type ELSE 'generic' END AS branch,
  CASE WHEN data_type IN ('real_time_quote', 'crypto_quote') THEN price END AS quote_price,
  CASE WHEN data_type = 'crypto_quote' THEN 'cryptocurrency' END AS asset_type,
  CASE WHEN data_type IS NULL OR data_type = 'mystery' THEN 'unknown_data_type' END AS status,
  CASE WHEN data_type IS NULL OR data_type = 'mystery' THEN 'unrecognised data type: '
    || coalesce(data_type, 'unknown') END AS warning FROM ty"""))
def _(spark, sf):
    return q.route_by_type(typed_events(spark, sf)).select(
        "id", "branch", F.col("quote.price").alias("quote_price"), "asset_type", "status",
        "warning")


@query("route_documents", with_ctes(BARS, doc_cte("month"), body=f"""
SELECT symbol, period, k AS branch, CASE WHEN k = 'intraday' THEN points::INT END AS intraday_points,
  CASE WHEN k = 'intraday' THEN {rsql('list_min(c)')} END AS min_price,
  CASE WHEN k = 'intraday' AND len(v) > 0 THEN list_sum(v) END::BIGINT AS total_volume,
  CASE WHEN k = 'intraday' THEN {T3} END AS trend,
  CASE WHEN k = 'daily' THEN points::INT END AS daily_points,
  CASE WHEN k = 'daily' AND len(c) >= 20 THEN {rsql('list_avg(c[-20:])')} END AS sma_20,
  CASE WHEN k = 'daily' AND len(c) >= 20 THEN {T5} END AS direction,
  CASE WHEN k = 'generic' THEN 'generic_financial_data' END AS processed_as
FROM (SELECT *, CASE month(period) % 3 WHEN 0 THEN 'intraday' WHEN 1 THEN 'daily' ELSE 'generic' END
  AS k FROM dc)"""))
def _(spark, sf):
    """The branches of events that carry points, and of those of an unknown type."""
    month = F.month("period") % 3
    events = bar_documents(spark, sf, "MONTH").withColumns({
        "data_type": F.when(month == 0, "intraday").when(month == 1, "daily").otherwise("mystery"),
        "price": F.lit(None).cast("double"), "volume": F.lit(None).cast("bigint"),
        "interval": F.lit("5min")})
    stats, tech = F.col("intraday.summary_statistics"), F.col("daily.technical_indicators")
    return q.route_by_type(events).select(
        "symbol", "period", "branch", F.col("intraday.data_points_count").alias("intraday_points"),
        r(stats["min_price"]).alias("min_price"), stats["total_volume"].alias("total_volume"),
        F.col("intraday.trend").alias("trend"), F.col("daily.data_points_count").alias("daily_points"),
        r(tech["sma_20"]).alias("sma_20"), tech["trend_direction"].alias("direction"),
        F.col("generic.processed_as").alias("processed_as"))


def envelopes(spark, sf):
    i = F.col("id")
    return typed_events(spark, sf).select(
        "id", F.when(i % 71 != 0, F.col("timestamp")).alias("processing_timestamp"),
        F.lit("delivery").alias("processor"),
        F.struct("symbol", "price", "volume").alias("original_data"),
        F.when(i % 73 != 0, F.struct("data_type")).alias("enriched"))


ENV_OK = "(id % 71 <> 0 AND symbol IS NOT NULL AND id % 73 <> 0)"


@query("validate_enriched", with_ctes(TICKS, QUOTES, body=f"""
SELECT id, {ENV_OK} AS is_valid FROM quotes"""))
def _(spark, sf):
    return q.validate_enriched(envelopes(spark, sf)).select("id", "is_valid")


@query("dead_letter_split", with_ctes(TICKS, QUOTES, body=f"""
SELECT id, CASE WHEN {ENV_OK} THEN 'Ok' ELSE 'ProcessingFailed' END AS result FROM quotes"""))
def _(spark, sf):
    return q.dead_letter_split(envelopes(spark, sf)).select("id", "result")


@query("write_dead_letters", with_ctes(TICKS, QUOTES, body=f"""
SELECT id, symbol, price, volume, {ENV_OK} AS delivered FROM quotes"""))
def _(spark, sf):
    """Both folders written in one pass and read back one by one."""
    base = shared_folder(spark)
    split = q.dead_letter_split(envelopes(spark, sf)).select("id", "original_data", "result")
    sink.write_dead_letters(split, base)
    kinds = "id bigint, original_data struct<symbol:string,price:double,volume:bigint>"
    ok, failed = (sink.read_delivered(spark, base, kinds, name).withColumn("delivered", F.lit(name == "Ok"))
                  for name in ("Ok", "ProcessingFailed"))
    return ok.unionByName(failed).select("id", "original_data.*", "delivered")


EVENT_ANOMALIES = METRICS + """,
ea AS (SELECT *, concat_ws(',',
  CASE WHEN abs(price_change_percent) > 10 THEN 'extreme_price_change_'
    || printf('%.2f', price_change_percent) || '%' END,
  CASE WHEN volume_ratio > 5 THEN 'volume_spike_' || printf('%.1f', volume_ratio) || 'x' END,
  CASE WHEN close <= 0 THEN 'invalid_price' END) AS anomalies FROM qm)
"""


@query("event_anomalies", with_ctes(BARS, METRICS, body="""
SELECT symbol, ts, coalesce(abs(price_change_percent) > 10, false) AS extreme,
  coalesce(volume_ratio > 5, false) AS spike,
  (CASE WHEN abs(price_change_percent) > 10 THEN 1 ELSE 0 END
   + CASE WHEN volume_ratio > 5 THEN 1 ELSE 0 END)::INT AS codes,
  coalesce(abs(price_change_percent) > 10, false) OR coalesce(volume_ratio > 5, false)
    AS anomaly_detected FROM qm"""))
def _(spark, sf):
    out = an.event_anomalies(lk.quote_metrics(bars(spark, sf)).withColumn("price", F.col("close")))
    codes = F.col("anomalies_detected")
    return out.select(
        "symbol", "ts", F.exists(codes, lambda a: a.startswith("extreme_price_change_"))
        .alias("extreme"), F.exists(codes, lambda a: a.startswith("volume_spike_"))
        .alias("spike"), F.size(codes).alias("codes"), "anomaly_detected")


# -- labels --------------------------------------------------------------------------


@query("label_rsi_sql", with_ctes(BARS, RSI, body=f"""
SELECT symbol, ts, {rsql('rsi')} AS rsi, CASE WHEN rsi > 70 THEN 'Overbought' WHEN rsi < 30
  THEN 'Oversold' ELSE 'Neutral' END AS rsi_label FROM rsi"""))
def _(spark, sf):
    from tickloom.operators.indicators import rsi
    return rsi(bars(spark, sf)).select("symbol", "ts", r("rsi").alias("rsi"),
                                       labels.rsi_label(F.col("rsi")).alias("rsi_label"))


@query("label_macd_sql", with_ctes(BARS, MACD, body="""
SELECT symbol, ts, CASE WHEN macd_line > signal_line AND macd_histogram > 0 THEN 'Bullish'
  WHEN macd_line < signal_line AND macd_histogram < 0 THEN 'Bearish' ELSE 'Neutral' END
  AS macd_label FROM macd"""))
def _(spark, sf):
    from tickloom.operators.indicators import macd
    return macd(bars(spark, sf)).select("symbol", "ts", labels.macd_label(
        F.col("macd_line"), F.col("signal_line"), F.col("macd_histogram")).alias("macd_label"))


LAST_HOUR = "ts >= (SELECT max(ts) FROM bars) - INTERVAL 1 HOUR"


@query("rsi_last_hour", with_ctes(BARS, RSI, body=f"""
SELECT symbol, ts, {rsql('rsi')} AS rsi, CASE WHEN rsi > 70 THEN 'Overbought' WHEN rsi < 30
  THEN 'Oversold' ELSE 'Neutral' END AS rsi_label FROM rsi WHERE {LAST_HOUR}"""))
def _(spark, sf):
    from tickloom.operators.indicators import rsi
    b = bars(spark, sf)
    return since(rsi(b), "1 HOUR", as_of=latest(b)).select("symbol", "ts", r("rsi").alias("rsi"),
                                            labels.rsi_label(F.col("rsi")).alias("rsi_label"))


@query("macd_last_hour", with_ctes(BARS, MACD, body=f"""
SELECT symbol, ts, CASE WHEN macd_line > signal_line AND macd_histogram > 0 THEN 'Bullish'
  WHEN macd_line < signal_line AND macd_histogram < 0 THEN 'Bearish' ELSE 'Neutral' END
  AS macd_label FROM macd WHERE {LAST_HOUR}"""))
def _(spark, sf):
    from tickloom.operators.indicators import macd
    b = bars(spark, sf)
    return since(macd(b), "1 HOUR", as_of=latest(b)).select("symbol", "ts", labels.macd_label(
        F.col("macd_line"), F.col("signal_line"), F.col("macd_histogram")).alias("macd_label"))


@query("prediction_confidence", with_ctes(BARS, body="""
SELECT symbol, ts, CASE WHEN abs((close - open) / open * 100) < 1 THEN 0.9
  WHEN abs((close - open) / open * 100) < 5 THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence
FROM bars"""))
def _(spark, sf):
    change = (F.col("close") - F.col("open")) / F.col("open") * 100
    return bars(spark, sf).select("symbol", "ts",
                                  labels.prediction_confidence(change).alias("confidence"))


def bucket_sql(value: str, n: int) -> str:
    return f"(('0x' || substr(md5({value}), 1, 8))::BIGINT % {n})::VARCHAR"


@query("partition_key", with_ctes(TICKS, body=f"""
SELECT id, CASE id % 3
  WHEN 0 THEN 'symbol_' || symbol || '_' || lpad({bucket_sql('symbol', 100)}, 2, '0')
  WHEN 1 THEN 'crypto_' || symbol || '_'
    || lpad({bucket_sql("strftime(ts, '%Y%m%d%H%M')", 100)}, 2, '0')
  ELSE 'event_' || lower(symbol) || '_' || {bucket_sql('lower(symbol)', 10)} END AS partition_key
FROM ticks"""))
def _(spark, sf):
    t = ticks(spark, sf)
    stream = (F.when(F.col("id") % 3 == 0, "financial").when(F.col("id") % 3 == 1, "crypto")
              .otherwise("events"))
    return t.select("id", labels.partition_key(stream, F.col("symbol"), F.lower("symbol"),
                                               F.col("ts")).alias("partition_key"))
