"""Alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import BARS, TICKS, bars, r, rsql, table, with_ctes
from checks.q_indicators import anomaly_cte
from checks.q_tables import METRICS, QUOTES, quotes
from checks.registry import query
from tickloom.functions.times import latest
from tickloom.operators import alerts as al, anomalies as an, lookups as lk
from tickloom.sinks.tables import alert_history

ALERTS = METRICS + """,
al0 AS (SELECT *, coalesce(abs(price_change_percent) > 10, false) AS extreme,
  coalesce(volume_ratio > 5, false) AS spike,
  CASE day(ts) WHEN 10 THEN 'system_event' WHEN 20 THEN 'user_threshold_alert'
    ELSE 'financial_anomaly' END AS alert_type,
  symbol || '|' || strftime(ts, '%Y%m%d') AS alert_id FROM qm),
al1 AS (SELECT *, alert_type = 'financial_anomaly' AS fin,
  abs(coalesce(price_change_percent, 0)) AS move FROM al0 WHERE extreme OR spike),
alerts AS (SELECT *,
  CASE WHEN fin AND (move >= 15 OR (spike AND volume_ratio >= 10)) THEN 'critical'
       WHEN fin AND move >= 10 THEN 'warning' WHEN alert_type = 'system_event' THEN 'warning'
       ELSE 'info' END AS severity,
  CASE WHEN fin AND (move >= 15 OR (spike AND volume_ratio >= 10)) THEN 'high'
       WHEN fin AND move >= 10 THEN 'medium' WHEN NOT fin THEN 'medium' ELSE 'low' END AS urgency,
  CASE WHEN fin AND extreme THEN 'extreme_movement' WHEN alert_type = 'system_event' THEN 'system'
       WHEN alert_type = 'user_threshold_alert' THEN 'user_defined' ELSE 'price_movement' END
    AS category,
  fin AND (move >= 15 OR extreme) AS requires_immediate_action FROM al1)
"""

USERS = """
users AS (SELECT c_custkey AS user_id,
  CASE c_mktsegment WHEN 'BUILDING' THEN ['email'] WHEN 'AUTOMOBILE' THEN ['email', 'sms']
    WHEN 'MACHINERY' THEN ['slack'] WHEN 'HOUSEHOLD' THEN ['email', 'slack']
    ELSE ['discord', 'sms'] END AS channels,
  CASE c_custkey % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' ELSE 'critical' END
    AS severity_threshold,
  CASE WHEN c_custkey % 97 = 0 THEN [] ELSE ['Brand#' || (c_nationkey + 1),
    'Brand#' || ((c_nationkey + 7) % 25 + 1)] END AS symbols,
  CASE c_custkey % 4 WHEN 1 THEN '09:00' WHEN 2 THEN '06:00' WHEN 3 THEN '00:00' END AS start_at,
  CASE c_custkey % 4 WHEN 1 THEN '17:00' WHEN 2 THEN '20:00' WHEN 3 THEN '23:59' END AS end_at
  FROM customer)
"""

MATCHED = """
rk AS (SELECT * FROM (VALUES ('info', 1), ('warning', 2), ('critical', 3)) t(name, rank)),
matched AS (SELECT a.alert_id, a.symbol, a.ts, a.severity, u.user_id, u.channels
  FROM alerts a JOIN users u ON list_contains(u.symbols, a.symbol) OR len(u.symbols) = 0
  JOIN rk x ON x.name = a.severity JOIN rk y ON y.name = u.severity_threshold
  WHERE x.rank >= y.rank AND (a.severity = 'critical'
    OR strftime(a.ts, '%H:%M') BETWEEN coalesce(u.start_at, '00:00')
       AND coalesce(u.end_at, '23:59')))
"""


def alerts(spark, sf):
    quoted = lk.quote_metrics(bars(spark, sf)).withColumn("price", F.col("close"))
    found = an.event_anomalies(quoted).filter("anomaly_detected")
    day = F.dayofmonth("ts")
    return al.classify_alert(found.withColumns({
        "alert_type": F.when(day == 10, "system_event").when(day == 20, "user_threshold_alert")
        .otherwise("financial_anomaly"),
        "alert_id": F.concat_ws("|", "symbol", F.date_format("ts", "yyyyMMdd"))}))


def users(spark, sf):
    c, key = table(spark, sf, "customer"), F.col("c_custkey")
    segment = F.col("c_mktsegment")

    def names(*items):
        return F.array(*[F.lit(i) for i in items])

    def brand(n):
        return F.concat(F.lit("Brand#"), n.cast("string"))

    nation = F.col("c_nationkey")
    return c.select(
        key.alias("user_id"),
        F.when(segment == "BUILDING", names("email")).when(
            segment == "AUTOMOBILE", names("email", "sms")).when(
            segment == "MACHINERY", names("slack")).when(
            segment == "HOUSEHOLD", names("email", "slack")).otherwise(
            names("discord", "sms")).alias("channels"),
        F.when(key % 3 == 0, "info").when(key % 3 == 1, "warning").otherwise("critical")
        .alias("severity_threshold"),
        F.when(key % 97 == 0, F.array().cast("array<string>")).otherwise(
            F.array(brand(nation + 1), brand((nation + 7) % 25 + 1))).alias("symbols"),
        F.when(key % 4 == 1, "09:00").when(key % 4 == 2, "06:00").when(key % 4 == 3, "00:00")
        .alias("start_at"),
        F.when(key % 4 == 1, "17:00").when(key % 4 == 2, "20:00").when(key % 4 == 3, "23:59")
        .alias("end_at"))


@query("classify_alert", with_ctes(BARS, ALERTS, body="""
SELECT alert_id, alert_type, severity, urgency, category, requires_immediate_action FROM alerts
"""))
def _(spark, sf):
    return alerts(spark, sf).select("alert_id", "alert_type", "severity", "urgency", "category",
                                    "requires_immediate_action")


@query("enrich_alert", with_ctes(BARS, ALERTS, body="""
SELECT alert_id, CASE WHEN fin THEN 'Anomalie détectée: ' || symbol END AS display_title,
  CASE WHEN fin THEN '🚨 Anomalie détectée pour ' || symbol || chr(10) || '💰 Prix actuel: $'
    || printf('%.2f', floor(close * 100 + 0.5) / 100) || chr(10) || '📊 Changement: '
    || printf('%+.2f', floor(price_change_percent * 100 + 0.5) / 100) || '%' || chr(10)
    || '📈 Volume: ' || volume END AS message_head,
  CASE WHEN fin THEN CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END END::INT
    AS actions,
  'https://www.google.com/search?q=' || replace(symbol, '#', '%23') || '+stock+news' AS news
FROM alerts"""))
def _(spark, sf):
    out = al.enrich_alert(alerts(spark, sf))
    head = F.regexp_replace(F.regexp_replace("formatted_message", "(?s)\n⚠.*$", ""), ",", "")
    return out.select("alert_id", "display_title", head.alias("message_head"),
                      F.when(F.col("action_items").isNotNull(), F.size("action_items"))
                      .alias("actions"), F.col("links.news_search").alias("news"))


@query("match_alert_users", with_ctes(BARS, ALERTS, USERS, MATCHED, body="""
SELECT user_id, severity, count(*) AS alerts, count(DISTINCT symbol) AS symbols,
  min(ts) AS first_ts, max(ts) AS last_ts FROM matched GROUP BY user_id, severity"""))
def _(spark, sf):
    return al.user_alert_counts(alerts(spark, sf), users(spark, sf))


@query("rate_limit_alerts", with_ctes(BARS, ALERTS, USERS, MATCHED, """
rl AS (SELECT user_id, symbol, min(ts) AS ts FROM matched
       GROUP BY user_id, symbol, floor(epoch(ts) / (7 * 86400)))""", body="""
SELECT user_id, symbol, count(*) AS notifications, max(ts) AS last_ts FROM rl
GROUP BY user_id, symbol"""))
def _(spark, sf):
    limited = al.limited_notifications(
        alerts(spark, sf).select("symbol", "ts", "severity"), users(spark, sf), "7 DAYS")
    return limited.groupBy("user_id", "symbol").agg(
        F.count(F.lit(1)).alias("notifications"), F.max("ts").alias("last_ts"))


@query("notification_plan", with_ctes(BARS, ALERTS, USERS, MATCHED, body="""
SELECT channel, severity, count(*) AS notifications
FROM (SELECT unnest(channels) AS channel, severity FROM matched) GROUP BY ALL"""))
def _(spark, sf):
    return al.channel_totals(alerts(spark, sf), users(spark, sf))


@query("alert_batch_stats", with_ctes(BARS, ALERTS, USERS, MATCHED, """
sent AS (SELECT alert_id, sum(len(channels)) AS sent FROM matched GROUP BY alert_id)""", body="""
SELECT count(*) AS total_processed, count(*) FILTER (price_change_percent IS NOT NULL) AS
  successful_processing, CAST(sum(coalesce(sent, 0)) AS BIGINT) AS total_notifications_sent
FROM alerts LEFT JOIN sent USING (alert_id)"""))
def _(spark, sf):
    processed = al.with_sent(alerts(spark, sf), users(spark, sf)).withColumn(
        "success", F.col("price_change_percent").isNotNull())
    return al.alert_batch_stats(processed)


@query("anomaly_alert_rows", with_ctes(BARS, anomaly_cte("bars"), body=f"""
SELECT symbol || '|' || strftime(ts, '%Y%m%d%H%M%S') AS alert_id, symbol, ts,
  {rsql('close')} AS price, volume, {rsql('greatest(abs(price_zscore), abs(volume_zscore))')}
    AS anomaly_score FROM flagged WHERE anomaly_type <> 'NONE'"""))
def _(spark, sf):
    flagged = an.zscore_anomalies(bars(spark, sf)).withColumns({
        "is_anomaly": F.col("anomaly_type") != "NONE", "price": F.col("close"),
        "anomaly_score": F.greatest(F.abs("price_zscore"), F.abs("volume_zscore"))})
    return al.anomaly_alert_rows(flagged).select(
        "alert_id", "symbol", "ts", r("details.price").alias("price"), "details.volume",
        r("details.anomaly_score").alias("anomaly_score"))


@query("batch_result_stats", with_ctes(TICKS, QUOTES, body=f"""
SELECT count(*) AS total_records, count(*) FILTER (symbol IS NOT NULL) AS processed,
  count(*) FILTER (symbol IS NULL) AS errors,
  count(*) FILTER (symbol IS NOT NULL AND price <= 0) AS anomalies_detected,
  {rsql('100.0 * count(*) FILTER (symbol IS NOT NULL) / count(*)')} AS success_rate
FROM quotes"""))
def _(spark, sf):
    results = quotes(spark, sf).select(
        F.col("symbol").isNotNull().alias("success"),
        F.coalesce(F.col("price") <= 0, F.lit(False)).alias("anomaly_detected"))
    return al.batch_result_stats(results).withColumn("success_rate", r("success_rate"))


@query("alert_history_append", with_ctes(BARS, ALERTS, body="""
SELECT alert_id, symbol, alert_type, severity,
  CAST(epoch((SELECT max(ts) FROM bars) + INTERVAL 90 DAY) AS BIGINT) AS ttl FROM alerts"""))
def _(spark, sf):
    b = bars(spark, sf)
    history = alert_history(alerts(spark, sf), latest(b))
    return history.filter(F.get_json_object("alert_data", "$.symbol") == F.col("symbol")).select(
        "alert_id", "symbol", "alert_type", "severity", "ttl")
