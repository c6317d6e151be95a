"""Alerts as tables: classification, text, audience, pacing and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import fixed, ratio
from tickloom.session import staged

# Alert limits.
CRITICAL_MOVE, MAJOR_MOVE, CRITICAL_SPIKE = 15.0, 10.0, 10.0
SMS_CHARS = 150

# Recommended actions by severity, and link templates.
ACTIONS = {
    "critical": ["Vérifier les actualités récentes pour ce symbole",
                 "Examiner les volumes de trading anormaux",
                 "Considérer une révision de position si applicable"],
    "warning": ["Surveiller l'évolution dans les prochaines heures",
                "Vérifier les indicateurs techniques"],
    "info": ["Information à noter pour analyse future"],
}
LINKS = {
    "yahoo_finance": "https://finance.yahoo.com/quote/{symbol}",
    "google_finance": "https://www.google.com/finance/quote/{symbol}:NASDAQ",
    "news_search": "https://www.google.com/search?q={symbol}+stock+news",
}


def severity_rank(name: str | Column) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return (F.when(col == "critical", 3).when(col == "warning", 2).otherwise(1))


def classify_alert(alerts: DataFrame) -> DataFrame:
    """severity, urgency, category, requires_immediate_action.

    A volume spike of ten or more overrides the severity the price move gives; an extreme
    price code sets category and immediacy whatever the severity.
    """
    kind = F.col("alert_type")
    market = kind == "financial_anomaly"
    move = F.abs(F.coalesce("price_change_percent", F.lit(0.0)))
    codes = F.coalesce("anomalies_detected", F.array().cast("array<string>"))

    def coded(text: str) -> Column:
        return F.exists(codes, lambda a: a.contains(text))

    spike = coded("volume_spike") & (F.coalesce("volume_ratio", F.lit(1.0)) >= CRITICAL_SPIKE)
    extreme = coded("extreme_price_change")
    critical, major = move >= CRITICAL_MOVE, move >= MAJOR_MOVE
    return alerts.withColumns({
        "severity": F.when(market & (spike | critical), "critical")
        .when(market & major, "warning").when(kind == "system_event", "warning")
        .otherwise("info"),
        "urgency": F.when(market & (spike | critical), "high").when(market & major, "medium")
        .when(kind.isin("system_event", "user_threshold_alert"), "medium").otherwise("low"),
        "category": F.when(market & extreme, "extreme_movement")
        .when(kind == "system_event", "system")
        .when(kind == "user_threshold_alert", "user_defined").otherwise("price_movement"),
        "requires_immediate_action": market & (critical | extreme)})


def enrich_alert(classified: DataFrame) -> DataFrame:
    """Title, message, actions and links."""
    symbol, codes = F.col("symbol"), F.col("anomalies_detected")
    change = F.coalesce("price_change_percent", F.lit(0.0))
    # The texts of title and message.
    lines = [F.concat(F.lit("🚨 Anomalie détectée pour "), symbol),
             F.format_string("💰 Prix actuel: $%.2f", fixed(F.col("price"), 2)),
             F.format_string("📊 Changement: %+.2f%%", fixed(change, 2)),
             F.concat(F.lit("📈 Volume: "), F.format_number("volume", 0)),
             F.when(F.size(codes) > 0,
                    F.concat(F.lit("⚠️ Anomalies: "), F.array_join(codes, ", ")))]
    market = F.col("alert_type") == "financial_anomaly"
    actions = F.when(F.lit(False), F.array().cast("array<string>"))
    for level, texts in ACTIONS.items():
        actions = actions.when(F.col("severity") == level, F.array(*[F.lit(t) for t in texts]))
    return classified.withColumns({
        "display_title": F.when(market, F.concat(F.lit("Anomalie détectée: "), symbol)),
        "formatted_message": F.when(market, F.concat_ws("\n", *lines)),
        "action_items": F.when(market, actions),
        "links": F.struct(
            *[F.replace(F.lit(link), F.lit("{symbol}"),
                        F.url_encode(symbol) if name == "news_search" else symbol).alias(name)
              for name, link in LINKS.items()])})


def sms_text(alerts: DataFrame) -> Column:
    """Short form: symbol, severity and the first characters of the message."""
    # The texts around them.
    return F.concat(F.lit("Alerte "), F.col("symbol"), F.lit(": "), F.upper("severity"),
                    F.lit("\n"), F.substring("formatted_message", 1, SMS_CHARS), F.lit("..."))


# -- audience ------------------------------------------------------------------------
#
# An alert's symbol, severity and minute of the day decide who gets it, and a user's symbols,
# threshold and hours decide what they get. So alerts are reduced to groups and users to classes
# before they are joined; the rows of alerts and of users come back behind the join, if at all.

_WANTS = ("symbols", "severity_threshold", "start_at", "end_at")
#: Alert groups that the classes without a symbol list meet in one task.
ANY_ROWS = 65_536


def with_audience(users: DataFrame) -> DataFrame:
    """``users`` with ``audience``, the same for users of equal symbols, threshold and hours.

    ``users``: user_id, channels, severity_threshold, symbols (null or empty = all), start_at,
    end_at ('HH:mm', null = no limit). Nulls in a symbol list ask for nothing.
    """
    symbols = F.when(F.size("symbols") > 0, F.array_sort(F.array_distinct(
        F.array_compact("symbols"))))
    return users.withColumn("audience", F.sha2(F.to_json(F.struct(
        symbols.alias("symbols"), *_WANTS[1:])), 256))


def audience_classes(members: DataFrame, *counts: Column) -> DataFrame:
    """One row per audience with its wants, and aggregates over its users."""
    return members.groupBy("audience").agg(*[F.first(c).alias(c) for c in _WANTS], *counts)


def group_minute() -> Column:
    """The minute of the day; critical alerts go out at any."""
    return F.when(~F.coalesce(F.col("severity") == "critical", F.lit(False)),
                  F.date_format("ts", "HH:mm"))


def alert_groups(alerts: DataFrame, *aggregates: Column, keys: tuple[Column, ...] = ()) -> DataFrame:
    """Alerts by symbol, severity and minute of the day, and ``keys``."""
    return alerts.groupBy("symbol", "severity", group_minute().alias("minute"), *keys).agg(*aggregates)


def match_classes(groups: DataFrame, classes: DataFrame, any_rows: int = ANY_ROWS) -> DataFrame:
    """Groups with each audience whose symbols, threshold and hours take them.

    Classes that name symbols meet the groups in an equi-join by symbol. Those that take any are
    few (thresholds and hours only); the groups are dealt to as many salts as their number asks
    for, and these classes are repeated for each.
    """
    wants = classes.withColumn("_rank", severity_rank("severity_threshold")).select(
        "audience", "_rank", "symbols", F.coalesce("start_at", F.lit("00:00")).alias("_from"),
        F.coalesce("end_at", F.lit("23:59")).alias("_to"))
    fits = (severity_rank("severity") >= F.col("_rank")) & (
        F.col("minute").isNull() | F.col("minute").between(F.col("_from"), F.col("_to")))
    takes_any = F.coalesce(F.size("symbols") <= 0, F.lit(True))
    named = wants.where(~takes_any).withColumn("symbol", F.explode(F.array_distinct("symbols")))
    open_ = wants.where(takes_any)
    out = groups.join(named.drop("symbols"), "symbol").where(fits)
    if not open_.isEmpty():
        salts = max(1, -(-groups.count() // any_rows))
        dealt = groups.withColumn("_salt", F.pmod(F.xxhash64(*groups.columns), F.lit(salts)))
        repeated = open_.drop("symbols").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        out = out.unionByName(dealt.join(repeated, "_salt").where(fits).drop("_salt"))
    return out.drop("_rank", "_from", "_to")


def match_alert_users(alerts: DataFrame, users: DataFrame) -> DataFrame:
    """Alert and user pairs allowed by severity, interest and hours: all columns of both but the
    wants' symbols. Only groups and classes are compared; pairs are made of the ones that fit."""
    members = with_audience(users)
    fit = match_classes(alert_groups(alerts, F.count(F.lit(1)).alias("_alerts")),
                        audience_classes(members)).drop("_alerts")
    same = [F.col("a.symbol").eqNullSafe(F.col("m.symbol")),
            F.col("a.severity").eqNullSafe(F.col("m.severity")),
            F.col("a._minute").eqNullSafe(F.col("m.minute"))]
    return (alerts.withColumn("_minute", group_minute()).alias("a").join(fit.alias("m"), same)
            .select("a.*", "m.audience").join(members.drop("symbols"), "audience")
            .drop("audience", "_minute"))


def user_alert_counts(alerts: DataFrame, users: DataFrame) -> DataFrame:
    """Per user and severity: alerts, symbols (distinct), first_ts, last_ts. Counted per audience;
    users come in last."""
    members = with_audience(users)
    groups = alert_groups(alerts, F.count(F.lit(1)).alias("alerts"), F.min("ts").alias("first_ts"),
                          F.max("ts").alias("last_ts"))
    per_symbol = match_classes(groups, audience_classes(members)).groupBy(
        "audience", "severity", "symbol").agg(
        F.sum("alerts").alias("alerts"), F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"))
    return per_symbol.groupBy("audience", "severity").agg(
        F.sum("alerts").alias("alerts"), F.count("symbol").alias("symbols"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")) \
        .join(members.select("audience", "user_id"), "audience").drop("audience")


def limited_notifications(alerts: DataFrame, users: DataFrame, period: str = "1 hour") -> DataFrame:
    """The first notification of each user and symbol in each period: the users' columns, symbol,
    ts, and alert_id where alerts have one (the smallest of equal times).

    Alerts are cut to the first per symbol, period, severity and minute of the day, and users to
    audiences, before they meet; the minimum per audience is widened to users at the end. The rest
    of an alert's columns is a join on its id away.
    """
    members = with_audience(users)
    first = F.struct(*[c for c in ("ts", "alert_id") if c in alerts.columns])
    period_start = F.window("ts", period).start.alias("_period")
    groups = alert_groups(alerts, F.min(first).alias("first"), keys=(period_start,)) \
        if "alert_id" in alerts.columns else \
        alert_groups(alerts, F.min("ts").alias("ts"), keys=(period_start,))
    fit = match_classes(groups, audience_classes(members))
    least = F.min("first" if "first" in fit.columns else "ts")
    limited = fit.groupBy("audience", "symbol", "_period").agg(least.alias("first"))
    found = [F.col("first.ts"), F.col("first.alert_id")] if "alert_id" in alerts.columns \
        else [F.col("first").alias("ts")]
    return (limited.select("audience", "symbol", *found)
            .join(members.drop("symbols"), "audience").drop("audience"))


def channel_totals(alerts: DataFrame, users: DataFrame) -> DataFrame:
    """Notifications per channel and severity: alerts of a group times users of an audience that
    have the channel, without a row per notification."""
    members = with_audience(users)
    groups = alert_groups(alerts, F.count(F.lit(1)).alias("alerts"))
    per_class = match_classes(groups, audience_classes(members)).groupBy("audience", "severity").agg(
        F.sum("alerts").alias("alerts"))
    subscribed = members.select("audience", F.explode("channels").alias("channel")).groupBy(
        "audience", "channel").agg(F.count(F.lit(1)).alias("users"))
    return per_class.join(subscribed, "audience").groupBy("channel", "severity").agg(
        F.sum(F.col("alerts") * F.col("users")).alias("notifications"))


def with_sent(alerts: DataFrame, users: DataFrame) -> DataFrame:
    """``alerts`` with ``sent``, the notifications each leads to: counted once per group."""
    members = with_audience(users)
    classes = audience_classes(members, F.sum(F.greatest(F.size("channels"), F.lit(0)))
                               .alias("_channels"))
    groups = alert_groups(alerts, F.count(F.lit(1)).alias("_alerts"))
    sent = (match_classes(groups, classes).join(classes.select("audience", "_channels"), "audience")
            .groupBy("symbol", "severity", "minute").agg(F.sum("_channels").alias("sent")))
    a, g = alerts.withColumn("_minute", group_minute()).alias("a"), sent.alias("g")
    return a.join(g, [F.col("a.symbol").eqNullSafe(F.col("g.symbol")),
                      F.col("a.severity").eqNullSafe(F.col("g.severity")),
                      F.col("a._minute").eqNullSafe(F.col("g.minute"))], "left") \
        .select("a.*", F.coalesce("g.sent", F.lit(0)).cast("long").alias("sent")).drop("_minute")


def rate_limit_alerts(matched: DataFrame, period: str = "1 hour") -> DataFrame:
    """The first row of each user and symbol in each period, of rows that are matched already
    (streams, small tables). Only times and ids go through the minimum, which is combined before
    the shuffle; the row itself is looked up. Whole tables of alerts and users:
    ``limited_notifications``."""
    key = ["user_id", "symbol"]
    order = [c for c in ("ts", "alert_id") if c in matched.columns]
    first = (matched.groupBy(*key, F.window("ts", period).alias("_w"))
             .agg(F.min(F.struct(*order)).alias("_first")).select(*key, "_first.*"))
    if set(matched.columns) == {*key, *order}:
        return first.select(*matched.columns)
    found = matched.alias("m").join(first.alias("f"), [
        F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*key, *order)]).select("m.*")
    return found.dropDuplicates([*key, *order])


def notification_plan(matched: DataFrame) -> DataFrame:
    """One row per alert, user and channel, with the text the channel carries."""
    return (matched.withColumn("channel", F.explode("channels"))
            .withColumn("text", F.when(F.col("channel") == "sms", sms_text(matched))
                        .otherwise(F.col("formatted_message")))
            .drop("channels"))


def channel_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("channel", "severity").agg(F.count(F.lit(1)).alias("notifications"))


def alert_batch_stats(processed: DataFrame) -> DataFrame:
    """processed, successful, notifications; ``success`` and ``sent`` per alert."""
    return processed.agg(F.count(F.lit(1)).alias("total_processed"),
                         F.count_if("success").alias("successful_processing"),
                         F.coalesce(F.sum("sent"), F.lit(0)).alias("total_notifications_sent"))


def anomaly_alert_rows(flagged: DataFrame) -> DataFrame:
    """An alert record per anomaly."""
    return flagged.filter("is_anomaly").select(
        F.concat_ws("|", "symbol", F.date_format("ts", "yyyyMMddHHmmss")).alias("alert_id"),
        F.lit("financial_anomaly").alias("alert_type"), "symbol", "ts",
        F.struct("price", "volume", "anomaly_score").alias("details"))


def prediction_alerts(best: DataFrame, move: float = 5.0, confidence: float = 0.7) -> DataFrame:
    """Large and trusted predictions. With the default confidences both limits cannot hold at
    once, so the limits are parameters."""
    return best.filter((F.abs("predicted_change_pct") > move)
                       & (F.col("confidence") > confidence)).withColumn(
        "alert_type", F.lit("significant_prediction"))


def batch_result_stats(results: DataFrame) -> DataFrame:
    """Totals of one processing batch; ``success`` and ``anomaly_detected`` per record."""
    ok = F.count_if("success")
    return results.agg(F.count(F.lit(1)).alias("total_records"), ok.alias("processed"),
                       F.count_if(~F.col("success")).alias("errors"),
                       F.count_if(F.col("success") & F.col("anomaly_detected"))
                       .alias("anomalies_detected"),
                       ratio(100.0 * ok, F.count(F.lit(1))).alias("success_rate"))
