"""The event path as one stream: quotes, their change against the previous quote, anomalies,
classified alerts, the users who want them, one notification per user, symbol and period, and a
row per channel with its text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators import alerts as al, anomalies as an, lookups as lk
from tickloom.streaming import aggregates as agg, processors as proc

#: What a notification needs of its alert, beside audience, symbol and time.
CARRIED = ("alert_id", "severity", "formatted_message")


class PeriodLimiter(StatefulProcessor):
    """The first alert of each period for an audience and symbol.

    Alerts come in the order of time from trigger to trigger, as the state before flushes them so;
    within a trigger the earliest of a period is kept, the smallest id of equal times. The state
    is the start of the newest period that had its alert; a timer at the period's end removes it.
    """

    OUTPUT = ("audience string, symbol string, ts timestamp, "
              + ", ".join(f"{c} string" for c in CARRIED) + ", closed timestamp")

    def __init__(self, period_ms: int) -> None:
        self.period_ms = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "period bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done = self.open.get()[0] if self.open.exists() else None
        first: dict[int, tuple] = {}
        for chunk in rows:
            periods = chunk["at"] // (self.period_ms * 1000)
            for period, at, alert, *rest in zip(periods, chunk["at"], chunk["alert_id"], chunk["ts"],
                                                chunk["severity"], chunk["formatted_message"],
                                                chunk["closed"]):
                row = (at, alert, *rest)
                if (done is None or period > done) and (period not in first
                                                        or row[:2] < first[period][:2]):
                    first[period] = row
        if not first:
            return
        newest = int(max(first))
        self.open.update((newest,))
        self.handle.registerTimer((newest + 1) * self.period_ms)
        yield pd.DataFrame([
            (*key, ts, alert, severity, message, closed)
            for _, (_, alert, ts, severity, message, closed) in sorted(first.items())],
            columns=["audience", "symbol", "ts", "alert_id", "severity", "formatted_message", "closed"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists() and (self.open.get()[0] + 1) * self.period_ms \
                <= expiredTimerInfo.getExpiryTimeInMs():
            self.open.clear()
        return iter(())

    def close(self) -> None:
        pass


def alerts_of(quotes: DataFrame) -> DataFrame:
    """Classified and enriched alerts of quotes with ``previous_price`` and ``previous_volume``;
    the same on tables and on streams. The id is symbol and quote id."""
    found = an.event_anomalies(lk.quote_metrics_of(quotes, "price")).filter("anomaly_detected")
    named = found.withColumns({"alert_type": F.lit("financial_anomaly"),
                               "alert_id": F.concat_ws("|", "symbol", "id")})
    return al.enrich_alert(al.classify_alert(named))


def first_alerts(alerts: DataFrame, period_ms: int) -> DataFrame:
    """The earliest alert (the smallest id of equal times) of each symbol, severity, minute of the day
    and period, among those that a piece of time has flushed. An audience takes all alerts of such a
    group or none, so the others are never the first of its period; they go before the audiences come
    in. The groups close with their piece, so the state holds none from one trigger to the next."""
    period = F.floor(F.unix_micros("ts") / (period_ms * 1000))
    groups = alerts.groupBy("closed", "symbol", "severity", al.group_minute().alias("_minute"),
                            period.alias("_period"))
    rest = [c for c in CARRIED if c != "severity"]
    return groups.agg(F.min(F.struct("ts", *rest)).alias("_first")).select(
        "symbol", "_first.ts", "closed", "severity", *[f"_first.{c}" for c in rest])


def audience_of(alerts: DataFrame, classes: DataFrame, salts: int = 8) -> DataFrame:
    """Alerts of a stream with each audience that takes them. ``classes`` is a table
    (``alerts.audience_classes``): those that name symbols meet the stream in an equi-join by symbol;
    the few that take any are repeated per salt."""
    wants = classes.select(
        "audience", "symbols", al.severity_rank("severity_threshold").alias("_rank"),
        F.coalesce("start_at", F.lit("00:00")).alias("_from"),
        F.coalesce("end_at", F.lit("23:59")).alias("_to"))
    any_ = F.coalesce(F.size("symbols") <= 0, F.lit(True))
    salted = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)),
                         lambda i: F.concat(F.lit("#"), i.cast("string")))
    by = F.when(any_, salted).otherwise(F.transform(
        F.array_distinct(F.array_compact("symbols")), lambda s: F.concat(F.lit("="), s)))
    wants = wants.withColumn("_by", F.explode(by)).drop("symbols")
    salt = F.concat(F.lit("#"), F.pmod(F.xxhash64("alert_id"), F.lit(salts)).cast("string"))
    looked = alerts.withColumn("_by", F.explode(F.array_compact(F.array(
        F.concat(F.lit("="), F.col("symbol")), salt))))
    minute = al.group_minute()
    return looked.join(wants, "_by").where(
        (al.severity_rank("severity") >= F.col("_rank"))
        & (minute.isNull() | minute.between(F.col("_from"), F.col("_to")))) \
        .drop("_by", "_rank", "_from", "_to")


def notifications(quotes: DataFrame, users: DataFrame, delay: str = "10 minutes",
                  piece_ms: int = 60_000, keep_ms: int | None = None,
                  period_ms: int = 3_600_000) -> DataFrame:
    """The stream of notifications: user_id, channel, alert_id, symbol, ts, severity, text.

    ``quotes``: a stream of symbol, id, ts, price, volume; ``users``: a table. Quotes wait until
    the watermark, ``delay`` behind the newest, has passed their piece of event time, so those
    that are late within it are compared with the right previous quote. A quote later than
    ``keep_ms`` after the last one has no previous one.

    Two keyed states follow each other: previous quotes by symbol, and open periods by audience
    and symbol; between them only the first alerts of a group go on (``first_alerts``). Users of equal wants are one audience; they and their channels are joined behind
    the limiter, so the state holds audiences, not users. Alerts may pass only while both sides of
    the joins are small or partitioned by symbol; users are read anew by every micro-batch.

    Defined cases: a quote without symbol, time, price or volume is left out; a later quote than
    the delay allows is dropped; equal times are ordered by id.
    """
    known = quotes.where("symbol IS NOT NULL AND price IS NOT NULL AND volume IS NOT NULL")
    rows = agg.with_watermark(known.select("symbol", "id", "ts", "price", "volume"), delay)
    ordered = proc.stream_previous_quote(rows, keep_ms, piece_ms)
    members = al.with_audience(users)
    found = first_alerts(alerts_of(ordered).select("symbol", "ts", "closed", *CARRIED), period_ms)
    taken = audience_of(found, al.audience_classes(members))
    limited = taken.select("audience", "symbol", "ts", *CARRIED, "closed",
                           F.unix_micros("ts").alias("at")) \
        .groupBy("audience", "symbol").transformWithStateInPandas(
            statefulProcessor=PeriodLimiter(period_ms), outputStructType=PeriodLimiter.OUTPUT,
            outputMode="Append", timeMode="EventTime", eventTimeColumnName="closed")
    sent = limited.join(members.select("audience", "user_id", "channels"), "audience")
    return al.notification_plan(sent).select(
        "user_id", "channel", "alert_id", "symbol", "ts", "severity", "text")
