"""Alarms on streams: averages over a limit for some periods running, each change told once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.streaming.aggregates import with_watermark

ALARM, OK = "ALARM", "OK"


class AlarmProcessor(StatefulProcessor):
    """Counts periods over the limit that follow each other without a gap.

    The state is the newest period, the run up to it, and whether the alarm is on. A timer stands
    at the end of the period behind it: if that passes without a row, the run is over.
    """

    def __init__(self, by: str, limit: float, length_ms: int, periods: int) -> None:
        self.by, self.limit, self.length, self.periods = by, limit, length_ms, periods
        self.output = f"{by} string, period timestamp, state string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "period bigint, run int, on boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, run, on = self.last.get() if self.last.exists() else (None, 0, False)
        out = []
        new = pd.concat(list(rows)).sort_values("at")
        for at, statistic in zip(new["at"].tolist(), new["statistic"].tolist()):
            if last is not None and at != last + self.length:
                if on:
                    out.append((last + self.length, OK))
                run, on = 0, False
            run = run + 1 if statistic > self.limit else 0
            if on != (run >= self.periods):
                on = not on
                out.append((at, ALARM if on else OK))
            last = at
        self.last.update((last, run, on))
        self.handle.registerTimer(last + 2 * self.length)
        yield from self._changes(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.last.exists():
            return
        last, _, on = self.last.get()
        if last + 2 * self.length <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
            yield from self._changes(key, [(last + self.length, OK)] if on else [])

    def _changes(self, key, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            at, state = zip(*out)
            yield pd.DataFrame({self.by: key[0], "period": pd.to_datetime(at, unit="ms"),
                                "state": state})

    def close(self) -> None:
        pass


def stream_alarms(metrics: DataFrame, limit: float, length_ms: int = 300_000, periods: int = 2,
                  by: str = "stream", delay: str = "10 minutes") -> DataFrame:
    """Changes of the alarm of each ``by``: the period from which it is on or off again.

    ``metrics``: a stream of ``by``, ts, value. Averages per period are closed by the watermark;
    the run of periods is keyed state behind them. ``alarm_changes`` is the same on tables.
    """
    rows = with_watermark(metrics.select(by, "ts", "value"), delay)
    windows = rows.groupBy(by, F.window("ts", f"{length_ms} milliseconds").alias("w")).agg(
        F.avg("value").alias("statistic"))
    closed = windows.select(by, F.window_time("w").alias("closed"),
                            F.unix_millis("w.start").alias("at"), "statistic")
    processor = AlarmProcessor(by, limit, length_ms, periods)
    return closed.groupBy(by).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Append",
        timeMode="EventTime")


def alarm_changes(alarmed: DataFrame, length_ms: int = 300_000, by: str = "stream") -> DataFrame:
    """The changes in ``threshold_alarm``'s table: an alarm is on from the first of its periods,
    and off again from the period behind the last, with or without rows."""
    on = alarmed.filter("in_alarm").select(by, "period")
    step = F.expr(f"INTERVAL '{length_ms / 1000}' SECOND")
    starts = on.join(on.select(by, (F.col("period") + step).alias("period")), [by, "period"], "left_anti")
    ends = on.select(by, (F.col("period") + step).alias("period")).join(on, [by, "period"], "left_anti")
    return starts.withColumn("state", F.lit(ALARM)).unionByName(
        ends.withColumn("state", F.lit(OK)))
