"""Streams in several micro-batches must equal the batch form."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.series import Series
from tickloom.operators import alerts, lookups
from tickloom.plans import events
from tickloom.streaming import aggregates as agg, jobs, processors as proc, serving

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, id bigint, ts timestamp, price double, volume bigint"


@pytest.fixture(scope="module")
def ticks():
    rng = np.random.default_rng(11)
    n = 300
    return pd.DataFrame({"symbol": np.where(rng.random(n) < 0.7, "HOT", "B"), "id": range(n),
                         "ts": [T0 + dt.timedelta(seconds=20 * i) for i in range(n)],
                         "price": 100 + rng.normal(0, 1, n).cumsum(),
                         "volume": rng.integers(1, 100, n)})


def land(spark, pdf, path, parts):
    for chunk in np.array_split(np.arange(len(pdf)), parts):
        spark.createDataFrame(pdf.iloc[chunk], SCHEMA).coalesce(1).write.mode("append").parquet(
            str(path))


def run(spark, out, path):
    jobs.to_files(out, f"{path}/out", f"{path}/state", every=None).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def stream_of(spark, path):
    return jobs.read_stream(spark, str(path), spark.read.parquet(str(path)).schema,
                            files_per_trigger=1)


def test_state_survives_micro_batches(spark, ticks, tmp_path):
    jobs.use_rocksdb(spark)
    land(spark, ticks, tmp_path / "in", 4)
    got = run(spark, proc.stream_rolling(stream_of(spark, tmp_path / "in")), tmp_path
              ).toPandas().sort_values("id", ignore_index=True)
    g = ticks.groupby("symbol")["price"]
    np.testing.assert_allclose(got["sma_20"], g.transform(
        lambda x: x.rolling(20, min_periods=1).mean()), rtol=1e-9)
    z = g.transform(lambda x: (x - x.rolling(51, min_periods=1).mean())
                    / x.rolling(51, min_periods=1).std())
    np.testing.assert_allclose(got["price_zscore"].astype(float), z, rtol=1e-6)


def test_a_micro_batch_has_no_more_partitions_than_cores(spark, ticks, tmp_path):
    jobs.use_rocksdb(spark)
    land(spark, ticks, tmp_path / "in", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        q = jobs.to_files(proc.stream_rolling(stream_of(spark, tmp_path / "in")),
                          f"{tmp_path}/out", f"{tmp_path}/state", every=None)
        q.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] <= 8


# Queries of bounded streams
BOUNDED = ["stream_previous_quote_expiry", "stream_sliding_agg", "serving_upsert", "stream_alarms",
           "stream_anomalies", "stream_ema", "stream_indicators", "stream_previous_quote", "stream_market_agg",
           "multi_query"]


@pytest.mark.parametrize("name", BOUNDED)
def test_a_query_starts_no_stream_with_200_partitions(spark, tmp_path, monkeypatch, name):
    from checks import q_streams, registry  # noqa: F401 (registers its queries)
    key, started, begin = "spark.sql.shuffle.partitions", [], DataStreamWriter.start

    def recorded(writer, *args, **kwargs):
        started.append(int(spark.conf.get(key)))
        return begin(writer, *args, **kwargs)

    monkeypatch.setattr(DataStreamWriter, "start", recorded)
    rows = [(i, T0 + dt.timedelta(minutes=20 * i), "view", float(i % 40)) for i in range(1, 90)]
    before = spark.conf.get(key)
    spark.conf.set(key, "200")
    try:
        assert registry.QUERIES[name](spark, events_table(spark, rows, tmp_path)).columns
    finally:
        spark.conf.set(key, before)
    assert started and max(started) <= 8


def test_triggers_take_several_files(spark, tmp_path, monkeypatch):
    from checks import q_streams
    monkeypatch.setattr(q_streams, "LANDED_ROWS", 10)
    rows = spark.range(1000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    q = jobs.to_files(q_streams.event_stream(spark, str(tmp_path)), f"{tmp_path}/out",
                      f"{tmp_path}/state", every=None)
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 4 and len(q.recentProgress) <= 6  # 100 files
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000


def test_stream_ema_and_previous_quote(spark, ticks, tmp_path):
    jobs.use_rocksdb(spark)
    land(spark, ticks, tmp_path / "in", 3)
    got = run(spark, proc.stream_ema(stream_of(spark, tmp_path / "in")), tmp_path / "a"
              ).toPandas().sort_values("id", ignore_index=True)
    g = ticks.groupby("symbol")["price"]
    line = (g.transform(lambda x: x.ewm(span=12, adjust=False).mean())
            - g.transform(lambda x: x.ewm(span=26, adjust=False).mean()))
    np.testing.assert_allclose(got["macd_line"], line, atol=1e-9)
    before = run(spark, proc.stream_previous_quote(stream_of(spark, tmp_path / "in")),
                 tmp_path / "b").toPandas().sort_values("id", ignore_index=True)
    batch = lookups.previous_quote(
        spark.createDataFrame(ticks, SCHEMA), Series(unit="HOUR"), "price").toPandas(
        ).sort_values("id", ignore_index=True)
    np.testing.assert_allclose(before["previous_price"].astype(float),
                               batch["previous_price"].astype(float))


def test_rows_by_arrival_reach_python_without_a_timestamp(spark, ticks, tmp_path):
    class Seen(proc.RowProcessor):
        COLUMNS = "seen string"

        def open(self, handle):
            pass

        def apply(self, new):
            return pd.DataFrame({"seen": [",".join(new.columns)] * len(new)})

    jobs.use_rocksdb(spark)
    land(spark, ticks, tmp_path / "in", 2)
    rows = stream_of(spark, tmp_path / "in")
    out = run(spark, proc._stateful(rows, Seen()), tmp_path)
    assert {r["seen"] for r in out.select("seen").distinct().collect()} == {"symbol,id,price,volume,at"}
    assert dict(out.dtypes)["ts"] == "timestamp" and out.columns[:3] == ["symbol", "id", "ts"]
    assert out.select("id", "ts").exceptAll(spark.read.parquet(str(tmp_path / "in")).select(
        "id", F.col("ts").cast("timestamp"))).isEmpty() and out.count() == len(ticks)


@pytest.mark.parametrize("kind", [proc.PreviousQuoteProcessor, proc.EmaProcessor, proc.RollingProcessor])
def test_time_is_a_number_by_arrival(kind):
    assert " at bigint," in kind().output and " ts timestamp," in kind(piece_ms=MINUTE_MS).output


def arriving(ticks, seed=2):
    """Ticks in order of arrival: up to nine minutes late, so most triggers hold older rows."""
    rng = np.random.default_rng(seed)
    late = ticks["ts"] + pd.to_timedelta(rng.integers(0, 540, len(ticks)), unit="s")
    return ticks.iloc[np.argsort(late.to_numpy(), kind="stable")]


def events_table(spark, rows, path):
    """Events of (id, time, type, value) as a table that the queries read."""
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, event_type string, value double") \
        .withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "props": F.lit('{"k": 3}')}) \
        .write.parquet(f"{path}/events.parquet")
    return str(path)


def test_changes_against_a_price_of_zero_lead_the_movers(spark, tmp_path):
    import __spark_entry__ as entry_point
    rows = [(i, T0 + dt.timedelta(seconds=i), "view", p) for i, p in enumerate([5.0, 0.0, 0.0, 7.0, 8.0])]
    got = entry_point.queries()["top_movers"](spark, events_table(spark, rows, tmp_path)).collect()
    assert [str(r["change_percent"]) for r in got] == ["nan", "inf", "-100.0", "14.2857", "None"]
    assert [r["trend"] for r in got] == ["up", "up", "down", "up", "neutral"]


def test_first_alerts_of_a_group(spark):
    at = [T0 + dt.timedelta(seconds=s) for s in (0, 0, 10, 20, 70, 80)]
    rows = [("A", t, T0, i, s, "m") for t, i, s in zip(
        at, "badcef", ["info", "info", "critical", "info", "info", "critical"])]
    alerts = spark.createDataFrame(rows, "symbol string, ts timestamp, closed timestamp, "
                                         "alert_id string, severity string, formatted_message string")
    got = events.first_alerts(alerts, 3_600_000).collect()
    assert sorted(r["alert_id"] for r in got) == ["a", "d", "e"]


def test_events_of_one_symbol_and_time_are_not_repeats(spark, tmp_path):
    from checks import q_streams, registry  # noqa: F401 (registers its queries)
    rows = [(i, T0 + dt.timedelta(seconds=i // 2), "view", float(i)) for i in range(1, 40)]
    got = registry.QUERIES["stream_dedup"](spark, events_table(spark, rows, tmp_path))
    assert sorted(r["id"] for r in got.collect()) == list(range(1, 40))


class Entries(dict):
    """Map state that counts the bytes written."""

    written = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self.written += sum(len(v) for v in value if isinstance(v, bytes))
        self[key] = value

    def removeKey(self, key):
        del self[key]


def test_a_waiting_piece_is_written_once(ticks):
    class Handle:
        def getMapState(self, *_):
            return Entries()

        def getValueState(self, *_):
            return None

        getListState = getValueState

        def registerTimer(self, at):
            pass

    waiting = proc.RollingProcessor(10 ** 9)
    waiting.init(Handle())
    rows = ticks.assign(at=ticks["ts"].astype("datetime64[us]").astype("int64"))
    for chunk in np.array_split(np.arange(len(rows)), 30):
        list(waiting.handleInputRows(("A",), iter([rows.iloc[chunk]]), None))
    assert waiting.waiting.written == sum(len(v) for (v,) in waiting.waiting.values())


@pytest.mark.parametrize("run_rows, frames", [(50_000, 1), (30, 8)])
def test_short_pieces_are_applied_together(ticks, monkeypatch, run_rows, frames):
    class Pairs(Entries):
        def iterator(self):
            return iter([(k, v) for k, v in self.items()])

    class Last:
        row = None

        def exists(self):
            return self.row is not None

        def get(self):
            return self.row

        def update(self, row):
            self.row = row

    class Handle:
        timers = set()

        def getMapState(self, *_):
            return Pairs()

        def getValueState(self, *_):
            return Last()

        def registerTimer(self, at):
            self.timers.add(at)

    class Mark:
        def __init__(self, at):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at

    monkeypatch.setattr(proc, "RUN_ROWS", run_rows, raising=False)
    handle, minute = Handle(), 60_000
    waiting = proc.PreviousQuoteProcessor(piece_ms=minute)
    waiting.init(handle)
    rows = ticks.assign(at=ticks["ts"].astype("datetime64[us]").astype("int64"))
    rows["volume"] = rows["volume"].astype("float64").where(rows["id"] > 150)  # parts with and without nulls
    whole = rows.iloc[200:].astype({"volume": "int64"})
    list(waiting.handleInputRows(("A",), iter([whole, rows.iloc[:200]]), None))
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert handle.timers == {start + minute}  # 100 pieces wait
    out = list(waiting.handleExpiredTimer(("A",), Mark(start + 80 * minute), Mark(start + minute)))
    assert len(out) == frames and handle.timers == {start + minute, start + 81 * minute}
    got = pd.concat(out, ignore_index=True)
    assert got["id"].tolist() == list(range(240)) and sorted(waiting.parts) == sorted(
        {(at // (minute * 1000),) for at in rows["at"][240:]})
    assert got["previous_price"][1:].tolist() == ticks["price"][:239].tolist()
    assert (got["closed"] == (rows["ts"][:240] + pd.Timedelta("1min")).dt.floor("min")).all()


def test_windows_keep_no_rounding_of_values_that_left():
    class Past(list):
        get, put = list.copy, list.extend

    rng = np.random.default_rng(3)
    values = np.concatenate([rng.uniform(1e5, 4e5, 4000), [0.013], np.full(60, 0.02), [np.nan, 0.02, 7.0]])
    rolling = proc.RollingProcessor()
    rolling.past = Past()
    got = rolling.apply(pd.DataFrame({"price": values, "volume": values}))
    z = got["price_zscore"].to_numpy()
    assert abs(z[4050] - 51 ** -0.5) < 1e-7  # one of 51 differs
    assert np.isnan(z[[0, 4051, 4061, 4062]]).all()  # one value, flat, null, flat
    assert abs(z[4063] - 49 / 50 ** 0.5) < 1e-7
    assert abs(got["volatility"][4063] - 6.98 / 19 ** 0.5) < 1e-7 and got["sma_20"][0] == values[0]
    np.testing.assert_allclose(got["volatility"][1:4000], pd.Series(values[:4000]).rolling(20, 1).std()[1:])
    assert len(rolling.past) == 50


MINUTE_MS = 60_000


def closed_rows(ticks, piece_ms):
    """Rows of pieces that the watermark, ten minutes behind the newest row, has passed."""
    end = (ticks["ts"].astype("datetime64[ms]").astype("int64") // piece_ms + 1) * piece_ms
    mark = int(ticks["ts"].max().timestamp() * 1000) - 10 * MINUTE_MS
    return end <= mark


@pytest.mark.parametrize("piece_ms", [MINUTE_MS, 7 * MINUTE_MS])
def test_late_rows_give_the_tables_result(spark, ticks, tmp_path, piece_ms):
    jobs.use_rocksdb(spark)
    land(spark, arriving(ticks), tmp_path / "in", 7)
    rows = agg.with_watermark(stream_of(spark, tmp_path / "in"), "10 minutes")
    got = run(spark, proc.stream_rolling(rows, piece_ms=piece_ms), tmp_path / "a").toPandas()
    got = got.sort_values("id", ignore_index=True)
    want = ticks[closed_rows(ticks, piece_ms)].reset_index(drop=True)
    assert got["id"].tolist() == want["id"].tolist() and len(want) > 200
    g = ticks.groupby("symbol")["price"]
    sma = g.transform(lambda x: x.rolling(20, min_periods=1).mean())
    np.testing.assert_allclose(got["sma_20"], sma[:len(got)], rtol=1e-9)
    ema = run(spark, proc.stream_ema(rows, piece_ms), tmp_path / "b").toPandas()
    line = (g.transform(lambda x: x.ewm(span=12, adjust=False).mean())
            - g.transform(lambda x: x.ewm(span=26, adjust=False).mean()))
    np.testing.assert_allclose(ema.sort_values("id")["macd_line"], line[:len(got)], atol=1e-9)


@pytest.mark.parametrize("piece_ms", [None, MINUTE_MS])
def test_quotes_are_forgotten_after_a_gap(spark, tmp_path, piece_ms):
    jobs.use_rocksdb(spark)
    seconds = [0, 30, 100, 2000, 2010, 2130, 9000, 20000]
    pdf = pd.DataFrame({"symbol": "A", "id": range(len(seconds)),
                        "ts": [T0 + dt.timedelta(seconds=s) for s in seconds],
                        "price": np.arange(1.0, 9.0), "volume": 5})
    land(spark, pdf, tmp_path / "in", 4)
    rows = agg.with_watermark(stream_of(spark, tmp_path / "in"), "1 minute")
    out = run(spark, proc.stream_previous_quote(rows, 120_000, piece_ms), tmp_path).toPandas()
    got = out.sort_values("id")["previous_price"].tolist()
    want = [None, 1.0, 2.0, None, 4.0, 5.0, None, None]
    got = [None if np.isnan(x) else x for x in got]
    assert got == (want if piece_ms is None else want[:7])


def test_event_path_over_a_restart(spark, tmp_path):
    """Late quotes, several triggers, a stop in between: as from tables, one row per channel."""
    rng = np.random.default_rng(4)
    n = 400
    pdf = pd.DataFrame({"symbol": rng.choice(["HOT", "HOT", "B", "C"], n), "id": range(n),
                        "ts": [T0 + dt.timedelta(seconds=30 * i) for i in range(n)],
                        "price": 100 * np.exp(rng.normal(0, 0.09, n)),
                        "volume": rng.choice([1, 2, 7, 30], n)})
    severities, hours = ["info", "warning", "critical"], [(None, None), ("01:00", "02:30")]
    lists = [[], ["HOT"], ["B", "HOT"], None]
    users = spark.createDataFrame(
        [(i, [["email"], ["email", "sms"], []][i % 3], severities[i % 3], lists[i % 4], *hours[i % 2])
         for i in range(24)], "user_id int, channels array<string>, severity_threshold string, "
                              "symbols array<string>, start_at string, end_at string")
    jobs.use_rocksdb(spark)
    order = arriving(pdf, 8)
    for part in (order.iloc[:170], order.iloc[170:]):
        land(spark, part, tmp_path / "in", 3)
        out = events.notifications(stream_of(spark, tmp_path / "in"), users, keep_ms=600_000,
                                   piece_ms=5 * MINUTE_MS)
        jobs.to_files(out, f"{tmp_path}/out", f"{tmp_path}/state", every=None).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").toPandas()
    table = spark.createDataFrame(pdf[closed_rows(pdf, 5 * MINUTE_MS)], SCHEMA)
    before = lookups.previous_quote(table, Series(unit="HOUR", ties=("id",)), "price")
    gap = F.lag("ts").over(Window.partitionBy("symbol").orderBy("ts", "id"))
    recent = F.col("ts") - gap <= F.expr("INTERVAL 10 MINUTES")
    known = before.withColumns({c: F.when(recent, F.col(c)) for c in ("previous_price", "previous_volume")})
    found = events.alerts_of(known)
    limited = alerts.limited_notifications(found, users).join(
        found.select("alert_id", "severity", "formatted_message"), "alert_id")
    want = alerts.notification_plan(limited).toPandas()
    key = ["user_id", "channel", "alert_id", "symbol", "severity", "text"]
    assert len(want) > 100 and set(want["severity"]) == set(severities)
    assert sorted(map(tuple, got[key].values)) == sorted(map(tuple, want[key].values))


def test_windows_late_rows_and_open_end(spark, ticks, tmp_path):
    late = ticks.iloc[[0]].assign(id=999)  # older than the watermark when it arrives
    land(spark, ticks, tmp_path / "in", 2)
    land(spark, late, tmp_path / "in", 1)

    def shaped(df):
        return df.withColumns({"market": F.lit("m"), "price_change_pct": F.lit(0.5), "volatility": F.lit(1.0),
                               "is_anomaly": F.lit(False)})

    out = agg.market_windows(agg.with_watermark(shaped(stream_of(spark, tmp_path / "in")),
                                                "5 minutes"))
    got = run(spark, out, tmp_path).toPandas()
    table = shaped(spark.createDataFrame(ticks, SCHEMA))
    want = agg.closed_windows(agg.market_windows(table), table, "5 MINUTES").toPandas()
    key = ["window_start", "market"]
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True),
                                  want.sort_values(key, ignore_index=True))
    assert len(want) < agg.market_windows(table).count()


def test_dedup_and_each_file_once(spark, ticks, tmp_path):
    land(spark, pd.concat([ticks, ticks.iloc[::7]]), tmp_path / "in", 3)
    got = run(spark, agg.stream_dedup(stream_of(spark, tmp_path / "in"), "3 hours"), tmp_path)
    assert got.count() == len(ticks)
    again = run(spark, agg.stream_dedup(stream_of(spark, tmp_path / "in"), "3 hours"), tmp_path)
    assert again.count() == len(ticks)


def test_fan_out_and_failures_surface(spark, ticks, tmp_path):
    land(spark, ticks, tmp_path / "in", 2)
    base = str(tmp_path)
    jobs.fan_out(stream_of(spark, tmp_path / "in"), {
        f"{base}/all": lambda b: b, f"{base}/hot": lambda b: b.filter("symbol = 'HOT'")},
        f"{base}/s").awaitTermination()
    assert spark.read.parquet(f"{base}/all").count() == len(ticks)
    assert spark.read.parquet(f"{base}/hot").count() == (ticks["symbol"] == "HOT").sum()
    bad = stream_of(spark, tmp_path / "in").withColumn("x", F.raise_error(F.lit("boom")))
    good = jobs.to_files(stream_of(spark, tmp_path / "in"), f"{base}/g", f"{base}/gs", None)
    with pytest.raises(Exception, match="boom"):
        jobs.run_all([good, jobs.to_files(bad, f"{base}/b", f"{base}/bs", None)])
    jobs.to_console(stream_of(spark, tmp_path / "in").limit(1), f"{base}/c", None).awaitTermination()


def test_rejected_text_is_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "price_data.json").write_text('{"symbol": "A", "close": 1.5}\nnot json\n')
    base = str(tmp_path)
    for _ in range(2):  # the second run finds nothing new
        jobs.load_incrementally(spark, f"{base}/in", f"{base}/out", f"{base}/s").awaitTermination()
    assert [r.close for r in spark.read.parquet(f"{base}/out/loaded").collect()] == [1.5]
    assert [r._corrupt_record for r in spark.read.parquet(f"{base}/out/rejected").collect()] == [
        "not json"]


def serving_rows(spark, rows):
    return spark.createDataFrame(
        [(s, T0 + dt.timedelta(hours=h), p, 1, "quote", T0 + dt.timedelta(hours=h, minutes=at))
         for s, h, p, at in rows],
        "symbol string, timestamp timestamp_ntz, price double, volume bigint, data_type string, "
        "processed_at timestamp_ntz")


def test_serving_manifests(spark, tmp_path):
    """Two batches on one day, a repeated batch, a reader between them, and a removal."""
    table, day = str(tmp_path / "t"), T0 + dt.timedelta(hours=30)
    batches = [[("A", 1, 1.0, 0), ("B", 1, 2.0, 0), ("A", 26, 3.0, 0)], [("A", 1, 1.5, 9), ("C", 2, 4.0, 0)],
               [("A", 26, 3.5, 5)]]
    for i, rows in enumerate(batches):
        serving_rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        serving.serve(stream_of(spark, tmp_path / "in"), table, f"{tmp_path}/s").awaitTermination()
        if i == 0:
            pinned = serving.served(spark, table, F.lit(day))
            first = serving.manifest(spark, table)
    got = {(r.symbol, r.timestamp.hour, r.timestamp.day): float(r.price)
           for r in serving.served(spark, table, F.lit(day)).collect()}
    assert got == {("A", 1, 1): 1.5, ("B", 1, 1): 2.0, ("C", 2, 1): 4.0, ("A", 2, 2): 3.5}
    assert sorted(float(r.price) for r in pinned.collect()) == [1.0, 2.0, 3.0]  # as it was read
    assert first == {"2024-01-01": 0, "2024-01-02": 0}
    assert serving.manifest(spark, table) == {"2024-01-01": 1, "2024-01-02": 2}

    # The last batch again, as after a stop before its commit: the same table.
    state = tmp_path / "s"
    for kind in ("commits", "offsets"):
        last = max((f for f in (state / kind).iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
        if kind == "commits":
            last.unlink()
            (state / kind / f".{last.name}.crc").unlink(missing_ok=True)
    serving.serve(stream_of(spark, tmp_path / "in"), table, str(state)).awaitTermination()
    again = {(r.symbol, r.timestamp.hour, r.timestamp.day): float(r.price)
             for r in serving.served(spark, table, F.lit(day)).collect()}
    assert again == got and serving.manifest(spark, table) == {"2024-01-01": 1, "2024-01-02": 2}

    assert serving.remove_versions(spark, table, 3600) == []  # readers may still need them
    import time
    gone = serving.remove_versions(spark, table, 60, now=time.time() + 3600)
    assert sorted(g for g in gone if g.startswith("day")) == ["day=2024-01-01/v=0", "day=2024-01-02/v=0"]
    assert len([g for g in gone if g.startswith("_manifests")]) == 2
    assert serving.served(spark, table, F.lit(day)).count() == 4
    with pytest.raises(ValueError):
        serving.served(spark, str(tmp_path / "none"), F.lit(day))


def test_serving_table_keeps_newest_and_expires(spark, tmp_path):
    day = dt.timedelta(days=1)
    rows = [  # symbol, timestamp, price, written at
        [("A", T0, 1.0, T0), ("B", T0, 2.0, T0)],
        [("A", T0, 3.0, T0 + day), ("A", T0 + 3 * day, 4.0, T0 + 3 * day)],
        [("A", T0 + 8 * day, 5.0, T0 + 8 * day)]]
    for part in rows:
        spark.createDataFrame(
            part, "symbol string, timestamp timestamp_ntz, price double, processed_at timestamp"
        ).withColumns({"volume": F.lit(1), "data_type": F.lit("q")}).coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/in")
    serving.serve(stream_of(spark, tmp_path / "in"), f"{tmp_path}/t", f"{tmp_path}/s"
               ).awaitTermination()

    def at(time):
        out = serving.served(spark, f"{tmp_path}/t", F.lit(time)).collect()
        return sorted((r.symbol, float(r.price)) for r in out)

    assert at(T0 + 6 * day) == [("A", 3.0), ("A", 4.0), ("A", 5.0), ("B", 2.0)]
    assert at(T0 + 7.5 * day) == [("A", 3.0), ("A", 4.0), ("A", 5.0)]
    assert spark.read.parquet(f"{tmp_path}/t").select("day", "v").distinct().count() == 4


def test_threshold_alarm_needs_adjacent_periods(spark):
    rows = [("s", T0 + dt.timedelta(minutes=5 * m), v)
            for m, v in ((0, 9.0), (1, 9.0), (2, 1.0), (3, 9.0), (5, 9.0))]
    df = spark.createDataFrame(rows, "stream string, ts timestamp_ntz, value double")
    out = {r.period.minute: r.in_alarm for r in agg.threshold_alarm(df, 5.0).collect()}
    assert out == {0: False, 5: True, 10: False, 15: False, 25: False}


def test_event_stream_lands_events_without_time(spark, tmp_path):
    from checks import q_streams
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    some = events.limit(50)
    for name, rows in (("mixed", some.union(events.limit(7).withColumn(
            "ts", F.lit(None).cast(events.schema["ts"].dataType)))),
                       ("none", some.withColumn("ts", F.lit(None).cast(events.schema["ts"].dataType)))):
        rows.write.parquet(f"{tmp_path}/{name}/events.parquet")
        got = q_streams.drain(spark, q_streams.event_stream(spark, f"{tmp_path}/{name}"))
        assert got.count() == rows.count()
        assert got.where("ts is null").count() == rows.where("ts is null").count()
