import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import alerts, features, forecast, lookups, quality
from tickloom.operators.quantiles import BINS_1, exact_quantiles, leading_bits
from tickloom.sinks import tables as sink
from tickloom.sources import bars as src, payloads

T0 = dt.datetime(2024, 1, 1, 12)


def test_quantiles_of_a_large_skewed_group(spark):
    # Beyond the size at which groups are counted whole, with heavy ties and a long tail.
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": "hot", "v": np.concatenate([
        rng.lognormal(0, 3, 60_000), np.full(30_000, 1.5), rng.normal(0, 1, 10_000)])})
    small = pd.DataFrame({"k": "small", "v": rng.normal(0, 1, 7)})
    both = pd.concat([pdf, small])
    probs = [0.0, 0.25, 0.5, 0.95, 0.999, 1.0]
    out = exact_quantiles(spark.createDataFrame(both).repartition(8), ["k"], "v", probs)
    for row in out.collect():
        want = np.quantile(both[both["k"] == row.k]["v"], probs)
        np.testing.assert_allclose(row.quantiles, want, rtol=1e-12)


def test_quantiles_by_radix(spark):
    """Every rank of groups over all magnitudes, with ties, zeros of both signs and infinities."""
    rng = np.random.default_rng(6)
    wide = rng.choice([-1.0, 1.0], 3000) * 10.0 ** rng.uniform(-300, 300, 3000)
    groups = {"wide": wide, "ties": rng.integers(-3, 4, 500).astype(float), "one": np.array([7.5]),
              "narrow": 100 + rng.integers(0, 50, 4000) * 1e-13, "flat": np.full(300, -2.5),
              "ends": np.concatenate([wide[:50], [np.inf, -np.inf, 5e-324, -5e-324, 0.0]])}
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("none", None), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = [0.0, 0.001, 0.3333, 0.5, 0.75, 0.9999, 1.0]
    found = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    assert set(found) == set(groups)
    for k, values in groups.items():
        assert found[k].rows == len(values)
        ordered = np.sort(values)
        for p, got in zip(probs, found[k].quantiles):
            rank = (len(values) - 1) * p
            low, high = ordered[int(np.floor(rank))], ordered[int(np.ceil(rank))]
            if low == high or rank == int(rank):
                assert got == low
            elif np.isfinite(low) and np.isfinite(high):
                assert got == pytest.approx(low + (high - low) * (rank - np.floor(rank)), rel=1e-9)
    bins = spark.createDataFrame([(float(v),) for v in np.sort(np.concatenate([wide, [0.0, np.inf, -np.inf]]))],
                                 "v double").select("v", leading_bits(F.col("v")).alias("b")).orderBy("v")
    order = [r.b for r in bins.collect()]
    assert order == sorted(order) and max(map(abs, order)) * 2 + 1 <= BINS_1


RAW = [  # symbol, timestamp, open, high, low, close, volume
    ("A", "2024-01-01 10:00:00", 1.0, 2.0, 0.5, 1.5, 10),
    ("A", "2024-01-01T10:00:00Z", 1.0, 2.0, 0.5, 1.2, 10),      # same time, other format
    ("A", "not a time", 1.0, 2.0, 0.5, 1.5, 10),
    (None, "2024-01-01 10:00:00", 1.0, 2.0, 0.5, 1.5, 10),
    ("A", "2024-01-01 11:00:00", 1.0, 0.4, 0.5, 0.45, 10),      # high under low
    ("A", "2024-01-01 12:00:00", 1.0, 2.0, 0.5, 1.5, -1),
    ("A", "2024-01-01 13:00:00", 1.0, 2.0, 0.5, 0.0, 10),
]


def test_clean_and_validate(spark):
    raw = spark.createDataFrame([(*r, "s", "m") for r in RAW],
                                "symbol string, timestamp string, open double, high double, low "
                                "double, close double, volume bigint, source string, market string")
    rows = quality.clean_and_validate(raw).collect()
    assert [(r.symbol, r.close) for r in rows] == [("A", 1.2)]


def test_each_fault_has_its_reason(spark):
    ok = dict(symbol="ab", timestamp="2024-01-01 10:00:00", open="1", high="2", low="0.5",
              close="1.5", volume="3", source=None)
    faults = {"symbol": {"symbol": "toolong"}, "timestamp": {"timestamp": "2024-01-05 10:00:00"},
              "open_range,open_between": {"open": "text"},
              "volume": {"volume": "-1"}, "close_between": {"close": "3"}, "": {}}
    rows = [{**ok, **f, "timestamp": f.get("timestamp", f"2024-01-01 10:00:0{i}")}
            for i, f in enumerate(faults.values())]
    rows.append({**rows[-1]})  # a repeat
    names = list(ok)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows],
                               ", ".join(f"{n} string" for n in names))
    checked = quality.check_price_records(df, F.lit(T0))
    got = {",".join(r.reasons) for r in checked.collect()}
    assert got == set(faults)
    stats = quality.validation_stats(checked).first()
    assert stats.total_records == 7 and stats.duplicate_records == 1
    assert stats.valid_records == 1 and stats.invalid_records == 5
    valid = quality.valid_records(checked).first()
    assert (valid.symbol, valid.source) == ("AB", "unknown")


def test_payload_gaps(spark):
    body = '{"prices": [[0, 5.0], [1000, 6.0]], "total_volumes": [[0, 7.9]]}'
    df = spark.createDataFrame([("X", body), ("Y", "broken"), ("Z", '{"prices": []}')],
                               "symbol string, payload string")
    rows = payloads.parse_price_series(df).orderBy("ts").collect()
    assert [(r.close, r.volume) for r in rows] == [(5.0, 7), (6.0, 0)]
    quote = spark.createDataFrame([("Q", '{"Global Quote": {"05. price": "9.5"}}'), ("R", "{}")],
                                  "symbol string, payload string")
    rows = payloads.parse_quote_payload(quote).orderBy("symbol").collect()
    assert [(r.symbol, r.price, r.volume) for r in rows] == [("Q", 9.5, 0), ("R", 0.0, 0)]
    daily = spark.createDataFrame([("D", '{"Time Series (Daily)": {"2024-01-01": {"1. open": "2"}}}')],
                                  "symbol string, payload string")
    row = payloads.parse_daily_payload(daily).first()
    assert (row.open, row.close, row.split_coefficient, row.timezone) == (2.0, 0.0, 1.0, "US/Eastern")
    short = spark.createDataFrame([("K", '[[0, "1", "2"]]')], "symbol string, payload string")
    assert payloads.parse_klines(short).first().close is None


def alert_rows(spark, rows):
    return spark.createDataFrame(
        rows, "alert_id string, alert_type string, symbol string, ts timestamp_ntz, price double, "
              "volume bigint, price_change_percent double, volume_ratio double, "
              "anomalies_detected array<string>")


def test_alert_limits_are_inclusive(spark):
    fin = "financial_anomaly"
    rows = [("1", fin, "A", T0, 1.0, 1, 10.0, 1.0, []), ("2", fin, "A", T0, 1.0, 1, -15.0, 1.0, []),
            ("3", fin, "A", T0, 1.0, 1, 0.0, 10.0, ["volume_spike_10.0x"]),
            ("4", fin, "A", T0, 1.0, 1, 9.9, 9.9, ["volume_spike_9.9x", "extreme_price_change_9%"]),
            ("5", "system_event", "A", T0, 1.0, 1, 99.0, 99.0, [])]
    out = {r.alert_id: r for r in alerts.classify_alert(alert_rows(spark, rows)).collect()}
    assert [out[i].severity for i in "12345"] == ["warning", "critical", "critical", "info",
                                                  "warning"]
    assert out["4"].category == "extreme_movement" and out["4"].requires_immediate_action
    assert out["3"].urgency == "high" and not out["3"].requires_immediate_action
    assert out["5"].category == "system"


def test_audience_equals_the_nested_loop(spark, monkeypatch):
    rng = np.random.default_rng(5)
    severities = ["info", "warning", "critical"]
    a = [(str(i), rng.choice(["HOT", "HOT", "B", "C"]), T0 + dt.timedelta(minutes=int(h) * 30),
          rng.choice(severities)) for i, h in enumerate(rng.integers(0, 48, 200))]
    a += [("n1", None, T0, "info"), ("n2", "HOT", T0, "info"), ("n3", "HOT", T0, "info")]
    hours = [(None, None), ("09:00", "17:00"), ("06:00", "20:00")]
    channels = [["email"], ["email", "sms"], [], None]
    lists = [[], ["HOT"], ["B", "C", "B"], None, [None, "B"], [None]]
    u = [(i, channels[i % 4], rng.choice(severities), lists[i % 6], *hours[i % 3])
         for i in range(60)]
    rank = {s: i for i, s in enumerate(severities)}
    want = [(x, y) for x in a for y in u
            if rank[x[3]] >= rank[y[2]] and (not y[3] or (x[1] is not None and x[1] in y[3]))
            and (x[3] == "critical"
                 or (y[4] or "00:00") <= x[2].strftime("%H:%M") <= (y[5] or "23:59"))]
    alert_rows_ = spark.createDataFrame(
        a, "alert_id string, symbol string, ts timestamp_ntz, severity string")
    users = spark.createDataFrame(u, "user_id int, channels array<string>, severity_threshold string, "
                                  "symbols array<string>, start_at string, end_at string")
    got = alerts.match_alert_users(alert_rows_, users)
    pairs = [(r.alert_id, r.user_id) for r in got.select("alert_id", "user_id").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(x[0], y[0]) for x, y in want}

    per_user = {}
    for x, y in want:
        n, symbols, times = per_user.setdefault((y[0], x[3]), [0, set(), []])
        per_user[y[0], x[3]][0] += 1
        symbols.add(x[1])
        times.append(x[2])
    counted = {(r.user_id, r.severity): (r.alerts, r.symbols, r.first_ts, r.last_ts)
               for r in alerts.user_alert_counts(alert_rows_, users).collect()}
    assert counted == {k: (n, len(s - {None}), min(t), max(t)) for k, (n, s, t) in per_user.items()}

    first = {}
    for x, y in want:
        key = (y[0], x[1], x[2].replace(minute=0))
        first[key] = min(first.get(key, (x[2], x[0])), (x[2], x[0]))
    monkeypatch.setattr(alerts, "ANY_ROWS", 3)
    out = [(r.user_id, r.symbol, r.ts, r.alert_id, r.channels) for r in
           alerts.limited_notifications(alert_rows_, users, "1 hour").collect()]
    assert len(out) == len(first)
    assert {o[:4] for o in out} == {(k[0], k[1], *v) for k, v in first.items()}
    matched = got.select("user_id", "symbol", "ts", "alert_id", "severity").where("symbol IS NOT NULL")
    rows = [(r.user_id, r.symbol, r.ts, r.alert_id) for r in alerts.rate_limit_alerts(matched).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(k[0], k[1], *v) for k, v in first.items() if k[1] is not None}

    totals, sent = {}, {x[0]: 0 for x in a}
    for x, y in want:
        sent[x[0]] += len(y[1] or [])
        for c in y[1] or []:
            totals[c, x[3]] = totals.get((c, x[3]), 0) + 1
    assert totals == {(r.channel, r.severity): r.notifications
                      for r in alerts.channel_totals(alert_rows_, users).collect()}
    assert sent == {r.alert_id: r.sent for r in alerts.with_sent(alert_rows_, users).collect()}
    for empty in ((alert_rows_.limit(0), users), (alert_rows_, users.limit(0))):
        assert not alerts.match_alert_users(*empty).count()
        assert not alerts.limited_notifications(*empty).count()
        assert not alerts.channel_totals(*empty).count()


def test_rate_limit(spark):
    """A dense run: alerts every 30 minutes for ten hours give one notification an hour."""
    rows = spark.sql("""SELECT 1L AS user_id, 'A' AS symbol, TIMESTAMP_NTZ'2024-01-01 00:00:00'
        + make_dt_interval(0, 0, 30 * CAST(id AS INT)) AS ts, CAST(id AS STRING) AS alert_id
        FROM range(20)""")
    out = alerts.rate_limit_alerts(rows, "1 hour").orderBy("ts").collect()
    assert [r["alert_id"] for r in out] == [str(i) for i in range(0, 20, 2)]


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([("A", T0, 1), ("A", T0, 2), ("A", T0 - dt.timedelta(1), 3)],
                               "symbol string, ts timestamp_ntz, v int")
    assert sorted(r.v for r in lookups.latest_per_symbol(df).collect()) == [1, 2]


def test_ridge_and_linear_equal_closed_form(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, [1, 5, 0.2], (400, 3)) + [3, -1, 0]
    y = x @ [1.0, -0.3, 4.0] + rng.normal(0, 2, 400) + 5
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y,
                                             "i": range(400)}))
    scaled = (x - x.mean(0)) / x.std(0)
    for alpha in (0.0, 1.0, 50.0):
        model = (forecast.fit_ridge(df, "y", alpha, ("a", "b", "c")) if alpha
                 else forecast.fit_linear(df, "y", ("a", "b", "c")))
        name = "ridge" if alpha else "linear"
        got = forecast.apply_model(model, df).orderBy("i").toPandas()[name]
        w = np.linalg.solve(scaled.T @ scaled + alpha * np.eye(3), scaled.T @ (y - y.mean()))
        np.testing.assert_allclose(got, scaled @ w + y.mean(), rtol=1e-7)


def test_split_and_folds_are_in_time_order(spark):
    df = spark.createDataFrame([("A" if i % 3 else "B", T0 + dt.timedelta(days=i)) for i in range(31)],
                               "symbol string, ts timestamp_ntz")
    split = features.chronological_split(df, 0.7).toPandas()
    for _, g in split.groupby("symbol"):
        g = g.sort_values("ts")
        assert g["is_train"].sum() == int(len(g) * 0.7)
        assert g["is_train"].is_monotonic_decreasing
    folds = forecast.assign_folds(df).orderBy("ts").toPandas()["fold"]
    assert folds.is_monotonic_increasing
    assert folds.value_counts().sort_index().tolist() == [6, 5, 5, 5, 5, 5]


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"symbol": "A", "timestamp": "2024-01-01 00:00:00", '
                                     '"close": 1.5}, {"symbol": "B", "close": "bad"}]')
    (tmp_path / "b.json").write_text("{broken")
    rows = src.read_raw_bars(spark, str(tmp_path)).collect()
    assert sum(r._corrupt_record is not None for r in rows) >= 1
    assert any(r.symbol == "A" and r.close == 1.5 for r in rows)
    assert src.read_raw_bars(spark, str(tmp_path / "none")).count() == 0
    quotes = spark.createDataFrame(
        [("A", T0, 1.0, 1, "q", T0), ("A", T0, 2.0, 2, "q", T0 + dt.timedelta(hours=1)),
         ("B", T0, 3.0, 3, "q", T0 - dt.timedelta(days=9))],
        "symbol string, timestamp timestamp_ntz, price double, volume bigint, data_type string, "
        "processed_at timestamp_ntz")
    first = sink.merge_serving(None, quotes, F.lit(T0))
    assert [(r.symbol, float(r.price)) for r in first.collect()] == [("A", 2.0)]


def test_changes(spark):
    t = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 2), (3, 3.0, 3)],
                              "id int, price double, volume int")
    c = spark.createDataFrame([(1, "update", 9.0, None), (2, "delete", None, None),
                               (3, "update", -1.0, 8), (4, "insert", 4.0, 4),
                               (5, "update", 5.0, 5), (6, "insert", -6.0, 6)],
                              "id int, op string, price double, volume int")
    rows = lookups.apply_changes(t, c, ["price", "volume"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 9.0, 1), (3, 3.0, 3), (4, 4.0, 4)]
    assert rows and not any(r.id in (2, 5, 6) for r in rows)


def test_no_full_sort_or_cross_join_in_the_flagship(spark):
    from checks.fixtures import raw_bars
    from tickloom.plans.batch import market_report
    report = market_report(raw_bars(spark, "/root/testdata/sf0.001"))
    plan = report._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", ["market_summary", "latency_quantiles", "ema"])
def test_registered_query_matches_oracle(spark, name):
    import duckdb

    import __spark_entry__ as entry_point
    from checks.run import TABLES, compare
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = entry_point.queries()[name](spark, sf).toPandas()
    assert compare(got, con.execute(entry_point.oracle_sql()[name]).fetchdf()).startswith("ok")
