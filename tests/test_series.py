"""Blocked windows must equal windows over the whole series, whatever the block size."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import anomalies, ema, features, indicators as ind, isolation
from tickloom.operators.series import Series

DAY0 = dt.datetime(2020, 1, 1)


def make_bars(spark, sizes: dict[str, int], seed: int = 1):
    rng = np.random.default_rng(seed)
    rows = []
    for symbol, n in sizes.items():
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        gaps = np.cumsum(rng.integers(1, 40, n))
        for i in range(n):
            c = float(close[i])
            rows.append((symbol, DAY0 + dt.timedelta(days=int(gaps[i])), c * 0.99, c * 1.02,
                         c * 0.97, c, int(rng.integers(0, 5000)), "s", "m"))
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double,"
                                 "low double, close double, volume bigint, source string,"
                                 "market string")


@pytest.fixture(scope="module")
def bars(spark):
    # One symbol holds most rows, as a hot key would.
    return make_bars(spark, {"HOT": 700, "B": 60, "C": 1}).persist()


def frame(df, *cols):
    return df.select("symbol", "ts", *cols).toPandas().sort_values(["symbol", "ts"],
                                                                   ignore_index=True)


@pytest.mark.parametrize("unit", ["MONTH", "YEAR"])
@pytest.mark.parametrize("block", [7, 64])
def test_rolling_is_independent_of_blocks(bars, unit, block):
    whole = Series(unit="YEAR", block_rows=1_000_000)
    cut = Series(unit=unit, block_rows=block)
    cols = ["sma_20", "sma_50", "volatility_20", "rsi", "price_change_pct", "price_zscore"]
    texts = ["trend_short", "ma_crossover", "anomaly_type"]

    def both(s):
        return frame(s.run(bars, 101, ind.batch_step, anomalies.zscore_step), *cols, *texts)

    a, b = both(whole), both(cut)
    pd.testing.assert_frame_equal(a[cols], b[cols], rtol=1e-12)
    assert (a[texts] == b[texts]).all().all()


@pytest.mark.parametrize("block", [5, 37, 100_000])
def test_ema_equals_the_recursion(bars, block):
    out = frame(ema.add_ema(bars, Series(unit="MONTH", block_rows=block), periods=(2, 12, 50)),
                "close", "ema_2", "ema_12", "ema_50")
    for p in (2, 12, 50):
        want = out.groupby("symbol")["close"].transform(
            lambda x, p=p: x.ewm(span=p, adjust=False).mean())
        np.testing.assert_allclose(out[f"ema_{p}"], want, rtol=1e-11)


@pytest.mark.parametrize("periods", [(2, 300), (1000,)])
def test_long_averages_over_many_blocks(bars, periods, monkeypatch):
    """More blocks count than a run holds, and no row comes in twice."""
    monkeypatch.setattr(ema, "RUN", 3)
    s = Series(unit="MONTH", block_rows=6)
    wide, cut = ema.spread_for(bars, s, ema.Averages("close", periods))
    assert wide.groupBy("symbol", "_block").count().agg(F.max("count")).first()[0] <= 7
    out = frame(cut.own(wide.withColumns({f"ema_{p}": ema.ema(cut, "close", p) for p in periods})),
                "close", *[f"ema_{p}" for p in periods])
    assert len(out) == 761
    for p in periods:
        want = out.groupby("symbol")["close"].transform(
            lambda x, p=p: x.ewm(span=p, adjust=False).mean())
        np.testing.assert_allclose(out[f"ema_{p}"], want, rtol=1e-10)
    adjusted = frame(ema.add_ema_adjusted(bars, s, periods=periods), *[f"ema_{p}" for p in periods])
    for p in periods:
        want = out.groupby("symbol")["close"].transform(lambda x, p=p: x.ewm(span=p).mean())
        np.testing.assert_allclose(adjusted[f"ema_{p}"], want, rtol=1e-10)


@pytest.mark.parametrize("spans", [(12, 26, 9), (9, 26, 9), (3, 200, 50)])
def test_macd_of_any_spans_in_small_blocks(bars, spans):
    out = frame(ind.macd(bars, Series(unit="MONTH", block_rows=11), fast=spans[0], slow=spans[1],
                         signal=spans[2]), "close", "macd_line", "signal_line", "macd_signal")
    g = out.groupby("symbol")["close"]
    fast, slow = (g.transform(lambda x, p=p: x.ewm(span=p, adjust=False).mean()) for p in spans[:2])
    line = fast - slow
    np.testing.assert_allclose(out["macd_line"], line, atol=1e-9)
    by = out["symbol"]
    signal = line.groupby(by).transform(lambda x: x.ewm(span=spans[2], adjust=False).mean())
    np.testing.assert_allclose(out["signal_line"], signal, atol=1e-9)
    before, was = line.groupby(by).shift(1), signal.groupby(by).shift(1)
    up = (line > signal) & (before <= was)
    clear = (line - signal).abs() > 1e-9
    assert (out["macd_signal"][clear] == "BULLISH_CROSSOVER").tolist() == up[clear].tolist()


def test_features_do_not_depend_on_blocks(bars):
    p = bars.select("symbol", "ts", F.col("close").alias("price"), "volume").filter("volume > 0")
    cols = ["ema_12", "macd", "macd_signal", "rsi", "momentum_10"]
    a, b = (frame(features.prediction_features(p, Series(unit="MONTH", block_rows=n)), *cols)
            for n in (13, 1_000_000))
    assert len(a) > 500
    pd.testing.assert_frame_equal(a[cols], b[cols], rtol=1e-9, atol=1e-12)
    want = frame(p, "price", "volume")
    line = want.groupby("symbol")["price"].transform(
        lambda x: x.ewm(span=12).mean() - x.ewm(span=26).mean())
    signal = line.groupby(want["symbol"]).transform(lambda x: x.ewm(span=9).mean())
    merged = a.merge(want.assign(want=signal), on=["symbol", "ts"])
    np.testing.assert_allclose(merged["macd_signal"], merged["want"], atol=1e-9)


def test_adjusted_ema_equals_pandas(bars):
    out = frame(ema.add_ema_adjusted(bars, Series(unit="MONTH", block_rows=50)), "close",
                "ema_12", "ema_26")
    for p in (12, 26):
        want = out.groupby("symbol")["close"].transform(lambda x, p=p: x.ewm(span=p).mean())
        np.testing.assert_allclose(out[f"ema_{p}"], want, rtol=1e-11)


def test_macd_chain_in_small_blocks(bars):
    out = frame(ind.macd(bars, Series(unit="MONTH", block_rows=40)), "close", "macd_line",
                "signal_line")
    g = out.groupby("symbol")["close"]
    line = (g.transform(lambda x: x.ewm(span=12, adjust=False).mean())
            - g.transform(lambda x: x.ewm(span=26, adjust=False).mean()))
    np.testing.assert_allclose(out["macd_line"], line, atol=1e-9)
    signal = line.groupby(out["symbol"]).transform(lambda x: x.ewm(span=9, adjust=False).mean())
    np.testing.assert_allclose(out["signal_line"], signal, atol=1e-9)


def test_all_indicators_match_single_ones(bars):
    s = Series(unit="YEAR", block_rows=30)
    every = frame(ind.all_indicators(bars, s), "sma_200", "stoch_d", "atr", "bb_position",
                  "macd_signal")
    np.testing.assert_allclose(every["sma_200"], frame(ind.sma(bars, s), "sma_200")["sma_200"])
    np.testing.assert_allclose(every["stoch_d"], frame(ind.stochastic(bars, s), "stoch_d")["stoch_d"])
    np.testing.assert_allclose(every["atr"], frame(ind.atr(bars, s), "atr")["atr"])
    assert (every["macd_signal"] == frame(ind.macd(bars, s), "macd_signal")["macd_signal"]).all()


def test_targets_look_ahead_across_blocks(bars):
    p = bars.select("symbol", "ts", F.col("close").alias("price"), "volume")
    out = frame(features.prediction_targets(p, (1, 5), Series(unit="MONTH", block_rows=9)),
                "price", "price_target_5d", "direction_5d")
    want = out.groupby("symbol")["price"].shift(-5)
    np.testing.assert_allclose(out["price_target_5d"].astype(float), want)
    assert (out.loc[want.isna(), "direction_5d"] == 0).all()


def test_positions_are_dense(bars):
    out = Series(keys=(), unit="MONTH", ties=("symbol",), block_rows=10).numbered(bars)
    got = sorted(r[0] for r in out.select("_at").collect())
    assert got == list(range(761))


def test_single_row_series(bars):
    row = ind.all_indicators(bars).filter("symbol = 'C'").first()
    assert row.rsi is None and row.rsi_signal == "NEUTRAL" and row.bb_std is None
    assert row.composite_signal == "HOLD" and row.macd_signal == "NO_SIGNAL"
    assert row.atr == pytest.approx(row.high - row.low)
    one = ind.batch_indicators(bars).filter("symbol = 'C'").first()
    assert one.trend_short == "DOWN" and one.ma_crossover == "NONE"
    assert one.price_change_pct == 0.0 and one.volatility_20 is None


def test_flat_and_rising_series(spark):
    rows = [("FLAT", DAY0 + dt.timedelta(days=i), 5.0, 5.0, 5.0, 5.0, 10, "s", "m")
            for i in range(20)]
    rows += [("UP", DAY0 + dt.timedelta(days=i), 1.0 + i, 1.0 + i, 1.0 + i, 1.0 + i, 10, "s", "m")
             for i in range(20)]
    b = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double,"
                              "low double, close double, volume bigint, source string,"
                              "market string")
    last = {r.symbol: r for r in ind.all_indicators(b).filter(
        F.col("ts") == DAY0 + dt.timedelta(days=19)).collect()}
    assert last["FLAT"].bb_position is None and last["FLAT"].stoch_k is None
    assert last["UP"].rsi is None and last["UP"].rsi_signal == "NEUTRAL"
    full = features.add_rsi_full(b.withColumn("price", F.col("close"))).filter(
        "symbol = 'UP'").orderBy(F.col("ts").desc()).first()
    assert full.rsi == 100.0
    z = anomalies.zscore_anomalies(b).filter("symbol = 'FLAT'").select("anomaly_type").distinct()
    assert [r[0] for r in z.collect()] == ["NONE"]


def test_spike_is_flagged(spark):
    close = [10.0 + (i % 3) * 0.1 for i in range(100)] + [50.0, 10.0, 60.0]
    volume = [100 + i % 5 for i in range(102)] + [9000]
    rows = [("S", DAY0 + dt.timedelta(days=i), c, c, c, c, v, "s", "m")
            for i, (c, v) in enumerate(zip(close, volume))]
    b = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double,"
                              "low double, close double, volume bigint, source string,"
                              "market string")
    out = anomalies.zscore_anomalies(b).orderBy("ts").collect()
    assert (out[100].anomaly_type, out[100].risk_level) == ("PRICE", "MEDIUM")
    assert (out[102].anomaly_type, out[102].risk_level) == ("PRICE_VOLUME", "HIGH")
    assert all(r.anomaly_type == "NONE" for r in out[:100])


def test_forest_finds_outliers_and_reloads(spark, tmp_path):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(0, 1, (3000, 3)), columns=list("abc"))
    pdf.loc[:19, list("abc")] += 12
    pdf["id"] = range(len(pdf))
    df = spark.createDataFrame(pdf).repartition(4)
    forest = isolation.fit(df, ("a", "b", "c"), ("id",), trees=50)
    assert forest.nodes.groupby("tree").size().max() <= 511 and forest.sample <= 256
    out = isolation.flag(isolation.score(df, forest), 0.05).toPandas()
    assert out[out["id"] < 20]["is_anomaly_ml"].all()
    assert abs(out["is_anomaly_ml"].mean() - 0.05) < 0.002
    forest.save(spark, str(tmp_path / "forest"))
    again = isolation.Forest.load(spark, str(tmp_path / "forest"))
    same = isolation.score(df, again).toPandas().set_index("id")["isolation_score"]
    np.testing.assert_allclose(same.sort_index(),
                               out.set_index("id")["isolation_score"].sort_index())


@pytest.mark.parametrize("keys", [(), ("symbol",)])
def test_numbering_deals_rows_evenly(bars, keys):
    s = Series(keys=keys, unit="YEAR", ties=() if keys else ("symbol",), block_rows=50)
    sizes = [r["count"] for r in s.dealt(bars).groupBy(*keys, "_slice").count().collect()]
    assert sum(sizes) == 761 and max(sizes) <= 2 * s.block_rows
    out = s.numbered(bars).toPandas().sort_values(["symbol", "ts"])
    if keys:
        want = out.groupby("symbol").cumcount()
    else:
        want = out.sort_values(["ts", "symbol"]).assign(n=range(761))["n"].reindex(out.index)
    assert (out["_at"] == want).all()
    assert (out["_total"] == (out.groupby("symbol")["ts"].transform("size") if keys else 761)).all()


@pytest.mark.parametrize("exact", [False, True])
def test_crowded_slices_are_cut(bars, exact):
    s = Series(unit="YEAR", fine="MONTH", block_rows=10)
    whole = s.spread(bars, 4, exact=exact)
    sizes = [r["count"] for r in whole.groupBy("symbol", "_block").count().collect()]
    assert max(sizes) <= 30  # two blocks and the rows looked back to
    own = s.own(whole)
    assert own.count() == 761 and own.columns == bars.columns
    pd.testing.assert_frame_equal(
        frame(s.run(bars, 20, ind.batch_step), "sma_20"),
        frame(Series(block_rows=1_000_000, unit="YEAR").run(bars, 20, ind.batch_step), "sma_20"))
