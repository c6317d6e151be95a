"""Features, statistical anomalies, forecasts, forest, runs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window, functions as F

from checks.fixtures import BARS, bars, r, rounded, rounded_sql, rsql, with_ctes
from checks.q_indicators import W, ema_adjusted_sql, frame
from checks.registry import query
from tickloom.functions.times import latest
from tickloom.operators import (alerts as al, anomalies as an, features as ft, forecast as fc,
                                isolation, summaries as sm, topk, validation as va)
from tickloom.session import shared_folder, staged
from tickloom.sinks.tables import run_row


def prices(spark, sf):
    return bars(spark, sf).select("symbol", "ts", F.col("close").alias("price"), "volume")


PRICES = BARS + ", prices AS (SELECT symbol, ts, close AS price, volume FROM bars)"


def full(value: str, n: int) -> str:
    return f"CASE WHEN count(*) OVER {frame(n)} = {n} THEN {value} END"


AF = f"""
f0 AS (SELECT *, price / lag(price) OVER ({W}) - 1 AS price_change,
  volume / nullif(lag(volume) OVER ({W}), 0) - 1 AS volume_change,
  {full(f'avg(price) OVER {frame(20)}', 20)} AS price_ma,
  {full(f'stddev_samp(price) OVER {frame(20)}', 20)} AS price_std,
  {full(f'avg(volume) OVER {frame(20)}', 20)} AS volume_ma,
  {full(f'stddev_samp(volume) OVER {frame(20)}', 20)} AS volume_std FROM prices),
f1 AS (SELECT *, price_std / nullif(price_ma, 0) AS volatility,
  price / nullif(volume, 0) AS price_volume_ratio FROM f0),
feats AS (SELECT * FROM f1 WHERE price_change IS NOT NULL AND volume_change IS NOT NULL
  AND price_std IS NOT NULL AND volatility IS NOT NULL AND price_volume_ratio IS NOT NULL)
"""
AF_COLS = ("price_change", "volume_change", "price_ma", "price_std", "volume_ma", "volume_std",
           "volatility", "price_volume_ratio")


@query("anomaly_features", with_ctes(PRICES, AF, body=f"""
SELECT symbol, ts, {rounded_sql(*AF_COLS)} FROM feats"""))
def _(spark, sf):
    return ft.anomaly_features(prices(spark, sf)).select("symbol", "ts", *rounded(*AF_COLS))


RSI_FULL = f"""
g0 AS (SELECT *, price - lag(price) OVER ({W}) AS ch,
  row_number() OVER ({W}) - 1 AS rn FROM prices),
g1 AS (SELECT *, CASE WHEN ch > 0 THEN ch ELSE 0 END AS g, CASE WHEN ch < 0 THEN -ch ELSE 0 END
  AS l FROM g0),
g2 AS (SELECT *, avg(g) OVER {frame(14)} AS ag, avg(l) OVER {frame(14)} AS al FROM g1),
g3 AS (SELECT *, {full('CASE WHEN al = 0 AND ag > 0 THEN 100 ELSE 100 - 100.0 / (1 + ag / nullif(al, 0)) END', 14)}
  AS rsi FROM g2)
"""


@query("rsi_full", with_ctes(PRICES, RSI_FULL, body=f"""
SELECT symbol, ts, {rsql('rsi')} AS rsi FROM g3"""))
def _(spark, sf):
    return ft.add_rsi_full(prices(spark, sf)).select("symbol", "ts", r("rsi").alias("rsi"))


PF = RSI_FULL + f""",
p1 AS (SELECT *, price / lag(price) OVER ({W}) - 1 AS price_change,
  volume / nullif(lag(volume) OVER ({W}), 0) - 1 AS volume_change,
  {full(f'avg(price) OVER {frame(5)}', 5)} AS sma_5,
  {full(f'avg(price) OVER {frame(20)}', 20)} AS sma_20,
  {full(f'stddev_samp(price) OVER {frame(20)}', 20)} AS bollinger_std,
  {ema_adjusted_sql('price', 12)} AS ema_12, {ema_adjusted_sql('price', 26)} AS ema_26,
  price / lag(price, 5) OVER ({W}) - 1 AS momentum_5,
  price / lag(price, 10) OVER ({W}) - 1 AS momentum_10 FROM g3),
p2 AS (SELECT *, ema_12 - ema_26 AS macd, sma_20 + 2 * bollinger_std AS bollinger_upper,
  sma_20 - 2 * bollinger_std AS bollinger_lower, bollinger_std / sma_20 AS volatility FROM p1),
p3 AS (SELECT *, {ema_adjusted_sql('macd', 9)} AS macd_signal FROM p2),
pf AS (SELECT * FROM p3 WHERE sma_20 IS NOT NULL AND rsi IS NOT NULL
  AND volume_change IS NOT NULL)
"""
PF_COLS = ("price_change", "volume_change", "sma_5", "sma_20", "ema_12", "ema_26", "rsi", "macd",
           "macd_signal", "bollinger_upper", "bollinger_lower", "volatility", "momentum_5",
           "momentum_10")


@query("prediction_features", with_ctes(PRICES, PF, body=f"""
SELECT symbol, ts, {rounded_sql(*PF_COLS)} FROM pf"""))
def _(spark, sf):
    return ft.prediction_features(prices(spark, sf)).select("symbol", "ts", *rounded(*PF_COLS))


H = ft.HORIZONS
TARGETS = "tg AS (SELECT *, " + ", ".join(
    f"lead(price, {h}) OVER ({W}) AS price_target_{h}d, "
    f"(lead(price, {h}) OVER ({W}) - price) / price * 100 AS price_change_{h}d"
    for h in H) + " FROM prices)"


@query("prediction_targets", with_ctes(PRICES, TARGETS, body="SELECT symbol, ts, " + ", ".join(
    f"{rounded_sql(f'price_target_{h}d', f'price_change_{h}d')}, "
    f"CASE WHEN price_change_{h}d > 0 THEN 1 ELSE 0 END AS direction_{h}d" for h in H)
    + " FROM tg"))
def _(spark, sf):
    out = ft.prediction_targets(prices(spark, sf))
    return out.select("symbol", "ts", *rounded(
        *[c for h in H for c in (f"price_target_{h}d", f"price_change_{h}d")]),
        *[f"direction_{h}d" for h in H])


@query("chronological_split", with_ctes(PRICES, f"""
sp AS (SELECT *, row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY symbol) AS n
       FROM prices)""", body="""
SELECT symbol, ts, rn <= floor(n * 0.7::DOUBLE) AS is_train FROM sp"""))
def _(spark, sf):
    return ft.chronological_split(prices(spark, sf)).select("symbol", "ts", "is_train")


# -- statistical anomalies -----------------------------------------------------------

FEATS = an.FEATURES
ZG = AF + ", st AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s, quantile_cont({c}::DOUBLE, 0.25) AS {c}_q1, "
    f"quantile_cont({c}::DOUBLE, 0.75) AS {c}_q3" for c in FEATS) + " FROM feats), zg AS (SELECT *, " + ", ".join(
    f"abs(({c} - {c}_m) / {c}_s) AS {c}_zscore, abs(({c} - {c}_m) / {c}_s) > 3 AS "
    f"{c}_anomaly_zscore, ({c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * "
    f"({c}_q3 - {c}_q1)) AS {c}_anomaly_iqr" for c in FEATS) + " FROM feats, st)"


@query("zscore_global", with_ctes(PRICES, ZG, body="SELECT symbol, ts, " + ", ".join(
    f"{rsql(c + '_zscore')} AS {c}_zscore, {c}_anomaly_zscore" for c in FEATS) + " FROM zg"))
def _(spark, sf):
    out = an.zscore_global(ft.anomaly_features(prices(spark, sf)))
    return out.select("symbol", "ts", *rounded(*[f"{c}_zscore" for c in FEATS]),
                      *[f"{c}_anomaly_zscore" for c in FEATS])


@query("iqr_outliers", with_ctes(PRICES, ZG, body="SELECT symbol, ts, " + ", ".join(
    f"{c}_anomaly_iqr" for c in FEATS) + " FROM zg"))
def _(spark, sf):
    out = an.iqr_outliers(ft.anomaly_features(prices(spark, sf)))
    return out.select("symbol", "ts", *[f"{c}_anomaly_iqr" for c in FEATS])


@query("statistical_anomalies", with_ctes(PRICES, ZG, body=f"""
SELECT symbol, ts, {' OR '.join(f'{c}_anomaly_zscore OR {c}_anomaly_iqr' for c in FEATS)}
  AS is_anomaly_statistical,
  {rsql('greatest(' + ', '.join(f'{c}_zscore' for c in FEATS) + ')')} AS anomaly_score_statistical
FROM zg"""))
def _(spark, sf):
    out = an.statistical_anomalies(ft.anomaly_features(prices(spark, sf)))
    return out.select("symbol", "ts", "is_anomaly_statistical",
                      r("anomaly_score_statistical").alias("anomaly_score_statistical"))


def forest_flags(df):
    forest = isolation.fit(df, ft.ANOMALY_FEATURES)
    return isolation.flag(isolation.score(df, forest))


@query("isolation_forest")
def _(spark, sf):
    return forest_flags(ft.anomaly_features(prices(spark, sf))).select(
        "symbol", "ts", "isolation_score", "anomaly_score_ml", "is_anomaly_ml")


@query("combined_anomalies")
def _(spark, sf):
    features = ft.anomaly_features(prices(spark, sf))
    return an.combine_flags(forest_flags(an.statistical_anomalies(features))).select(
        "symbol", "ts", "is_anomaly", "anomaly_score", "detection_method")


# -- forecasts -----------------------------------------------------------------------

MA = "ma AS (SELECT *, " + ", ".join(
    f"CASE WHEN count(*) OVER {frame(w)} = {w} THEN (avg(price) OVER {frame(w)} - price) / price "
    f"* 100 ELSE 0 END AS ma_{h}d, CASE WHEN count(*) OVER p{h} = {w} THEN (avg(price) OVER p{h} "
    f"- price) / price * 100 ELSE 0 END AS ma_eval_{h}d"
    for h in H for w in [fc.average_window(h)]) + " FROM prices WINDOW " + ", ".join(
    f"p{h} AS ({W} ROWS BETWEEN {fc.average_window(h)} PRECEDING AND 1 PRECEDING)"
    for h in H) + ")"
MA_COLS = [c for h in H for c in (f"ma_{h}d", f"ma_eval_{h}d")]


@query("moving_average_forecast", with_ctes(PRICES, MA, body=f"""
SELECT symbol, ts, {rounded_sql(*MA_COLS)} FROM ma"""))
def _(spark, sf):
    return fc.moving_average_forecast(prices(spark, sf)).select("symbol", "ts", *rounded(*MA_COLS))


# Three averages stand in for the three models, so that SQL can repeat the combination.
STAND_INS = ("linear", "ridge", "moving_average")


def model_columns(spark, sf):
    return fc.moving_average_forecast(prices(spark, sf)).select(
        "symbol", "ts", "price", F.col("ma_1d").alias("linear"), F.col("ma_5d").alias("ridge"),
        F.col("ma_10d").alias("moving_average"))


MODELS = MA + """, mc AS (SELECT symbol, ts, price, ma_1d AS linear, ma_5d AS ridge,
  ma_10d AS moving_average FROM ma)"""


@query("ensemble_forecast", with_ctes(PRICES, MODELS, body=f"""
SELECT symbol, ts, {rsql('(linear + ridge + moving_average) / 3')} AS plain,
  {rsql('(0.4 * linear + 0.2 * moving_average) / 0.6')} AS weighted FROM mc"""))
def _(spark, sf):
    plain = fc.ensemble(model_columns(spark, sf), STAND_INS).withColumnRenamed("ensemble", "plain")
    return fc.ensemble(plain, ("linear", "moving_average"), fc.WEIGHTS).select(
        "symbol", "ts", r("plain").alias("plain"), r("ensemble").alias("weighted"))


def predictions(spark, sf):
    """Every row, three models and two horizons."""
    wide = model_columns(spark, sf).withColumn("h", F.explode(F.array(F.lit(1), F.lit(5))))
    scaled = wide.withColumns({m: F.col(m) / F.col("h") for m in STAND_INS})
    return fc.long_predictions(scaled, STAND_INS, F.col("h"))


CONF = "CASE WHEN abs(c) < 1 THEN 0.9 WHEN abs(c) < 5 THEN 0.7 ELSE 0.5 END::DOUBLE"
PRED = MODELS + f""", pl AS (SELECT symbol, ts, price, h AS horizon, model, pos, c / h AS c
  FROM (SELECT *, unnest([linear, ridge, moving_average]) AS c,
        unnest(['linear', 'ridge', 'moving_average']) AS model, unnest([1, 2, 3]) AS pos FROM mc),
       (VALUES (1), (5)) hz(h)),
pred AS (SELECT *, c AS predicted_change_pct, price * (1 + c / 100) AS predicted_price,
  {CONF} AS confidence FROM pl)"""


@query("long_predictions", with_ctes(PRICES, PRED, body=f"""
SELECT symbol, ts, horizon, model, {rounded_sql('predicted_change_pct', 'predicted_price')},
  confidence FROM pred"""))
def _(spark, sf):
    return predictions(spark, sf).select(
        "symbol", "ts", "horizon", "model", *rounded("predicted_change_pct", "predicted_price"),
        "confidence")


BEST = PRED + """, best AS (SELECT * FROM pred QUALIFY row_number() OVER (
  PARTITION BY symbol, ts, horizon ORDER BY confidence DESC, pos) = 1)"""


def best(spark, sf):
    return topk.best_prediction(predictions(spark, sf), ("symbol", "ts", "horizon"), STAND_INS)


@query("best_prediction", with_ctes(PRICES, BEST, body=f"""
SELECT symbol, ts, horizon, model, {rounded_sql('predicted_change_pct')}, confidence FROM best"""))
def _(spark, sf):
    return best(spark, sf).select("symbol", "ts", "horizon", "model",
                                  *rounded("predicted_change_pct"), "confidence")


@query("prediction_alerts", with_ctes(PRICES, BEST, body=f"""
SELECT symbol, ts, horizon, model, {rounded_sql('predicted_change_pct')}, confidence,
  'significant_prediction' AS alert_type FROM best WHERE abs(c) > 3 AND confidence > 0.6"""))
def _(spark, sf):
    return al.prediction_alerts(best(spark, sf), 3.0, 0.6).select(
        "symbol", "ts", "horizon", "model", *rounded("predicted_change_pct"), "confidence",
        "alert_type")


@query("prediction_statistics", with_ctes(PRICES, BEST, body="""
SELECT horizon, count(*) AS predictions, count(*) FILTER (abs(c) > 5) AS significant FROM best
WHERE ts >= (SELECT max(ts) FROM prices) - INTERVAL 365 DAY GROUP BY horizon"""))
def _(spark, sf):
    return sm.prediction_statistics(best(spark, sf), latest(prices(spark, sf)), 365)


@query("prediction_report", with_ctes(PRICES, BEST, body=f"""
SELECT symbol, {rsql('avg(c)')} AS avg_predicted_change, {rsql('max(c)')} AS max_predicted_change,
  {rsql('min(c)')} AS min_predicted_change, {rsql('avg(confidence)')} AS avg_confidence,
  {rsql('1 - stddev_pop(c) / (avg(abs(c)) + 1e-6)')} AS prediction_consistency,
  CASE WHEN avg(c) > 0 THEN 'bullish' ELSE 'bearish' END AS trend_direction
FROM best GROUP BY symbol"""))
def _(spark, sf):
    return sm.prediction_report(best(spark, sf)).withColumns({c: r(c) for c in (
        "avg_predicted_change", "max_predicted_change", "min_predicted_change", "avg_confidence",
        "prediction_consistency")})


EV = MA + ", " + TARGETS + ", " + """
ev AS (SELECT h AS horizon, y, p FROM (
""" + " UNION ALL ".join(
    f"SELECT {h} AS h, price_change_{h}d AS y, ma_eval_{h}d AS p FROM ma JOIN "
    f"(SELECT symbol, ts, price_change_{h}d FROM tg) USING (symbol, ts)" for h in H) + """)
  WHERE y IS NOT NULL AND p IS NOT NULL),
me AS (SELECT horizon, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
  1 - avg((y - p) * (y - p)) / var_pop(y) AS r2, avg(CAST((p > 0) = (y > 0) AS INT)) AS
  direction_accuracy, count(*) AS samples FROM ev GROUP BY horizon HAVING count(*) >= 10)"""
METRIC_COLS = ("mse", "mae", "r2", "direction_accuracy")


def metrics(spark, sf):
    p = prices(spark, sf)
    both = ft.prediction_targets(fc.moving_average_forecast(p))
    rows = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"price_change_{h}d").alias("y"),
                              F.col(f"ma_eval_{h}d").alias("p")) for h in H])
    long = both.select(F.explode(rows).alias("r")).select("r.*")
    return fc.evaluate(long, "y", "p", "horizon")


@query("evaluate_forecast", with_ctes(PRICES, EV, body=f"""
SELECT horizon, {rounded_sql(*METRIC_COLS)}, samples FROM me"""))
def _(spark, sf):
    return metrics(spark, sf).select("horizon", *rounded(*METRIC_COLS), "samples")


@query("threshold_report", with_ctes(PRICES, EV, body="""
SELECT horizon, r2 >= 0.1 AS r2_ok, direction_accuracy >= 0.55 AS direction_ok,
  r2 >= 0.1 AND direction_accuracy >= 0.55 AS passed FROM me"""))
def _(spark, sf):
    return fc.threshold_report(metrics(spark, sf)).select(
        "horizon", "r2_ok", "direction_ok", "passed")


TARGET_COLS = tuple(f"price_change_{h}d" for h in H)


def training_table(spark, sf):
    """Features and targets, written once to the shared folder: the fits read it repeatedly."""
    path = shared_folder(spark)
    (ft.prediction_targets(ft.prediction_features(prices(spark, sf)))
     .write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


def union(parts):
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def split_table(spark, sf):
    """The training table with ``is_train`` for the first 80 % of each series, written once."""
    return staged(ft.chronological_split(training_table(spark, sf), 0.8), "split")


def split_scores(spark, sf, penalties):
    """Models of the earlier part of each series, scored on both parts, for every horizon."""
    table = split_table(spark, sf).withColumn("fold", F.when(F.col("is_train"), 0).otherwise(1))
    models = va.solve_folds(va.fold_moments(table, TARGET_COLS), penalties)
    both = pd.concat([models, models.assign(fold=0)])
    scored = fc.evaluate(va.predict_folds(table, both), "truth", "guess", "target", "penalty", "fold")
    return by_horizon(scored).withColumn("is_train", F.col("fold") == 0).drop("fold")


def by_horizon(scored):
    return scored.withColumn("horizon", F.regexp_extract("target", r"(\d+)d$", 1).cast("int")).drop("target")


@query("linear_forecast")
def _(spark, sf):
    return split_scores(spark, sf, (0.0,)).drop("penalty")


@query("ridge_forecast")
def _(spark, sf):
    return split_scores(spark, sf, (1.0, 0.5, 2.0)).withColumnRenamed("penalty", "alpha")


@query("predict_latest", with_ctes(PRICES, PF, body="""
SELECT symbol, max(ts) AS ts, horizon, model, true AS consistent FROM pf,
  (SELECT unnest([1, 5, 10, 20]) AS horizon),
  (SELECT unnest(['linear', 'ridge', 'moving_average', 'ensemble']) AS model)
GROUP BY symbol, horizon, model"""))
def _(spark, sf):
    """Rows of every horizon and model; each price must follow from its change, and the ensemble
    from its members."""
    table = staged(fc.moving_average_forecast(training_table(spark, sf)), "features")
    parts = []
    for h in H:
        target = f"price_change_{h}d"
        models = {"linear": fc.fit_linear(table, target), "ridge": fc.fit_ridge(table, target)}
        parts.append(fc.predict_latest(table, models, h).withColumn(
            "model", F.regexp_replace("model", "^ma_.*", "moving_average")))
    out = union(parts)
    change = F.col("predicted_change_pct")
    mean = F.avg(F.when(F.col("model") != "ensemble", change)).over(
        Window.partitionBy("symbol", "horizon"))  # four rows each
    priced = F.abs(F.col("predicted_price") - F.col("price") * (1 + change / 100))
    follows = (priced <= 1e-9 * F.col("price")) & F.when(
        F.col("model") == "ensemble", F.abs(change - mean) <= 1e-9).otherwise(True)
    return out.select("symbol", "ts", "horizon", "model", follows.alias("consistent"))


def folded_table(spark, sf):
    return staged(fc.assign_folds(training_table(spark, sf)), "folds")


@query("time_series_cv")
def _(spark, sf):
    return by_horizon(va.cross_validate(folded_table(spark, sf), TARGET_COLS)).drop("penalty")


@query("time_series_cv_summary")
def _(spark, sf):
    """Mean and deviation over the folds, per horizon."""
    return by_horizon(va.fold_summary(va.cross_validate(folded_table(spark, sf), TARGET_COLS))).drop(
        "penalty")


MOMENT_COLS = (*ft.PREDICTION_FEATURES, "y")
FOLDED = TARGETS + f""",
tr AS (SELECT pf.*, {', '.join(f'tg.{c}' for c in TARGET_COLS)} FROM pf JOIN tg USING (symbol, ts)),
fo AS (SELECT *, row_number() OVER (ORDER BY ts, symbol) - 1 AS pos, count(*) OVER () AS total FROM tr),
folded AS (SELECT *, CASE WHEN pos < total - total // 6 * 5 THEN 0
  ELSE (pos - (total - total // 6 * 5)) // (total // 6) + 1 END::INT AS fold FROM fo),
long AS (SELECT fold, {', '.join(ft.PREDICTION_FEATURES)}, unnest([{', '.join(TARGET_COLS)}]) AS y,
  unnest({list(TARGET_COLS)}) AS target FROM folded)"""


@query("fold_moments", with_ctes(PRICES, PF, FOLDED, body="""
SELECT fold, target, n, c.i AS i, c.j AS j, """ + rsql("c.v") + """ AS correlation FROM (
  SELECT fold, target, count(*) AS n, unnest([""" + ", ".join(
    f"{{'i': {i}, 'j': {j}, 'v': corr({a}, {b})}}" for i, a in enumerate(MOMENT_COLS)
    for j, b in enumerate(MOMENT_COLS) if i < j) + """]) AS c
  FROM long WHERE y IS NOT NULL GROUP BY fold, target)"""))
def _(spark, sf):
    """The matrices that the models are solved from, as correlations."""
    size = len(MOMENT_COLS)
    moments = va.fold_moments(folded_table(spark, sf), TARGET_COLS)
    cells = moments.select("fold", "target", "n", "products", F.posexplode("products").alias("at", "v"))
    i, j = F.floor(F.col("at") / size), F.col("at") % size
    spread = F.sqrt(F.get("products", (i * (size + 1)).cast("int"))
                    * F.get("products", (j * (size + 1)).cast("int")))
    return cells.filter(i < j).select(
        "fold", "target", "n", i.cast("int").alias("i"), j.cast("int").alias("j"),
        r(F.col("v") / spread).alias("correlation"))


def anomaly_folds(spark, sf):
    return va.forest_rates(staged(fc.assign_folds(ft.anomaly_features(prices(spark, sf))), "folds"),
                           ft.ANOMALY_FEATURES)


@query("anomaly_cv")
def _(spark, sf):
    """Anomaly rate of each fold under a forest of the folds before it."""
    return anomaly_folds(spark, sf)


@query("anomaly_cv_report")
def _(spark, sf):
    """Mean rate and deviation over the folds against their limits."""
    return va.rate_summary(anomaly_folds(spark, sf))


@query("time_series_folds", with_ctes(PRICES, """
o AS (SELECT symbol, ts, row_number() OVER (ORDER BY ts, symbol) - 1 AS pos,
             count(*) OVER () AS n FROM prices),
o2 AS (SELECT *, n // 6 AS t, n - (n // 6) * 5 AS f FROM o)""", body="""
SELECT symbol, ts, CASE WHEN pos < f THEN 0 ELSE (pos - f) // t + 1 END::INT AS fold FROM o2"""))
def _(spark, sf):
    return fc.assign_folds(prices(spark, sf)).select("symbol", "ts", "fold")


@query("forest_regressor")
def _(spark, sf):
    split = split_table(spark, sf)
    parts = []
    for h in H:
        target = f"price_change_{h}d"
        model = fc.fit_forest(split.filter("is_train"), target)
        parts.append(fc.evaluate(fc.apply_model(model, split), target, "forest", "is_train")
                     .withColumn("horizon", F.lit(h)))
    return union(parts)


@query("model_persist", with_ctes(PRICES, PF, body="""
SELECT symbol, ts, true AS same FROM pf"""))
def _(spark, sf):
    from pyspark.ml import PipelineModel
    table, path = training_table(spark, sf), shared_folder(spark)
    model = fc.fit_linear(table, "price_change_5d")
    model.save(path)
    again = fc.apply_model(PipelineModel.load(path), table).withColumnRenamed("linear", "loaded")
    return fc.apply_model(model, again).select(
        "symbol", "ts", (F.col("linear") == F.col("loaded")).alias("same"))


# -- runs ----------------------------------------------------------------------------

RUNS = """
runs AS (SELECT symbol AS run_id, market AS experiment, max(ts) - INTERVAL (count(*) % 3) DAY
  AS started_at, avg(close) AS score FROM bars GROUP BY symbol, market)
"""


def runs(spark, sf):
    return bars(spark, sf).groupBy(F.col("symbol").alias("run_id"),
                                   F.col("market").alias("experiment")).agg(
        (F.max("ts") - F.make_dt_interval((F.count(F.lit(1)) % 3).cast("int")))
        .alias("started_at"), F.avg("close").alias("score"))


@query("best_run", with_ctes(BARS, RUNS, body=f"""
SELECT run_id, experiment, {rsql('score')} AS score FROM runs ORDER BY runs.score DESC, run_id
LIMIT 1"""))
def _(spark, sf):
    return topk.best_run(runs(spark, sf), "score").select(
        "run_id", "experiment", r("score").alias("score"))


@query("keep_last_runs", with_ctes(BARS, RUNS, body="""
SELECT run_id, experiment, started_at::TIMESTAMP AS started_at FROM runs
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY started_at DESC, run_id DESC) <= 4"""))
def _(spark, sf):
    return topk.keep_last_runs(runs(spark, sf), 4).select("run_id", "experiment", "started_at")


@query("run_metrics_table", with_ctes(PRICES, EV, body=f"""
SELECT 'horizon-' || horizon AS run_id, 'moving_average' AS experiment, {rounded_sql('r2', 'mae')},
  TIMESTAMP '2024-01-01' AS started_at, 'scikit-learn' AS framework, '2.' || horizon AS version,
  'baseline' AS purpose FROM me"""))
def _(spark, sf):
    """Runs appended one evaluation at a time, read back as a table."""
    import datetime as dt
    path = shared_folder(spark)
    for row in metrics(spark, sf).collect():  # one row per horizon
        run_row(spark, f"horizon-{row.horizon}", "moving_average", {"horizon": row.horizon},
                {"r2": row.r2, "mae": row.mae}, dt.datetime(2024, 1, 1),
                {"version": f"2.{row.horizon}", "purpose": "baseline"}).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("run_id", "experiment", r("metrics.r2").alias("r2"),
                                           r("metrics.mae").alias("mae"), "started_at",
                                           "tags.framework", "tags.version", "tags.purpose")
