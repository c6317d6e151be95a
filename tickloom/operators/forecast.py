"""Forecasts for several horizons. Fits are Spark ML pipelines: one pass over the rows for
the normal equations, nothing gathered but the coefficients."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.labels import prediction_confidence
from tickloom.functions.numeric import percent, ratio
from tickloom.operators.features import HORIZONS, PREDICTION_FEATURES
from tickloom.operators.lookups import latest_per_symbol
from tickloom.operators.series import DAILY, Series

# Limits of the report and weights of the weighted ensemble.
MIN_R2, MIN_DIRECTION = 0.1, 0.55
MAX_ANOMALY_RATE, MAX_FOLD_DEVIATION = 0.5, 0.1
WEIGHTS = {"linear": 0.4, "ridge": 0.4, "moving_average": 0.2}
MIN_ROWS = 10


def _pipeline(stage, features) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            stage])


def fit_linear(train: DataFrame, target: str, features=PREDICTION_FEATURES) -> PipelineModel:
    """Least squares. Scaling the features does not change its predictions."""
    data = train.filter(F.col(target).isNotNull())
    return _pipeline(LinearRegression(featuresCol="features", labelCol=target, solver="normal",
                                      predictionCol="linear"), features).fit(data)


def fit_ridge(train: DataFrame, target: str, alpha: float = 1.0,
              features=PREDICTION_FEATURES) -> PipelineModel:
    """Ridge with penalty ``alpha`` on features scaled by their population deviation.

    Spark averages the loss, scales the label by its population deviation and standardises
    the features itself; the factor below makes the penalty the same.
    """
    data = train.filter(F.col(target).isNotNull())
    n, deviation = data.agg(F.count(F.lit(1)), F.stddev_pop(target)).first()
    strength = alpha * deviation / n
    return _pipeline(LinearRegression(featuresCol="features", labelCol=target, solver="normal",
                                      regParam=strength, elasticNetParam=0.0,
                                      predictionCol="ridge"), features).fit(data)


def fit_forest(train: DataFrame, target: str, features=PREDICTION_FEATURES,
               trees: int = 10) -> PipelineModel:
    data = train.filter(F.col(target).isNotNull())
    return _pipeline(RandomForestRegressor(featuresCol="features", labelCol=target,
                                           predictionCol="forest", numTrees=trees, seed=42),
                     features).fit(data)


def apply_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def average_window(horizon: int) -> int:
    return min(20, 2 * horizon)


def moving_average_forecast(prices: DataFrame, horizons=HORIZONS, series: Series = DAILY
                            ) -> DataFrame:
    """ma_<h>d: the average of the last rows, incl. the current, against the current price in
    percent, 0 while there are too few rows. ma_eval_<h>d: the rows before the current only."""
    def step(df: DataFrame, s: Series) -> DataFrame:
        out = {}
        for h in horizons:
            w = average_window(h)
            now, past = s.frame(w), s.frame(w, end=-1)
            for name, frame in ((f"ma_{h}d", now), (f"ma_eval_{h}d", past)):
                mean, n = F.avg("price").over(frame), F.count(F.lit(1)).over(frame)
                out[name] = F.when(n == w, percent(mean - F.col("price"), F.col("price"))
                                   ).otherwise(0.0)
        return df.withColumns(out)

    return series.run(prices, max(average_window(h) for h in horizons) + 1, step)


def ensemble(df: DataFrame, models: tuple[str, ...], weights: dict | None = None) -> DataFrame:
    """Plain mean of the model columns, or their weighted mean with weights rescaled to 1."""
    if weights:
        known = {m: weights[m] for m in models if m in weights}
        total = sum(known.values())
        value = sum((F.col(m) * (w / total) for m, w in known.items()), F.lit(0.0))
    else:
        value = sum((F.col(m) for m in models), F.lit(0.0)) / len(models)
    return df.withColumn("ensemble", value)


def long_predictions(df: DataFrame, models: tuple[str, ...], horizon: Column,
                     keep: tuple[str, ...] = ("symbol", "ts", "price")) -> DataFrame:
    """One row per model with price, change and confidence."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("change")) for m in models])
    out = df.select(*keep, horizon.alias("horizon"), F.explode(rows).alias("r"))
    return out.select(
        *keep, "horizon", "r.model", F.col("r.change").alias("predicted_change_pct"),
        (F.col("price") * (1 + F.col("r.change") / 100)).alias("predicted_price"),
        prediction_confidence(F.col("r.change")).alias("confidence"))


def predict_latest(features: DataFrame, models: dict[str, PipelineModel], horizon: int) -> DataFrame:
    """Newest row of each series through every model, and their ensemble."""
    latest = latest_per_symbol(features)
    for model in models.values():
        latest = apply_model(model, latest)
    names = (*models, f"ma_{horizon}d") if f"ma_{horizon}d" in features.columns else tuple(models)
    long = long_predictions(latest, names, F.lit(horizon))
    mean = long.groupBy("symbol", "ts", "price", "horizon").agg(
        F.lit("ensemble").alias("model"), F.avg("predicted_change_pct")
        .alias("predicted_change_pct"), F.avg("predicted_price").alias("predicted_price"),
        F.avg("confidence").alias("confidence"))
    return long.unionByName(mean)


def evaluate(df: DataFrame, truth: str, guess: str, *by: str) -> DataFrame:
    """mse, mae, r2, direction accuracy and sample count; groups under ten rows are left out."""
    y, p = F.col(truth), F.col(guess)
    known = df.filter(y.isNotNull() & p.isNotNull())
    return known.groupBy(*by).agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        (1 - ratio(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("r2"),
        F.avg(((p > 0) == (y > 0)).cast("int")).alias("direction_accuracy"),
        F.count(F.lit(1)).alias("samples")).filter(F.col("samples") >= MIN_ROWS)


def threshold_report(metrics: DataFrame) -> DataFrame:
    r2, direction = F.col("r2") >= MIN_R2, F.col("direction_accuracy") >= MIN_DIRECTION
    return metrics.withColumns({"r2_ok": r2, "direction_ok": direction,
                                "passed": r2 & direction})


def anomaly_threshold_report(summary: DataFrame) -> DataFrame:
    """Checks on rate and fold deviation of an anomaly model."""
    return summary.withColumns({
        "rate_ok": F.col("anomaly_rate") <= MAX_ANOMALY_RATE,
        "stable": F.col("rate_deviation") <= MAX_FOLD_DEVIATION})


def assign_folds(df: DataFrame, folds: int = 5, series: Series = DAILY) -> DataFrame:
    """``fold`` 0 is training only; fold i is tested by a model of all folds before it.

    The position in time is global; it comes from counts per slice, not from one big sort.
    """
    whole = replace(series, keys=(), ties=("symbol",))
    placed = whole.numbered(df)
    test = F.floor(F.col("_total") / (folds + 1))
    first = F.col("_total") - test * folds
    return placed.withColumn("fold", F.when(F.col("_at") < first, 0).otherwise(
        F.floor((F.col("_at") - first) / test) + 1).cast("int")).drop("_at", "_total")
