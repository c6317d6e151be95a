"""Cross-validation of linear models from the moments of the folds, read in one pass.

Least squares and ridge need no more of the rows than counts, means and centred cross-products of
features and target. Each task computes them per fold and target, they are merged by their exact
formula, and the model of fold i is solved from the merged moments of the folds before it: for all
targets and penalties at once, whatever their number. A second pass scores the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators import forecast as fc, isolation
from tickloom.operators.features import PREDICTION_FEATURES
from tickloom.operators.quantiles import exact_quantiles
from tickloom.session import staged

_KINDS = "fold int, target string, n long, mean array<double>, products array<double>"
#: Tasks' moments that are merged by one call; directions of the features that are noise.
FAN_IN, RANK_TOLERANCE = 256, 1e-11


@dataclass
class Moments:
    """Count, means, and centred cross-products of the features and, last, the target."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> "Moments":
        mean = rows.mean(0)
        return Moments(len(rows), mean, (rows - mean).T @ (rows - mean))

    def merge(self, other: "Moments") -> "Moments":
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products
                       + np.outer(gap, gap) * (self.n * other.n / n))

    def solve(self, penalty: float = 0.0) -> tuple[np.ndarray, float]:
        """Coefficients and intercept. The penalty is on features scaled by their population
        deviation. Directions without spread (constant or dependent features) get none."""
        spread = np.sqrt(np.diag(self.products)[:-1] / self.n)
        used = spread > 1e-12 * np.maximum(np.abs(self.mean[:-1]), 1e-300)
        scale = np.where(used, spread, 1.0)
        gram = (self.products[:-1, :-1] / scale / scale[:, None])[np.ix_(used, used)]
        values, vectors = np.linalg.eigh(gram)
        keep = values > RANK_TOLERANCE * max(values.max(initial=0.0), 1e-300)
        inverse = np.where(keep, 1.0 / np.where(keep, values + penalty, 1.0), 0.0)
        right = (self.products[:-1, -1] / scale)[used]
        out = np.zeros(len(spread))
        out[used] = vectors @ (inverse * (vectors.T @ right))
        out /= scale
        return out, float(self.mean[-1] - out @ self.mean[:-1])


def fold_moments(folded: DataFrame, targets: tuple[str, ...], features=PREDICTION_FEATURES
                 ) -> DataFrame:
    """fold, target, n, mean, products (row by row) over the rows whose target is known.

    One pass: a task sends a row per fold and target. They are merged FAN_IN at a time, so that
    neither a task nor the driver holds those of all tasks.
    """
    rows = folded.select("fold", *[F.col(c).cast("double").alias(c) for c in (*features, *targets)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, Moments] = {}
        for batch in batches:
            part = batch.to_pandas()
            for fold, group in part.groupby("fold"):
                for target in targets:
                    known = group[[*features, target]].dropna().to_numpy(np.float64)
                    if len(known):
                        one, key = Moments.of(known), (int(fold), target)
                        found[key] = found[key].merge(one) if key in found else one
        if found:
            yield _batch(found)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for row in group.itertuples():
            one = _moments(row)
            total = one if total is None else total.merge(one)
        key = (int(group["fold"].iloc[0]), group["target"].iloc[0])
        return _batch({key: total}).to_pandas()

    parts = rows.mapInArrow(measure, _KINDS).withColumn("_part", F.spark_partition_id())
    group = (F.floor(F.col("_part") / FAN_IN)).alias("_group")
    first = parts.groupBy("fold", "target", group).applyInPandas(
        lambda g: merge(g.drop(columns="_part")), _KINDS)
    return first.groupBy("fold", "target").applyInPandas(merge, _KINDS)


def _batch(found: dict[tuple, Moments]) -> pa.RecordBatch:
    lists = pa.list_(pa.float64())
    return pa.RecordBatch.from_pydict({
        "fold": pa.array([k[0] for k in found], pa.int32()), "target": [k[1] for k in found],
        "n": pa.array([m.n for m in found.values()], pa.int64()),
        "mean": pa.array([m.mean.tolist() for m in found.values()], lists),
        "products": pa.array([m.products.ravel().tolist() for m in found.values()], lists)})


def _moments(row) -> Moments:
    mean = np.asarray(row.mean, np.float64)
    return Moments(int(row.n), mean, np.asarray(row.products, np.float64).reshape(len(mean), -1))


def solve_folds(moments: DataFrame, penalties: tuple[float, ...] = (0.0,)) -> pd.DataFrame:
    """Models of each fold from the folds before it: fold, target, penalty, coefficients, intercept,
    trained_on. The driver gets a matrix per fold and target."""
    found = {(r.fold, r.target): _moments(r) for r in moments.toPandas().itertuples()}
    out = []
    for target in sorted({t for _, t in found}):
        past = None
        for fold in range(max(f for f, _ in found) + 1):
            if past is not None:
                for penalty in penalties:
                    coefficients, intercept = past.solve(penalty)
                    out.append((fold, target, penalty, coefficients.tolist(), intercept, past.n))
            one = found.get((fold, target))
            past = past.merge(one) if past and one else past or one
    return pd.DataFrame(out, columns=["fold", "target", "penalty", "coefficients", "intercept",
                                      "trained_on"])


def predict_folds(folded: DataFrame, models: pd.DataFrame, features=PREDICTION_FEATURES) -> DataFrame:
    """A row per row, target and penalty that its fold has a model for: fold, target, penalty,
    truth, guess. The models, folds times targets times penalties, are broadcast."""
    spark: SparkSession = folded.sparkSession
    table = spark.createDataFrame(models, "fold int, target string, penalty double, "
                                  "coefficients array<double>, intercept double, trained_on long")
    targets = sorted(set(models["target"]))
    truth = F.create_map(*[x for t in targets for x in (F.lit(t), F.col(t).cast("double"))])
    rows = folded.select("fold", F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
                         truth.alias("truth"))
    guess = F.aggregate(F.zip_with("x", "coefficients", lambda a, b: a * b), F.col("intercept"),
                        lambda s, v: s + v)
    return rows.join(F.broadcast(table), "fold").select(
        "fold", "target", "penalty", F.element_at("truth", F.col("target")).alias("truth"),
        guess.alias("guess"))


def cross_validate(folded: DataFrame, targets: tuple[str, ...], features=PREDICTION_FEATURES,
                   penalties: tuple[float, ...] = (0.0,)) -> DataFrame:
    """Per target, penalty and fold: mse, mae, r2, direction accuracy and samples of the model of
    all folds before it. ``folded`` (``forecast.assign_folds``) is read twice; folds of under ten
    known rows are left out."""
    models = solve_folds(fold_moments(folded, targets, features), penalties)
    return fc.evaluate(predict_folds(folded, models, features), "truth", "guess", "target", "penalty",
                       "fold")


def fold_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation over the folds of each target and penalty."""
    return per_fold.groupBy("target", "penalty").agg(
        *[f(c).alias(f"{c}_{n}") for c in ("r2", "mae", "direction_accuracy")
          for f, n in ((F.avg, "mean"), (F.stddev_pop, "deviation"))],
        F.count(F.lit(1)).alias("folds"))


def forest_rates(folded: DataFrame, features: tuple[str, ...], folds: int = 5,
                 keys: tuple[str, ...] = ("symbol", "ts"), contamination: float = 0.1, **fit) -> DataFrame:
    """Anomaly rate per fold: fold, rate, cut, rows. An isolation forest of the folds before it
    flags the rows above the score that ``contamination`` of its own rows exceed. A forest is grown
    from bounded samples, so ``folds`` forests are; each scores the rows up to its fold."""
    out = None
    for i in range(1, folds + 1):
        forest = isolation.fit(folded.filter(F.col("fold") < i), features, keys, **fit)
        scored = staged(isolation.score(folded.filter(F.col("fold") <= i), forest).select(
            "fold", "isolation_score"), "scored")
        train = scored.filter(F.col("fold") < i).select(F.lit(0).alias("g"), "isolation_score")
        cut = exact_quantiles(train, ["g"], "isolation_score", [1.0 - contamination], few_keys=True) \
            .agg(F.max(F.col("quantiles")[0]).alias("cut")).scalar()
        part = scored.filter(F.col("fold") == i).withColumn("cut", cut).groupBy("fold").agg(
            F.avg((F.col("isolation_score") > F.col("cut")).cast("double")).alias("rate"),
            F.max("cut").alias("cut"), F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def rate_summary(rates: DataFrame) -> DataFrame:
    """Mean rate and its population deviation over the folds, with the checks on both."""
    return fc.anomaly_threshold_report(rates.agg(
        F.avg("rate").alias("anomaly_rate"), F.stddev_pop("rate").alias("rate_deviation")))
