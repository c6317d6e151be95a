"""Models from moments equal fits on the rows; forests equal plain walks over their nodes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import anomalies, forecast, isolation, validation

FEATURES = ("a", "b", "c", "d", "e")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(9)
    n = 600
    pdf = pd.DataFrame({"a": rng.normal(5e4, 3, n), "b": rng.normal(0, 1e-3, n), "d": 7.0, "i": range(n),
                        "fold": np.sort(rng.integers(0, 4, n))})
    pdf["c"] = 2 * pdf["a"] - 5 * pdf["b"]  # depends on the others
    pdf["e"] = rng.normal(0, 1, n)
    pdf["y1"] = 0.3 * pdf["a"] + 40 * pdf["b"] + rng.normal(0, 1, n)
    pdf["y2"] = np.where(rng.random(n) < 0.2, np.nan, pdf["e"] + rng.normal(0, 0.1, n))
    return pdf


def spark_rows(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumn("y2", F.when(~F.isnan("y2"), F.col("y2"))).repartition(9)


def plain(train, test, target, penalty):
    train = train.dropna(subset=[target])
    x, y = train[list(FEATURES)].to_numpy(), train[target].to_numpy()
    spread = x.std(0)
    used = spread > 1e-9
    z = (x[:, used] - x[:, used].mean(0)) / spread[used]
    gram = z.T @ z + penalty * np.eye(used.sum())
    w = np.linalg.pinv(gram, rcond=1e-10) @ (z.T @ (y - y.mean()))
    new = (test[list(FEATURES)].to_numpy()[:, used] - x[:, used].mean(0)) / spread[used]
    return new @ w + y.mean()


@pytest.mark.parametrize("fan_in", [2, 256])
def test_fold_models_equal_fits(spark, rows, monkeypatch, fan_in):
    monkeypatch.setattr(validation, "FAN_IN", fan_in)
    df = spark_rows(spark, rows)
    models = validation.solve_folds(validation.fold_moments(df, ("y1", "y2"), FEATURES), (0.0, 1.0, 20.0))
    assert len(models) == 3 * 2 * 3
    got = validation.predict_folds(df, models, FEATURES).toPandas()
    for (fold, target, penalty), part in got.groupby(["fold", "target", "penalty"]):
        test = rows[rows["fold"] == fold]
        want = plain(rows[rows["fold"] < fold], test, target, penalty)
        np.testing.assert_allclose(np.sort(part["guess"]), np.sort(want), rtol=1e-6, atol=1e-6)
        trained = models[(models["fold"] == fold) & (models["target"] == target)]["trained_on"]
        assert set(trained) == {rows[rows["fold"] < fold][target].notna().sum()}
    assert set(got["fold"]) == {1, 2, 3}


def test_scores_equal_the_ml_fits(spark, rows):
    df = spark_rows(spark, rows)
    scored = validation.cross_validate(df, ("y1", "y2"), ("a", "b", "e"))
    for r in scored.collect():
        model = forecast.fit_linear(df.filter(F.col("fold") < r.fold), r.target, ("a", "b", "e"))
        one = forecast.evaluate(forecast.apply_model(model, df.filter(F.col("fold") == r.fold)),
                                r.target, "linear").first()
        assert r.samples == one.samples
        np.testing.assert_allclose((r.mse, r.mae, r.r2), (one.mse, one.mae, one.r2), rtol=1e-6)
    summary = {r.target: r for r in validation.fold_summary(scored).collect()}
    mae = [r.mae for r in scored.collect() if r.target == "y1"]
    assert summary["y1"].mae_mean == pytest.approx(np.mean(mae)) and summary["y1"].folds == 3
    assert summary["y1"].mae_deviation == pytest.approx(np.std(mae))
    assert validation.solve_folds(validation.fold_moments(df.limit(0), ("y1",), FEATURES)).empty


def walk(forest, x):
    """The score of one row, node by node."""
    total = 0.0
    for _, nodes in forest.nodes.groupby("tree"):
        nodes, at = nodes.set_index("node"), 0
        while nodes.loc[at, "feature"] >= 0:
            side = "left" if x[int(nodes.loc[at, "feature"])] < nodes.loc[at, "split"] else "right"
            at = int(nodes.loc[at, side])
        total += nodes.loc[at, "length"]
    trees = forest.nodes["tree"].nunique()
    return 2.0 ** (-(total / trees) / isolation.average_depth(forest.sample))


def test_forest_scores_flags_and_rates(spark, rows):
    df = spark_rows(spark, rows).withColumn("y1", F.when(F.col("i") % 50 == 0, 1e6).otherwise(F.col("y1")))
    features = ("a", "e", "y1")
    pdf = df.toPandas().sort_values("i", ignore_index=True)
    forest = isolation.fit(df, features, ("i",), trees=12)
    scored = isolation.score(df, forest).toPandas().sort_values("i", ignore_index=True)
    some = range(0, 600, 25)
    for i in some:
        assert scored["isolation_score"][i] == pytest.approx(walk(forest, pdf.loc[i, list(features)].to_numpy()))
    flagged = isolation.flag(isolation.score(df, forest), 0.1).toPandas().sort_values("i")
    cut = np.quantile(scored["isolation_score"], 0.9)
    assert (flagged["is_anomaly_ml"].to_numpy() == (scored["isolation_score"] > cut).to_numpy()).all()
    both = spark.createDataFrame(flagged).withColumns({
        "is_anomaly_statistical": F.col("i") % 7 == 0, "anomaly_score_statistical": F.col("i") / 1000})
    for r in anomalies.combine_flags(both).collect():
        assert r.is_anomaly == (r.i % 7 == 0 or r.is_anomaly_ml)
        assert r.anomaly_score == max(r.i / 1000, r.anomaly_score_ml)

    rates = {r.fold: r for r in validation.forest_rates(df, features, 3, ("i",), trees=12).collect()}
    assert set(rates) == {1, 2, 3}
    for fold, r in rates.items():
        one = isolation.fit(df.filter(F.col("fold") < fold), features, ("i",), trees=12)
        at = {k: isolation.score(df.filter(c), one).toPandas()["isolation_score"] for k, c in (
            ("train", F.col("fold") < fold), ("test", F.col("fold") == fold))}
        cut = np.quantile(at["train"], 0.9)
        assert r.cut == pytest.approx(cut) and r.rate == pytest.approx((at["test"] > cut).mean())
        assert r.rows == len(at["test"])
    summary = validation.rate_summary(spark.createDataFrame(
        [(1, 0.1), (2, 0.5)], "fold int, rate double")).first()
    assert (summary.anomaly_rate, summary.rate_ok) == (0.3, True)
    assert summary.rate_deviation == pytest.approx(0.2) and not summary.stable


def test_forest_regressor_is_the_mean_of_its_trees(spark, rows):
    df = spark_rows(spark, rows)
    model = forecast.fit_forest(df, "y1", ("a", "b", "e"))
    got = forecast.apply_model(model, df).toPandas()
    trees = model.stages[-1].trees
    from pyspark.ml.linalg import Vectors
    for r in got.head(40).itertuples():
        each = [t.predict(Vectors.dense(r.a, r.b, r.e)) for t in trees]
        assert r.forest == pytest.approx(np.mean(each))
        assert got["y1"].min() - 1e-9 <= min(each) and max(each) <= got["y1"].max() + 1e-9
    assert np.corrcoef(got["forest"], got["y1"])[0, 1] > 0.5 and len(trees) == 10
