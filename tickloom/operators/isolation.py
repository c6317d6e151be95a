"""Isolation forest (Liu, Ting and Zhou 2008) on Spark.

Each tree is grown in its own task from at most ``sample`` rows, so no task sees more. The
forest is a table of at most trees x (2 x sample - 1) nodes, a size fixed by its parameters,
and that alone is sent to the executors for scoring. Trees compare one feature with a value,
so features need no scaling.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tickloom.operators.quantiles import exact_quantiles
from tickloom.session import staged

NODES = ("tree int, node int, feature int, split double, left int, right int, length double, "
         "size int")


def average_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def draw_samples(df: DataFrame, features: tuple[str, ...], keys: tuple[str, ...], trees: int,
                 sample: int, seed: int) -> DataFrame:
    """(tree, features) rows, ``sample`` at most per tree.

    A hash of row key and tree decides, so the draw does not depend on partitioning and a
    lost task redraws the same rows. Twice the wanted number is let through on average and
    cut to the smallest hashes.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    scale = 1 << 30
    limit = F.least(F.lit(2.0 * sample) / total, F.lit(1.0)) * scale

    def lot(t: Column) -> Column:
        return F.pmod(F.xxhash64(*keys, t, F.lit(seed)), F.lit(scale))

    hits = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: lot(t) < F.col("_limit"))
    drawn = (df.withColumn("_limit", limit)
             .select(*keys, *features, F.explode(hits).alias("tree")))
    order = Window.partitionBy("tree").orderBy(lot(F.col("tree")), *keys)
    return (drawn.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample)
            .select("tree", "rank", *[F.col(c).cast("double").alias(c) for c in features]))


def _grow(features: tuple[str, ...], seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("rank")[list(features)].to_numpy()
        rng = np.random.default_rng([seed, tree])
        deepest = int(np.ceil(np.log2(max(len(x), 2))))
        nodes: list[list] = []
        waiting = [(np.arange(len(x)), 0, -1, "")]
        while waiting:
            rows, depth, parent, side = waiting.pop()
            here = len(nodes)
            if parent >= 0:
                nodes[parent][4 if side == "l" else 5] = here
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= deepest or len(rows) <= 1 or usable.size == 0:
                nodes.append([tree, here, -1, 0.0, -1, -1, depth + average_depth(len(rows)),
                              len(rows)])
                continue
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            below = x[rows, f] < cut
            if below.all() or not below.any():  # the cut fell on an end point
                below = x[rows, f] <= low[f]
                cut = float(np.nextafter(low[f], np.inf))
            nodes.append([tree, here, f, cut, -1, -1, 0.0, len(rows)])
            waiting.append((rows[below], depth + 1, here, "l"))
            waiting.append((rows[~below], depth + 1, here, "r"))
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")])

    return grow


@dataclass(frozen=True)
class Forest:
    """Node table with the number of rows per tree and the feature order."""

    nodes: pd.DataFrame
    features: tuple[str, ...]
    sample: int

    def save(self, spark: SparkSession, path: str) -> None:
        (spark.createDataFrame(self.nodes, NODES)
         .withColumns({"features": F.lit(",".join(self.features)), "sample": F.lit(self.sample)})
         .coalesce(1).write.mode("overwrite").parquet(path))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forest":
        nodes = spark.read.parquet(path).orderBy("tree", "node").toPandas()
        return Forest(nodes.drop(columns=["features", "sample"]),
                      tuple(nodes["features"].iloc[0].split(",")), int(nodes["sample"].iloc[0]))


def fit(df: DataFrame, features: tuple[str, ...], keys: tuple[str, ...] = ("symbol", "ts"),
        trees: int = 100, sample: int = 256, seed: int = 42) -> Forest:
    drawn = draw_samples(df, features, keys, trees, sample, seed)
    nodes = drawn.groupBy("tree").applyInPandas(_grow(features, seed), NODES)
    table = nodes.toPandas().sort_values(["tree", "node"], ignore_index=True)
    rows = int(table[table["node"] == 0]["size"].max())
    return Forest(table, tuple(features), rows)


def score(df: DataFrame, forest: Forest) -> DataFrame:
    """``isolation_score`` in (0, 1); larger is more unusual."""
    t = forest.nodes
    starts = t.groupby("tree").size().cumsum().shift(fill_value=0)
    base = t["tree"].map(starts).to_numpy()
    arrays = (t["feature"].to_numpy(), t["split"].to_numpy(),
              np.where(t["left"] < 0, 0, t["left"] + base),
              np.where(t["right"] < 0, 0, t["right"] + base),
              t["length"].to_numpy(), starts.to_numpy())
    shared = df.sparkSession.sparkContext.broadcast(arrays)
    norm = average_depth(forest.sample)

    @F.pandas_udf("double")
    def isolation(cols: pd.DataFrame) -> pd.Series:
        feature, split, left, right, length, roots = shared.value
        x = cols.to_numpy(dtype="float64")
        each = np.arange(len(x))
        total = np.zeros(len(x))
        for root in roots:
            at = np.full(len(x), root)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                below = x[each, np.where(inner, f, 0)] < split[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += length[at]
        return pd.Series(np.power(2.0, -(total / len(roots)) / norm))

    packed = F.struct(*[F.col(c).cast("double").alias(c) for c in forest.features])
    return df.withColumn("isolation_score", isolation(packed))


def flag(scored: DataFrame, contamination: float = 0.1) -> DataFrame:
    """Flag the given share of rows: the score minus its exact cut is the anomaly score. The
    scores are staged, so that the forest runs once."""
    scored = staged(scored, "scores")
    one = scored.select(F.lit(0).alias("g"), "isolation_score")
    cut = (exact_quantiles(one, ["g"], "isolation_score", [1.0 - contamination], few_keys=True)
           .agg(F.max(F.col("quantiles")[0]).alias("cut")).scalar())
    return scored.withColumn("anomaly_score_ml", F.col("isolation_score") - cut).withColumn(
        "is_anomaly_ml", F.col("anomaly_score_ml") > 0)
