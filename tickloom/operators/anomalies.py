"""Rule-based and statistical anomaly detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import ratio
from tickloom.operators.quantiles import exact_quantiles
from tickloom.operators.series import DAILY, Series
from tickloom.session import staged

FEATURES = ("price", "volume", "price_change", "volume_change", "volatility")


def _zscores(df: DataFrame, s: Series, rows: int) -> DataFrame:
    frame = s.frame(rows)
    df = df.withColumns({"price_mean": F.avg("close").over(frame),
                         "price_stddev": F.stddev_samp("close").over(frame),
                         "volume_mean": F.avg("volume").over(frame),
                         "volume_stddev": F.stddev_samp("volume").over(frame)})
    return df.withColumns({
        "price_zscore": ratio(F.col("close") - F.col("price_mean"), F.col("price_stddev")),
        "volume_zscore": ratio(F.col("volume") - F.col("volume_mean"), F.col("volume_stddev"))})


def zscore_step(df: DataFrame, s: Series, rows: int = 101, limit: float = 3.0) -> DataFrame:
    """Anomaly type and risk from z-scores over a frame that includes the row itself."""
    def over(name: str) -> Column:
        return F.coalesce(F.abs(F.col(name)) > limit, F.lit(False))

    price, volume = F.col("price_anomaly"), F.col("volume_anomaly")
    kind = F.col("anomaly_type")
    return (_zscores(df, s, rows)
            .withColumns({"price_anomaly": over("price_zscore"),
                          "volume_anomaly": over("volume_zscore")})
            .withColumn("anomaly_type", F.when(price & volume, "PRICE_VOLUME")
                        .when(price, "PRICE").when(volume, "VOLUME").otherwise("NONE"))
            .withColumn("risk_level", F.when(kind == "PRICE_VOLUME", "HIGH")
                        .when(kind == "NONE", "LOW").otherwise("MEDIUM")))


def severity_step(df: DataFrame, s: Series, rows: int = 51) -> DataFrame:
    """Severity of the live feed: the price score outranks the volume score."""
    price, volume = F.abs(F.col("price_zscore")), F.abs(F.col("volume_zscore"))
    return (_zscores(df, s, rows)
            .withColumn("is_anomaly", F.coalesce(price > 3, F.lit(False))
                        | F.coalesce(volume > 3, F.lit(False)))
            .withColumn("anomaly_severity", F.when(price > 5, "CRITICAL").when(price > 3, "HIGH")
                        .when(volume > 3, "MEDIUM").otherwise("LOW")))


def zscore_anomalies(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return series.run(bars, 101, zscore_step)


def zscore_severity(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return series.run(bars, 51, severity_step)


def critical_anomalies(flagged: DataFrame, top: int = 5) -> DataFrame:
    """The newest high-risk rows, in a repeatable order."""
    return (flagged.filter("risk_level = 'HIGH'")
            .select("symbol", "ts", "close", "anomaly_type", "risk_level")
            .orderBy(F.col("ts").desc(), "symbol").limit(top))


# -- whole-set statistics ------------------------------------------------------------


def zscore_global(features: DataFrame, cols=FEATURES, limit: float = 3.0) -> DataFrame:
    """|z| of each feature against the whole set. Mean and deviation are scalar subqueries,
    planned as one shared aggregate. ``features`` is read twice: stage it where it is costly."""
    stats = features.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s"))
                                    .alias(c) for c in cols]).alias("st"))
    out = features.withColumn("_st", stats.scalar())
    out = out.withColumns({f"{c}_zscore": F.abs(ratio(F.col(c) - F.col(f"_st.{c}.m"),
                                                      F.col(f"_st.{c}.s"))) for c in cols})
    return out.withColumns({f"{c}_anomaly_zscore":
                            F.coalesce(F.col(f"{c}_zscore") > limit, F.lit(False))
                            for c in cols}).drop("_st")


def iqr_outliers(features: DataFrame, cols=FEATURES, width: float = 1.5) -> DataFrame:
    """Rows outside Q1 - width*IQR .. Q3 + width*IQR, per feature, quartiles interpolated.
    ``features`` is read twice: stage it where it is costly."""
    # Only the columns' own values are needed for the quartiles.
    long = features.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("f")).select("f.*")
    quartiles = exact_quantiles(long, ["feature"], "value", [0.25, 0.75], few_keys=True)
    # One row per feature name: the map has exactly len(cols) entries.
    bounds = quartiles.agg(F.map_from_entries(F.collect_list(
        F.struct("feature", "quantiles"))).alias("b"))
    out = features.withColumn("_b", bounds.scalar())

    def outside(c: str) -> Column:
        q1, q3 = F.col("_b")[c][0], F.col("_b")[c][1]
        value = F.col(c)
        return F.coalesce((value < q1 - width * (q3 - q1)) | (value > q3 + width * (q3 - q1)),
                          F.lit(False))

    return out.withColumns({f"{c}_anomaly_iqr": outside(c) for c in cols}).drop("_b")


def statistical_anomalies(features: DataFrame, cols=FEATURES) -> DataFrame:
    """Any z or IQR flag; the score is the largest |z|. The features are staged once, as means,
    quartiles and rows each read them."""
    out = iqr_outliers(zscore_global(staged(features, "features"), cols), cols)
    flag = F.lit(False)
    for c in cols:
        flag = flag | F.col(f"{c}_anomaly_zscore") | F.col(f"{c}_anomaly_iqr")
    return out.withColumns({"is_anomaly_statistical": flag,
                            "anomaly_score_statistical":
                            F.greatest(*[F.col(f"{c}_zscore") for c in cols])})


def combine_flags(both: DataFrame) -> DataFrame:
    """Statistical or forest flag, larger of both scores; both come from one table."""
    return both.withColumns({
        "is_anomaly": F.col("is_anomaly_statistical") | F.coalesce("is_anomaly_ml", F.lit(False)),
        "anomaly_score": F.greatest("anomaly_score_statistical",
                                    F.coalesce("anomaly_score_ml", F.lit(0.0))),
        "detection_method": F.lit("combined")})


def extreme_moves(priced: DataFrame, share: float = 0.95) -> DataFrame:
    """Moves above the symbol's own quantile of |change %|; high when over twice that."""
    # Read for the limits and for the rows above them; what it comes from is computed once.
    sized = staged(priced.select("symbol", "ts", "price_change_percent", F.abs("price_change_percent")
                                 .alias("_move")), "moves")
    limits = (exact_quantiles(sized, ["symbol"], "_move", [share])
              .filter("rows >= 2")
              .select("symbol", F.col("quantiles")[0].alias("threshold")))
    return (sized.join(limits, "symbol").filter("_move > threshold")
            .select("symbol", "ts", F.lit("extreme_price_movement").alias("anomaly_type"),
                    F.when(F.col("_move") > 2 * F.col("threshold"), "high").otherwise("medium")
                    .alias("severity"),
                    F.col("price_change_percent").alias("value"), "threshold",
                    F.format_string("Price change of %.2f%% exceeds threshold",
                                    "price_change_percent").alias("description")))


def extreme_rsi(indicators: DataFrame, low: float = 10.0, high: float = 90.0) -> DataFrame:
    """RSI beyond the limits, for symbols with at least two rows."""
    enough = indicators.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    under = F.col("rsi") < low
    return (indicators.filter(under | (F.col("rsi") > high))
            .join(enough, "symbol", "left_semi")
            .select("symbol", "ts", F.lit("extreme_rsi").alias("anomaly_type"),
                    F.lit("high").alias("severity"), F.col("rsi").alias("value"),
                    F.when(under, low).otherwise(high).alias("threshold"),
                    F.format_string("RSI value %.2f is extremely %s", "rsi",
                                    F.when(under, "low").otherwise("high"))
                    .alias("description")))


def event_anomalies(quotes: DataFrame, move: float = 10.0, spike: float = 5.0) -> DataFrame:
    """Coded list of what is wrong with a quote; missing metrics do not count."""
    change = F.coalesce("price_change_percent", F.lit(0.0))
    volume = F.coalesce("volume_ratio", F.lit(1.0))
    codes = F.array_compact(F.array(
        F.when(F.abs(change) > move, F.format_string("extreme_price_change_%.2f%%", change)),
        F.when(volume > spike, F.format_string("volume_spike_%.1fx", volume)),
        F.when(F.coalesce("price", F.lit(1.0)) <= 0, F.lit("invalid_price"))))
    return (quotes.withColumn("anomalies_detected", codes)
            .withColumn("anomaly_detected", F.size("anomalies_detected") > 0))


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    """Counts and rate per symbol and, with a NULL symbol, in total."""
    return (flagged.rollup("symbol")
            .agg(F.count(F.lit(1)).alias("data_points"),
                 F.count_if("is_anomaly").alias("anomalies"),
                 F.avg("anomaly_score").alias("mean_score"),
                 F.max("anomaly_score").alias("max_score"),
                 F.min("anomaly_score").alias("min_score"))
            .withColumn("anomaly_rate", ratio(F.col("anomalies"), F.col("data_points"))))


def anomaly_statistics(flagged: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Anomalies of the last days, per symbol and in total."""
    recent = flagged.filter((F.col("ts") >= as_of - F.make_dt_interval(F.lit(days))))
    return (recent.rollup("symbol")
            .agg(F.count(F.lit(1)).alias("data_points"),
                 F.count_if("is_anomaly").alias("anomalies")))


def consecutive_anomalies(scored: DataFrame, limit: float, times: int,
                          series: Series = DAILY) -> DataFrame:
    """Rows at which the score has been above ``limit`` for the last ``times`` rows.

    A run of n rows above the limit alerts from its times-th row on, so a frame of ``times``
    rows decides; a run may be arbitrarily long.
    """
    def step(df: DataFrame, s: Series) -> DataFrame:
        above = F.when(F.col("score") > limit, 1).otherwise(0)
        return df.withColumn("run", F.sum(above).over(s.frame(times)))

    return series.run(scored, times, step).filter(F.col("run") == times).drop("run")


