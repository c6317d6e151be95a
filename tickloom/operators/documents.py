"""Statistics over the point arrays of intraday and daily documents.

A document is one row, so everything is a higher-order function on its array: no explode,
no shuffle. A zero counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import fixed, ratio


def _present(field: str) -> Column:
    values = F.transform("data_points", lambda p: p[field])
    return F.filter(values, lambda v: v.isNotNull() & (v != 0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def mean(values: Column) -> Column:
    return ratio(total(values), F.size(values))


def last(values: Column, n: int, skip: int = 0) -> Column:
    """The n values before the last ``skip``, fewer if the array is shorter."""
    end = F.greatest(F.size(values) - skip, F.lit(0))
    start = F.greatest(end - n, F.lit(0))
    return F.slice(values, start + 1, end - start)


def sample_deviation(values: Column) -> Column:
    """Sample deviation in two passes over the array; 0 for fewer than two values."""
    n = F.size(values)
    # The mean is bound by a one-element transform so it is evaluated once per document.
    spread = F.transform(F.array(mean(values)), lambda m: F.aggregate(
        values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)))[0]
    return F.when(n < 2, 0.0).otherwise(F.sqrt(ratio(spread, n - 1)))


def trend_label(change: Column, limit: float = 2.0) -> Column:
    return (F.when(change > limit, "uptrend").when(change < -limit, "downtrend")
            .otherwise("sideways"))


def trend_3x3(closes: Column) -> Column:
    """First three against last three closes, for at least five."""
    start, end = mean(F.slice(closes, 1, 3)), mean(last(closes, 3))
    change = F.when(start > 0, ratio(end - start, start) * 100).otherwise(0.0)
    return F.when(F.size(closes) >= 5, trend_label(change))


def trend_5v5(closes: Column) -> Column:
    """Last five closes against the five before them, or against all earlier ones."""
    n = F.size(closes)
    recent = mean(last(closes, 5))
    older = F.when(n >= 10, mean(last(closes, 5, skip=5))).otherwise(
        total(last(closes, 5, skip=5)) / F.greatest(n - 5, F.lit(1)))
    return (F.when(n < 5, "insufficient_data").when(recent > older * 1.02, "uptrend")
            .when(recent < older * 0.98, "downtrend").otherwise("sideways"))


def intraday_stats(documents: DataFrame) -> DataFrame:
    """Price and volume statistics and the trend of each document."""
    d = documents.withColumns({"_c": _present("close"), "_v": _present("volume")})
    closes, volumes = F.col("_c"), F.col("_v")
    has = F.size(closes) > 0
    both = has & (F.size(volumes) > 0)
    low, high = F.array_min(closes), F.array_max(closes)
    return d.withColumns({
        "min_price": low, "max_price": high, "avg_price": F.when(has, fixed(mean(closes), 4)),
        "price_range": high - low,
        "data_points_count": F.when(has, F.size(closes)),
        "total_volume": F.when(both, total(volumes).cast("bigint")),
        "avg_volume": F.when(both, fixed(mean(volumes), 0)),
        "max_volume": F.when(both, F.array_max(volumes)),
        "trend": trend_3x3(closes)}).drop("_c", "_v")


def daily_doc_indicators(documents: DataFrame, least: int = 20) -> DataFrame:
    """Average of the last closes, deviation of all and the trend, given enough points."""
    d = documents.withColumn("_c", _present("close"))
    closes = F.col("_c")
    enough = F.size(closes) >= least
    return d.withColumns({
        "points": F.size("data_points"),
        "sma_20": F.when(enough, mean(last(closes, least))),
        "volatility": F.when(enough, sample_deviation(closes)),
        "trend_direction": F.when(enough, trend_5v5(closes))}).drop("_c")
