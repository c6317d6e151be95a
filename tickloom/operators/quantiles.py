"""Exact interpolated quantiles without holding a group in memory.

``percentile`` keeps every distinct value of a group in one buffer and so fails on a hot group.
Here the rank is selected by radix, from coarse to fine. A histogram of the values' leading bits
(sign, exponent and the first bits behind it, as the floor of a logarithm, which keeps their order)
says in one pass, combined before the shuffle, which bin of each group holds the wanted rank, how
many rows lie below it, and its least and largest value. The second pass counts the values of that
bin only; of these the range of equal widths that holds the rank is picked, and ordered.

A histogram has at most BINS_1 bins a group, whatever its size, and nothing is estimated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.session import staged

#: Bins of a power of two in the first step, and of the wanted bin's range in the second.
PER_OCTAVE, BINS = 256, 4096
#: Powers of two that a double reaches, from the least above zero.
_OCTAVES = 2100
BINS_1 = 2 * (_OCTAVES * PER_OCTAVE + 2) + 1


def leading_bits(v: Column) -> Column:
    """A number that grows with the value, the same for values whose leading bits are. Infinities
    and NaN (above all else, as Spark orders them) have bins of their own."""
    last = _OCTAVES * PER_OCTAVE
    size = F.abs(v)
    finite = (size < float("inf")) & ~F.isnan(v)
    bin_ = F.floor(F.log2(F.when(finite & (size > 0), size)) * PER_OCTAVE) + 1075 * PER_OCTAVE
    return (F.when(F.isnan(v), last + 1).when(v == float("inf"), last)
            .when(v == float("-inf"), -last).when(v == 0, 0)
            .when(v > 0, bin_).otherwise(-bin_)).cast("int")


def _bracket(data: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Per key and probability: rows, rank, the bounds of the bins that hold it, rows below."""
    hist = staged(data.groupBy(*keys, leading_bits(F.col("v")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most")), "histogram")
    group, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = hist.withColumns({"rows": F.sum("n").over(group),
                               "below": F.coalesce(F.sum("n").over(before), F.lit(0))})
    marks = placed.withColumn("m", F.explode(F.array(*[F.struct(
        F.lit(i).alias("i"), ((F.col("rows") - 1) * F.lit(float(p))).alias("rank"))
        for i, p in enumerate(probs)]))).select("*", "m.*")

    def holds(rank: Column) -> Column:
        return (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))

    first, last = holds(F.floor("rank")), holds(F.ceil("rank"))
    return marks.filter(first | last).groupBy(*keys, "rows", "i", "rank").agg(
        F.min("least").alias("low"), F.max("most").alias("high"), F.min("below").alias("below"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    few_keys: bool = False) -> DataFrame:
    """keys, rows, quantiles array; linear interpolation between neighbouring ranks. Nulls are not
    counted. ``df`` is read once; its keys and values are staged and read twice.

    Set ``few_keys`` only where the number of keys is fixed by the caller (such as a list of
    feature names): the bounds are then broadcast. Otherwise Spark picks the join by size.
    """
    data = staged(df.select(*keys, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL"),
                  "values")
    marks = _bracket(data, keys, probs)
    if few_keys:
        marks = F.broadcast(marks)
    counted = (data.join(marks, keys).filter("v >= low AND v <= high")
               .groupBy(*keys, "rows", "i", "rank", "low", "high", "below", F.col("v").alias("x"))
               .agg(F.count(F.lit(1)).alias("n")))
    counted = staged(counted, "counted")
    # No task orders a whole bin: which of BINS equal widths holds the rank, then which value in it.
    width = F.col("high") - F.col("low")
    slot = F.when((width > 0) & (width < float("inf")), F.least(
        F.floor((F.col("x") - F.col("low")) / width * BINS), F.lit(BINS - 1))) \
        .when(F.col("x") > F.col("low"), 1).otherwise(0).cast("int")
    counted = counted.withColumn("bin", slot)
    group = [*keys, "i"]
    before = (Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = (counted.groupBy(*group, "rank", "below", "bin").agg(F.sum("n").alias("n"))
            .withColumn("base", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0))))
    low_rank, high_rank = F.floor("rank"), F.ceil("rank")

    def inside_bin(rank: Column) -> Column:
        return (F.col("base") <= rank) & (rank < F.col("base") + F.col("n"))

    wanted = bins.filter(inside_bin(low_rank) | inside_bin(high_rank)).select(*group, "bin", "base")
    upto = (Window.partitionBy(*group, "bin").orderBy("x")
            .rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.join(wanted, [*group, "bin"]).withColumn(
        "upto", F.col("base") + F.sum("n").over(upto))

    def at(rank: Column) -> Column:
        hit = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.min(F.when(hit, F.col("x")))

    picked = ranked.groupBy(*group, "rows", "rank").agg(at(low_rank).alias("a"), at(high_rank).alias("b"))
    part = F.col("rank") - low_rank
    point = F.when(part == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * part)
    return (picked.groupBy(*keys, "rows")
            .agg(F.sort_array(F.collect_list(F.struct("i", point.alias("q")))).alias("qs"))
            .select(*keys, "rows", F.col("qs.q").alias("quantiles")))
