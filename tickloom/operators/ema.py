"""Exponential averages by blocks that hand on what they have summed up.

e(t) = (1-a) e(t-1) + a x(t) unrolls to a sum of a x(j) d^(t-j) with d = 1-a. Inside a block the
terms are scaled by d^-i, i counted from the block's first row, which makes it one running SUM
that Spark evaluates in a single pass inside the JVM; block length keeps the scale factors inside
the range of a double.

What came before a block is one number per average, its value at the end of the block before: the
carry. It decays with d^i over the block's rows, so no row of another block is looked back to.
Each block's own sum at its end is an aggregate over its rows, combined before the shuffle; the
carry into a block folds the sums of those before it, each decayed by d^(block length), as far back
as they change a double (d^rows > 1e-30). Blocks own exactly ``block_rows`` rows, so that is the
sequential recursion to rounding, for any period and any block size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.numeric import ratio
from tickloom.operators.series import Series
from tickloom.session import staged

_REACH = 69.1      # -ln(1e-30)
_RANGE = 580.0     # exponent budget for a block's rows
#: Blocks of a series that one window group folds.
RUN = 4096


def _alpha(period: int) -> float:
    if period < 2:
        raise ValueError("an exponential average needs a period of at least 2")
    return 2.0 / (period + 1)


def _rate(period: int) -> float:
    return -math.log1p(-_alpha(period))


def reach(period: int) -> int:
    """Rows after which an older term no longer changes a double."""
    return math.ceil(_REACH / _rate(period))


def block_limit(*periods: int) -> int:
    """Longest block whose scale factors fit a double for all periods."""
    return int(_RANGE / max(_rate(p) for p in periods))


@dataclass(frozen=True)
class Averages:
    """Averages of ``col`` that a spread table has carries for; ``adjusted``: weighted means of all
    values so far; else the recursion, seeded with the first value. ``macd``: (fast, slow, signal),
    where the signal is the average of the fast one less the slow one; not with ``adjusted``."""

    col: str
    periods: tuple[int, ...] = ()
    adjusted: bool = False
    macd: tuple[int, int, int] | None = None

    def all_periods(self) -> tuple[int, ...]:
        return tuple(dict.fromkeys((*self.periods, *(self.macd or ()))))


@dataclass(frozen=True)
class Blocks(Series):
    """A series cut for averages; ``column`` names the carry of an average in the spread table."""

    carried: tuple[str, ...] = field(default=())

    def own(self, df: DataFrame) -> DataFrame:
        return super().own(df).drop(*self.carried)


def carry_name(col: str, period: int, adjusted: bool = False) -> str:
    return f"_carry_{col}_{period}" + ("_adjusted" if adjusted else "")


def spread_for(df: DataFrame, series: Series, averages: Averages, before: int = 1
               ) -> tuple[DataFrame, Blocks]:
    """Spread with carries for ``averages``; ``before`` rows are looked back to by other frames
    (one at least, so that the row before a block has its averages as well). The spread is staged:
    it is read for the blocks' sums and again for the rows."""
    cut = min(block_limit(*averages.all_periods()), series.block_rows)
    sized = replace(series, block_rows=cut)
    wide = staged(sized.spread(df, max(before, 1), exact=True), "spread")
    return with_carries(wide, sized, averages)


def with_carries(wide: DataFrame, series: Series, averages: Averages) -> tuple[DataFrame, Blocks]:
    """A spread table with the carries of ``averages``, which add to those it has."""
    keys, size, col = list(series.keys), series.block_rows, averages.col
    back = (size - 1 - _place(series)).cast("double")  # rows to the block's end
    names = {carry_name(col, p, averages.adjusted): p for p in averages.periods}
    names |= {carry_name(col, p): p for p in (averages.macd or ())[:2]}
    sums = {name: F.sum(_weighted(col, p, averages.adjusted) * F.pow(F.lit(_decay(p)), back))
            for name, p in names.items()}
    if averages.macd:
        fast, slow, signal = averages.macd
        for p in (fast, slow):
            # The rows' part in the signal at the block's end, by the average of ``p`` alone.
            sums[f"_part_{p}"] = F.sum(_weighted(col, p) * _chained(p, signal, back))
    blocks = wide.filter("_mine").groupBy(*keys, "_block").agg(*[x.alias(c) for c, x in sums.items()])
    blocks = staged(blocks, "block_sums")
    for name, p in names.items():
        blocks = _folded(blocks, series, name, p)
    if averages.macd:
        fast, slow, signal = averages.macd
        name = carry_name(f"{col}_macd", signal)
        parts = {p: F.coalesce(f"_part_{p}", F.lit(0.0)) + F.coalesce(carry_name(col, p), F.lit(0.0))
                 * _decay(p) * _chained(p, signal, F.lit(float(size - 1))) for p in (fast, slow)}
        blocks = _folded(blocks.withColumn(name, parts[fast] - parts[slow]), series, name, signal)
        names[name] = signal
    carries = blocks.select(*keys, "_block", *names)
    carried = (*getattr(series, "carried", ()), *names)
    cut = Blocks(**{f: getattr(series, f) for f in Series.__dataclass_fields__}, carried=carried)
    return wide.join(carries, [*keys, "_block"], "left"), cut


def _decay(period: int) -> float:
    return math.exp(-_rate(period))


def _place(series: Series) -> Column:
    """A row's place in its block; negative for rows that are looked back to."""
    return F.col("_at") - F.col("_block") * series.block_rows


def _weighted(col: str, period: int, adjusted: bool = False) -> Column:
    if adjusted:
        return F.col(col)
    return F.when(F.col("_at") == 0, F.lit(1.0)).otherwise(F.lit(_alpha(period))) * F.col(col)


def _chained(period: int, signal: int, rows: Column) -> Column:
    """Weight in the signal of a term that entered the average of ``period`` ``rows`` rows ago: the
    sum over r of a_signal d_signal^(rows - r) d^r."""
    d, g = _decay(period), _decay(signal)
    if d == g:
        total = (rows + 1) * F.pow(F.lit(d), rows)
    else:
        total = (F.pow(F.lit(d), rows + 1) - F.pow(F.lit(g), rows + 1)) / (d - g)
    return total * _alpha(signal)


def _folded(blocks: DataFrame, series: Series, name: str, period: int) -> DataFrame:
    """``name``, a block's own sum, replaced by the carry into the block.

    Window groups are runs of blocks and the blocks before them that still count, so a series of
    any length is folded by many tasks.
    """
    keys, decay = list(series.keys), math.exp(-_rate(period) * series.block_rows)
    count = math.ceil(_REACH / (_rate(period) * series.block_rows))  # blocks that still count
    run = max(RUN, count)
    copies = blocks.withColumn("_run", F.explode(F.array_distinct(F.array(
        F.expr(f"_block div {run}"), F.expr(f"(_block + {count}) div {run}")))))
    earlier = Window.partitionBy(*keys, "_run").orderBy("_block")
    if count == 1:
        carry = F.lag(name).over(earlier)
    else:
        before = F.collect_list(F.coalesce(name, F.lit(0.0))).over(earlier.rowsBetween(-count, -1))
        known = F.count(name).over(earlier.rowsBetween(-count, -1))
        carry = F.when(known > 0, F.aggregate(before, F.lit(0.0), lambda e, s: e * decay + s))
    own = F.col("_run") == F.expr(f"_block div {run}")
    return copies.withColumn(name, carry).filter(own).drop("_run")


def _decayed_sum(series: Series, value: Column, period: int, carry: str) -> Column:
    """The carry, decayed, and the block's rows so far. On the row before a block it is the carry."""
    place = _place(series).cast("double")
    running = series.order().rowsBetween(Window.unboundedPreceding, 0)
    scaled = F.when(F.col("_mine"), value * F.pow(F.lit(_decay(period)), -place))
    own = F.sum(scaled).over(running) * F.pow(F.lit(_decay(period)), place)
    past = F.col(carry) * F.pow(F.lit(_decay(period)), place + 1)
    return F.when(own.isNotNull() | past.isNotNull(),
                  F.coalesce(own, F.lit(0.0)) + F.coalesce(past, F.lit(0.0)))


def ema(series: Blocks, col: str, period: int, carry: str | None = None) -> Column:
    """Recursive form, seeded with the first value of the series."""
    return _decayed_sum(series, _weighted(col, period), period, carry or carry_name(col, period))


def macd_signal(series: Blocks, line: str, col: str, period: int) -> Column:
    """The average of the MACD line in column ``line``, which is made of averages of ``col``."""
    return ema(series, line, period, carry_name(f"{col}_macd", period))


def ema_adjusted(series: Blocks, col: str, period: int) -> Column:
    """Weighted mean of all values so far, weights d^age."""
    total = (1.0 - F.pow(F.lit(_decay(period)), (F.col("_at") + 1).cast("double"))) / _alpha(period)
    summed = _decayed_sum(series, F.col(col), period, carry_name(col, period, True))
    return ratio(summed, total)


def add_ema(df: DataFrame, series: Series, col: str = "close",
            periods: tuple[int, ...] = (12, 26, 50)) -> DataFrame:
    """ema_<p> columns for a plain (not yet spread) table."""
    wide, cut = spread_for(df, series, Averages(col, tuple(periods)))
    return cut.own(wide.withColumns({f"ema_{p}": ema(cut, col, p) for p in periods}))


def add_ema_adjusted(df: DataFrame, series: Series, col: str = "close",
                     periods: tuple[int, ...] = (12, 26)) -> DataFrame:
    wide, cut = spread_for(df, series, Averages(col, tuple(periods), adjusted=True))
    return cut.own(wide.withColumns({f"ema_{p}": ema_adjusted(cut, col, p) for p in periods}))
