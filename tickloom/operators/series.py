"""Row-ordered computation per series without one task per series.

A window partitioned by symbol alone puts a whole history into one task, and a symbol that
holds a third of the table stalls the job. Here a series is cut into blocks of bounded size,
each block also receives the rows just before it that its frames reach back to, and windows
are partitioned by (key, block). Only the copies a block owns are kept at the end, so the
result equals the window over the whole series.

Blocks come from counts per (key, time slice): a map-side combined aggregate followed by a
running sum over the small count table. Choose ``unit`` so that one key has at most some
hundred thousand rows per slice; keys are unique in time, so the feed's resolution bounds it
(daily bars: 366 per YEAR, minute bars: 1,440 per DAY, second bars: 86,400 per DAY). Where the
feed sets no bound (ticks), ``fine`` names the unit by which slices larger than a block are cut.

Positions in a series, or in a table without keys, come from range partitions instead
(``numbered``): they are cut by rows, so no key and no time span gathers in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.session import staged

_HELPERS = ("_slice", "_fine", "_from", "_at", "_total", "_own", "_upto", "_block", "_mine")


@dataclass(frozen=True)
class Series:
    """How a table is cut: key columns, time column, slice unit, rows per block.

    ``ties`` order rows of equal time; ``newest_first`` turns the order round, so that a lag
    looks into the future. ``fine`` is the unit that cuts slices of more rows than a block.
    """

    keys: tuple[str, ...] = ("symbol",)
    ts: str = "ts"
    unit: str = "DAY"
    block_rows: int = 65_536
    ties: tuple[str, ...] = ()
    newest_first: bool = False
    fine: str | None = None

    # -- layout -----------------------------------------------------------------

    def spread(self, df: DataFrame, before: int = 0, exact: bool = False,
               block_rows: int | None = None) -> DataFrame:
        """Rows with their block, plus copies for later blocks that look back ``before`` rows.

        By default whole slices are assigned and copied, which needs no row numbers. With
        ``exact`` every row gets its position in the series (``_at``) and every block owns
        exactly ``block_rows`` rows; that takes one more shuffle.
        """
        size = block_rows or self.block_rows
        keys = list(self.keys)
        sliced, counts = self._sliced(df, size)
        earlier = (Window.partitionBy(*keys).orderBy(*self._ordered("_slice"))
                   .rowsBetween(Window.unboundedPreceding, -1))
        starts = counts.withColumn("_from", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        if exact:
            within = Window.partitionBy(*keys, "_slice").orderBy(*self._ordered())
            placed = (sliced.withColumn("_at", F.row_number().over(within) - F.lit(1))
                      .join(starts.drop("_rows"), [*keys, "_slice"])
                      .withColumn("_at", F.col("_at") + F.col("_from"))
                      .withColumn("_own", F.expr(f"_at div {size}"))
                      .withColumn("_upto", F.expr(f"(_at + {before}) div {size}")))
        else:
            placed = (sliced.join(
                starts.select(*keys, "_slice", "_from",
                              F.expr(f"_from div {size}").alias("_own"),
                              F.expr(f"(_from + _rows - 1 + {before}) div {size}").alias("_upto")),
                [*keys, "_slice"]))
        if before:
            placed = placed.withColumn("_block", F.explode(F.sequence("_own", "_upto")))
        else:
            placed = placed.withColumn("_block", F.col("_own"))
        return (placed.withColumn("_mine", F.col("_block") == F.col("_own"))
                .drop("_slice", "_own", "_upto"))

    def _sliced(self, df: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
        """Rows with their time slice, and the rows of each (keys, slice)."""
        keys = list(self.keys)
        sliced = df.withColumn("_slice", F.date_trunc(self.unit, F.col(self.ts)))
        if not self.fine:
            return sliced, sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
        sliced = sliced.withColumn("_fine", F.date_trunc(self.fine, F.col(self.ts)))
        whole = Window.partitionBy(*keys, "_slice")
        parts = (sliced.groupBy(*keys, "_slice", "_fine").agg(F.count(F.lit(1)).alias("_rows"))
                 .withColumn("_cut", F.sum("_rows").over(whole) > size)
                 .withColumn("_part", F.when(F.col("_cut"), F.col("_fine"))
                             .otherwise(F.col("_slice"))))
        crowded = parts.filter("_cut").select(*keys, "_slice").distinct()
        sliced = (sliced.join(crowded.withColumn("_cut", F.lit(True)), [*keys, "_slice"], "left")
                  .withColumn("_slice", F.when(F.col("_cut"), F.col("_fine"))
                              .otherwise(F.col("_slice"))).drop("_cut", "_fine"))
        return sliced, (parts.groupBy(*keys, F.col("_part").alias("_slice"))
                        .agg(F.sum("_rows").alias("_rows")))

    def own(self, df: DataFrame) -> DataFrame:
        """Drop look-back copies and helper columns."""
        return df.filter("_mine").drop(*_HELPERS)

    # -- windows ----------------------------------------------------------------

    def _ordered(self, time: str | None = None) -> list[Column]:
        names = [time] if time else [self.ts, *self.ties]
        return [F.col(c).desc() if self.newest_first else F.col(c).asc() for c in names]

    def order(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "_block").orderBy(*self._ordered())

    def frame(self, rows: int, end: int = 0) -> WindowSpec:
        """The last ``rows`` rows up to ``end`` rows from the current one."""
        return self.order().rowsBetween(end - rows + 1, end)

    def lag(self, col: str | Column, rows: int = 1) -> Column:
        return F.lag(col, rows).over(self.order())

    def full(self, value: Column, rows: int) -> Column:
        """``value`` only where the frame of ``rows`` rows is complete."""
        return F.when(F.count(F.lit(1)).over(self.frame(rows)) == rows, value)

    def run(self, df: DataFrame, before: int, *steps) -> DataFrame:
        """Spread once, apply ``steps(df, series)``, keep own rows."""
        wide = self.spread(df, before)
        for step in steps:
            wide = step(wide, self)
        return self.own(wide)

    def numbered(self, df: DataFrame) -> DataFrame:
        """Rows with their position in the series (``_at``, from 0) and its length (``_total``);
        with no keys, in the whole table.

        The rows are dealt to range partitions of about ``block_rows`` in the series' order, and
        each partition is numbered on its own, behind the counts of those before it. They are
        staged once, as partition numbers must not change between the count and the numbering.
        ``df`` itself is read three times (count, sample of the ranges, rows): stage it first
        where it is costly.
        """
        keys = list(self.keys)
        dealt = staged(self.dealt(df), "dealt")
        counts = dealt.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
        all_, earlier = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_slice")
        starts = counts.select(
            *keys, "_slice", F.sum("_rows").over(all_).alias("_total"),
            F.coalesce(F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("_from"))
        within = Window.partitionBy(*keys, "_slice").orderBy(*self._ordered())
        return (dealt.withColumn("_at", F.row_number().over(within) - F.lit(1))
                .join(starts, [*keys, "_slice"])
                .withColumn("_at", F.col("_at") + F.col("_from")).drop("_slice", "_from"))

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows in range partitions of the series' order, ``_slice`` being the partition."""
        parts = max(1, -(-df.count() // self.block_rows))
        return (df.repartitionByRange(parts, *[F.col(k) for k in self.keys], *self._ordered())
                .withColumn("_slice", F.spark_partition_id()))


DAILY = Series(unit="YEAR")
TICKS = Series(unit="DAY", fine="MINUTE")
