"""Joins, latest rows and keyed changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.numeric import fixed, percent, ratio
from tickloom.operators.series import DAILY, Series

def latest_per_symbol(df: DataFrame, ts: str = "ts", key: str = "symbol") -> DataFrame:
    """Rows at the newest time of each symbol, ties kept.

    rank() = 1 lets Spark cut each map partition to its own newest rows before the shuffle.
    """
    newest = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("_r", F.rank().over(newest)).filter("_r = 1").drop("_r")


def newest_rows(df: DataFrame, rows: int, ts: str = "ts", key: str = "symbol") -> DataFrame:
    """The newest ``rows`` rows of each symbol, whose times must differ. Spark cuts each map
    partition to that many rows of a symbol before the shuffle, however long its history is."""
    newest = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= rows).drop("_n")


def symbol_snapshot(prices: DataFrame, indicators: DataFrame) -> DataFrame:
    """Newest price row of each symbol with its newest indicators, if any."""
    return latest_per_symbol(prices).join(
        latest_per_symbol(indicators).drop("ts"), "symbol", "left")


def previous_step(df: DataFrame, s: Series, price: str = "close") -> DataFrame:
    return df.withColumns({"previous_price": s.lag(price), "previous_volume": s.lag("volume")})


def previous_quote(quotes: DataFrame, series: Series = DAILY, price: str = "close") -> DataFrame:
    return series.run(quotes, 1, lambda d, s: previous_step(d, s, price))


def quote_metrics_of(df: DataFrame, price: str = "close") -> DataFrame:
    """Change, volume ratio and volatility categories against the previous quote."""
    before = F.col("previous_price")
    has = before.isNotNull() & (before != 0)
    move = F.abs("price_change_percent")
    return (df.withColumns({
        "price_change": F.when(has, F.col(price) - before),
        "price_change_percent": F.when(has, F.when(
            before > 0, fixed(percent(F.col(price) - before, before), 4)).otherwise(0.0)),
        "volume_ratio": F.when(has & (F.col("previous_volume") != 0),
                               fixed(ratio(F.col("volume"), F.col("previous_volume")), 2))})
        .withColumns({
            "volatility_category": F.when(move > 5, "high").when(move > 2, "medium")
            .when(move.isNotNull(), "low"),
            "crypto_volatility": F.when(move > 15, "extreme").when(move > 8, "high")
            .when(move > 3, "normal").otherwise("low")}))


def quote_metrics(quotes: DataFrame, series: Series = DAILY, price: str = "close") -> DataFrame:
    return quote_metrics_of(previous_quote(quotes, series, price), price)


def quote_sma_gap(quotes: DataFrame, series: Series = DAILY, price: str = "close") -> DataFrame:
    """10 and 20 row averages and the gap to them, where history suffices."""
    def step(df: DataFrame, s: Series) -> DataFrame:
        out = df.withColumns({f"sma_{n}": s.full(F.avg(price).over(s.frame(n)), n)
                              for n in (10, 20)})
        return out.withColumns({f"price_vs_sma{n}": percent(
            F.col(price) - F.col(f"sma_{n}"), F.col(f"sma_{n}")) for n in (10, 20)})

    return series.run(quotes, 20, step)


def add_metadata(df: DataFrame, metadata: DataFrame, key: str = "symbol") -> DataFrame:
    """Dimension lookup. No hint: Spark broadcasts the side if its measured size is under
    the session's limit and joins by shuffle otherwise."""
    return df.join(metadata, key, "left")


def filter_universe(df: DataFrame, universe: DataFrame, top: int | None = None) -> DataFrame:
    """Rows of monitored symbols without the ``.TO`` listings; ``top`` keeps the first symbols of
    the listing (its ``position``, where it has one, then the symbol)."""
    order = F.min("position") if "position" in universe.columns else F.lit(0)
    wanted = universe.groupBy("symbol").agg(order.alias("_at"))
    if top is not None:
        wanted = wanted.orderBy("_at", "symbol").limit(top)
    wanted = wanted.select("symbol")
    return df.filter(~F.col("symbol").endswith(".TO")).join(wanted, "symbol", "left_semi")


SORTS = {"timestamp_desc": ("ts", False), "timestamp_asc": ("ts", True),
         "price_desc": ("price", False), "price_asc": ("price", True)}
PAGE_LIMIT = 1000


def query_prices(prices: DataFrame, symbol: str | None = None, source: str | None = None,
                 start=None, end=None, sort: str = "timestamp_desc", limit: int = 100,
                 offset: int = 0) -> DataFrame:
    """One page of filtered prices with the total and whether more follow."""
    found = prices
    if symbol:
        found = found.filter(F.col("symbol") == symbol.upper())
    if source:
        found = found.filter(F.col("source") == source)
    if start is not None:
        found = found.filter(F.col("ts") >= F.lit(start))
    if end is not None:
        found = found.filter(F.col("ts") <= F.lit(end))
    name, ascending = SORTS[sort]
    limit = min(limit, PAGE_LIMIT)
    # The total is a scalar subquery over the pruned columns, not a window over every row.
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    order = [F.col(name).asc() if ascending else F.col(name).desc(), F.col("id").asc()]
    return (found.orderBy(*order).offset(offset).limit(limit)
            .withColumn("total", total)
            .withColumn("has_more", F.col("total") > offset + limit))


def get_by_id(table: DataFrame, row_id: int) -> DataFrame:
    return table.filter(F.col("id") == row_id)


def apply_changes(target: DataFrame, changes: DataFrame, fields: list[str]) -> DataFrame:
    """Insert, update (given fields only) and delete by id; a row that breaks the price rules
    after its update keeps its old values.

    ``changes``: id, op ('insert' | 'update' | 'delete') and nullable fields; one per id.
    """
    t, c = target.alias("t"), changes.alias("c")
    merged = t.join(c, F.col("t.id") == F.col("c.id"), "full_outer")
    after = {f: F.coalesce(F.col(f"c.{f}"), F.col(f"t.{f}")) for f in fields}
    old = F.col("t.id").isNotNull()
    ok = F.coalesce((after["price"] > 0) & (after["volume"] >= 0), F.lit(False))
    op = F.col("c.op")
    out = merged.select(
        F.coalesce("t.id", "c.id").alias("id"), op.alias("_op"), old.alias("_old"),
        ok.alias("_ok"),
        *[F.when(old & ~ok, F.col(f"t.{f}")).when(op == "insert", F.when(
            old, F.col(f"t.{f}")).otherwise(F.col(f"c.{f}"))).otherwise(v).alias(f)
          for f, v in after.items()])
    keep = (F.col("_old") & ~F.coalesce(F.col("_op") == "delete", F.lit(False))) | (
        ~F.col("_old") & (F.col("_op") == "insert") & F.col("_ok"))
    return out.filter(keep).drop("_op", "_old", "_ok")
