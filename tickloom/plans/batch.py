"""The batch job: clean, indicators, anomalies, summary, from one spread of the bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.operators import anomalies, indicators, lookups, quality, summaries
from tickloom.operators.series import DAILY, Series
from tickloom.session import staged
from tickloom.sinks.tables import write_processed


#: Rows that the widest frame of ``flag`` reaches back to.
LOOK_BACK = 101


def staged_clean(raw: DataFrame, folder: str) -> DataFrame:
    """Clean bars as a written table in shared storage.

    The steps after it read the bars twice, once narrowly to count rows per slice; parsing
    and removing repeats happen once, and a lost executor costs no recomputation of them.
    """
    path = write_processed(quality.clean_and_validate(raw), folder, "clean_bars")
    return raw.sparkSession.read.parquet(path)


def flag(clean: DataFrame, series: Series = DAILY) -> DataFrame:
    """Indicators and anomaly flags of clean bars. Both steps share the same shuffle."""
    return series.run(clean, LOOK_BACK, indicators.batch_step, anomalies.zscore_step)


def market_report(raw: DataFrame, folder: str | None = None, series: Series = DAILY) -> DataFrame:
    """Market summary. It looks at each symbol's newest row only, so the indicators are computed
    over the rows that this one's frames reach back to; they are staged (in ``folder``, else in
    the session's shared folder), as their series are counted and read."""
    recent = lookups.newest_rows(quality.clean_and_validate(raw), LOOK_BACK + 1)
    return summaries.market_summary(flag(staged(recent, "recent_bars", folder), series))


def warehouse_indicators(all_indicators: DataFrame) -> DataFrame:
    """The columns the warehouse table keeps, under its names."""
    return all_indicators.select(
        "symbol", "ts", "rsi", F.col("macd_line").alias("macd"),
        F.col("signal_line").alias("macd_signal"), "macd_histogram", "sma_20", "sma_50")


def run(raw: DataFrame, output: str, series: Series = DAILY) -> None:
    """Write both result tables. Each stage is written once and the next one reads it."""
    flagged = write_processed(flag(staged_clean(raw, output), series), output,
                              "financial_indicators")
    stored = raw.sparkSession.read.parquet(flagged)
    write_processed(summaries.market_summary(stored), output, "market_summary")
