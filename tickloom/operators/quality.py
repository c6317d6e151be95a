"""Cleaning, validation rules, enrichment and routing. All rules are row-local columns;
only removing repeats needs a shuffle, and that aggregate combines copies before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.functions.numeric import number, percent, ratio
from tickloom.functions.times import parse_time, parse_time_loose
from tickloom.operators import documents

# Limits of the record rules.
MIN_PRICE, MAX_PRICE, MIN_VOLUME = 0.01, 1_000_000.0, 0
MIN_RSI, MAX_RSI = 0.0, 100.0
SYMBOL_PATTERN = "^[A-Z]{1,5}$"
MAX_MOVE_PERCENT = 50.0
# What a record of an unknown type is given.
GENERIC = {"processed_as": "generic_financial_data",
           "processing_note": "Processed with minimal transformations"}
API_FIELDS = ("symbol", "timestamp", "price", "volume", "open_price", "high_price", "low_price",
              "close_price", "source")
MAX_LOT = 1000


def keep_one(df: DataFrame, keys: list[str], prefer: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by the other columns.

    min(struct) merges copies on the map side, so a key with very many copies does not gather
    in one task, and the choice does not depend on the order of arrival.
    """
    rest = [c for c in df.columns if c not in keys]
    first = [c for c in (prefer or []) if c in rest]
    ordered = first + [c for c in rest if c not in first]
    return (df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
            .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                      for c in df.columns]))


def bar_rules() -> Column:
    """Predicates every bar must meet; usable on streams."""
    return (F.col("symbol").isNotNull() & (F.col("close") > 0) & (F.col("volume") >= 0)
            & (F.col("high") >= F.col("low"))
            & F.col("close").between(F.col("low"), F.col("high")))


def clean_and_validate(raw: DataFrame) -> DataFrame:
    """Typed time, bar rules, one row per (symbol, ts)."""
    typed = raw.withColumn("ts", parse_time(F.col("timestamp")))
    good = typed.filter(F.col("ts").isNotNull() & bar_rules()).select(
        "symbol", "ts", "open", "high", "low", "close", "volume", "source", "market")
    return keep_one(good, ["symbol", "ts"])


def validate_stream(bars: DataFrame) -> DataFrame:
    return bars.filter(bar_rules())


# -- record rules with reject reasons ------------------------------------------------


def _reasons(*rules: tuple[str, Column]) -> Column:
    """Names of the rules that do not hold (NULL counts as not holding)."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                                     for name, ok in rules]))


def _dedup_text(records: DataFrame) -> DataFrame:
    """One row per raw (symbol, timestamp) with the number of copies."""
    keys = ["symbol", "timestamp"]
    rest = [c for c in records.columns if c not in keys]
    return (records.groupBy(*keys)
            .agg(F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("copies"))
            .select(*keys, "_row.*", "copies"))


def _missing(cols: list[str]) -> Column:
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def check_price_records(records: DataFrame, as_of: Column) -> DataFrame:
    """Typed price records with ``reasons`` (empty when valid); input columns are text."""
    one = _dedup_text(records).withColumn("missing", _missing(records.columns))
    prices = ("open", "high", "low", "close")
    typed = one.withColumns({
        "symbol": F.trim(F.upper("symbol")), "ts": parse_time_loose(F.col("timestamp")),
        **{p: number(F.col(p)) for p in prices},
        "volume": number(F.col("volume"), "double").cast("bigint"),
        "source": F.coalesce(F.trim("source"), F.lit("unknown"))})
    in_range = [(f"{p}_range", F.col(p).between(MIN_PRICE, MAX_PRICE)) for p in prices]
    low, high = F.col("low"), F.col("high")
    return typed.withColumn("reasons", _reasons(
        ("symbol", F.col("symbol").rlike(SYMBOL_PATTERN)),
        ("timestamp", F.col("ts") <= as_of + F.expr("INTERVAL 1 DAY")),
        *in_range,
        ("open_between", F.col("open").between(low, high)),
        ("close_between", F.col("close").between(low, high)),
        ("volume", F.col("volume") >= MIN_VOLUME)))


def check_indicator_records(records: DataFrame, as_of: Column) -> DataFrame:
    one = _dedup_text(records).withColumn("missing", _missing(records.columns))
    numbers = ("rsi", "macd", "macd_signal", "macd_histogram", "sma_20", "sma_50")
    typed = one.withColumns({"symbol": F.trim(F.upper("symbol")),
                             "ts": parse_time_loose(F.col("timestamp")),
                             **{c: number(F.col(c)) for c in numbers}})
    return typed.withColumn("reasons", _reasons(
        ("symbol", F.col("symbol").rlike(SYMBOL_PATTERN)),
        ("timestamp", F.col("ts") <= as_of + F.expr("INTERVAL 1 DAY")),
        ("rsi", F.col("rsi").between(MIN_RSI, MAX_RSI)),
        *[(c, F.col(c).isNotNull()) for c in ("macd", "macd_signal", "macd_histogram")],
        ("sma_20", F.col("sma_20") > 0), ("sma_50", F.col("sma_50") > 0)))


def valid_records(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") == 0).drop("reasons", "copies", "missing", "timestamp")


def rejected_records(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") > 0)


def validation_stats(checked: DataFrame) -> DataFrame:
    """Counts of one validation run, one row."""
    ok = F.size("reasons") == 0
    return checked.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.count_if(ok).alias("valid_records"), F.count_if(~ok).alias("invalid_records"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_records"),
        F.coalesce(F.sum("missing").cast("bigint"), F.lit(0)).alias("missing_values"))


# -- quotes, documents, events -------------------------------------------------------


def validate_quote(quotes: DataFrame) -> DataFrame:
    present = F.lit(True)
    for c in ("symbol", "price", "volume", "timestamp"):
        present = present & F.col(c).isNotNull()
    return quotes.filter(present & (F.col("price") > 0) & (F.col("volume") >= 0))


def validate_document(documents: DataFrame) -> DataFrame:
    return documents.filter((F.length("symbol") > 0) & (F.size("data_points") > 0))


def event_is_valid() -> Column:
    return F.coalesce(F.col("timestamp").isNotNull() & F.length("symbol").between(1, 10),
                      F.lit(False))


def validate_event(events: DataFrame) -> DataFrame:
    return events.filter(event_is_valid())


def api_error() -> Column:
    """First rule an incoming record breaks, NULL when it is fine."""
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in API_FIELDS]))
    price, volume = number(F.col("price")), number(F.col("volume"))
    return F.coalesce(
        F.when(F.size(absent) > 0, F.concat(F.lit("missing field: "), absent[0])),
        F.when(~F.coalesce(price > 0, F.lit(False)), F.lit("price must be positive")),
        F.when(~F.coalesce(volume >= 0, F.lit(False)), F.lit("volume must not be negative")),
        F.when(number(F.col("high_price")) < number(F.col("low_price")),
               F.lit("high must not be below low")))


def validate_api_batch(records: DataFrame, lot: str = "lot", index: str = "idx") -> DataFrame:
    """Each record with its error; a lot over the size limit is refused as a whole."""
    sizes = records.groupBy(lot).agg(F.count(F.lit(1)).alias("lot_size"))
    sized = records.join(sizes, lot)
    return sized.withColumn("error", F.when(F.col("lot_size") > MAX_LOT, "lot too large")
                            .otherwise(api_error()))


def api_batch_report(checked: DataFrame, lot: str = "lot") -> DataFrame:
    return checked.groupBy(lot).agg(
        F.count_if(F.col("error").isNull()).alias("created"),
        F.count_if(F.col("error").isNotNull()).alias("errors"))


# -- enrichment ----------------------------------------------------------------------


def enrich_price(bars: DataFrame) -> DataFrame:
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return bars.withColumns({
        "price_change": c - o, "price_change_percent": percent(c - o, o),
        "price_range": h - low, "price_range_percent": percent(h - low, o),
        "typical_price": (h + low + c) / 3})


def enrich_indicators(indicators: DataFrame) -> DataFrame:
    rsi = F.col("rsi")
    return indicators.withColumns({
        "rsi_signal": F.when(rsi < 30, "oversold").when(rsi > 70, "overbought")
        .otherwise("neutral"),
        "macd_signal_type": F.when(F.col("macd_histogram") > 0, "bullish").otherwise("bearish"),
        "sma_trend": F.when(F.col("sma_20") > F.col("sma_50"), "bullish").otherwise("bearish")})


def indicators_long(wide: DataFrame, keys: tuple[str, ...] = ("symbol", "ts")) -> DataFrame:
    """One row per indicator, with its period."""
    # Indicator column, its name and its period.
    kinds = {"rsi": ("RSI", 14), "macd": ("MACD", 26), "macd_signal": ("MACD_SIGNAL", 9),
             "macd_histogram": ("MACD_HISTOGRAM", 9), "sma_20": ("SMA", 20), "sma_50": ("SMA", 50)}
    rows = F.array(*[F.struct(F.lit(kind).alias("indicator_type"), F.col(c).alias("value"),
                              F.lit(period).alias("period"))
                     for c, (kind, period) in kinds.items()])
    return wide.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def add_lineage(df: DataFrame, as_of: Column, stream: str, version: str = "1.0",
                environment: str = "dev") -> DataFrame:
    """Where and when a row came in. The processing id differs between runs."""
    return df.withColumn("meta", F.struct(
        as_of.alias("ingested_at"), F.lit(stream).alias("stream_type"),
        F.lit(version).alias("version"), F.lit(environment).alias("environment"),
        F.uuid().alias("processing_id")))


# -- enriched envelopes --------------------------------------------------------------


def change_percent(text: Column) -> Column:
    return F.coalesce(number(F.regexp_replace(text, "%", "")), F.lit(0.0))


def quote_enrich(quotes: DataFrame) -> DataFrame:
    """Previous close, volatility and tier of a quote; derived values need a positive price."""
    price, change = F.col("price"), F.col("change")
    ok = price > 0
    tier = (F.when(price < 10, "small_cap_indicator").when(price < 100, "mid_cap_indicator")
            .otherwise("large_cap_indicator"))
    return quotes.withColumns({
        "symbol": F.upper("symbol"),
        "previous_close": F.when(ok, price - change),
        "price_volatility_indicator": F.when(ok, F.abs(ratio(change, price)) * 100),
        "volume_normalized": F.when(ok, F.col("volume") / 1000000),
        "market_cap_tier": F.when(ok, tier)})


def quote_flags(quotes: DataFrame) -> DataFrame:
    price, volume = F.col("price"), F.col("volume")
    return quotes.withColumn("anomaly_flags", F.array_compact(F.array(
        F.when(price <= 0, F.lit("negative_or_zero_price")),
        F.when(volume < 0, F.lit("negative_volume")),
        F.when(F.abs("change_percent") > MAX_MOVE_PERCENT, F.lit("extreme_price_movement")),
        F.when(volume == 0, F.lit("zero_volume")))))


def route_by_type(events: DataFrame) -> DataFrame:
    """Branch per data_type, decided in one pass over the table.

    Each row fills the struct of its branch: ``quote``, ``intraday`` or ``daily`` (for events with
    ``interval`` and ``data_points``), or ``generic``. Statistics are expressions over a row's own
    points, so nothing is exploded or shuffled.
    """
    kind = F.coalesce("data_type", F.lit("unknown"))
    known = kind.isin("real_time_quote", "intraday", "crypto_quote", "daily")
    price = F.col("price")
    if "data_points" in events.columns:
        events = _point_branches(events, kind)
    return events.withColumns({
        "generic": F.when(~known, F.struct(
            F.upper("symbol").alias("symbol"), *[F.lit(v).alias(k) for k, v in GENERIC.items()])),
        "branch": F.when(known, kind).otherwise("generic"),
        "quote": F.when(kind.isin("real_time_quote", "crypto_quote"),
                        F.struct(F.upper("symbol").alias("symbol"), price.alias("price"),
                                 F.col("volume").alias("volume"))),
        "asset_type": F.when(kind == "crypto_quote", F.lit("cryptocurrency")),
        "status": F.when(~known, F.lit("unknown_data_type")),
        "warning": F.when(~known, F.concat(F.lit("unrecognised data type: "), kind))})


def _point_branches(events: DataFrame, kind: Column) -> DataFrame:
    before = events.columns
    measured = documents.daily_doc_indicators(documents.intraday_stats(events))
    symbol, points = F.upper("symbol").alias("symbol"), F.greatest(F.size("data_points"), F.lit(0))
    statistics = F.when(F.col("min_price").isNotNull(), F.struct(
        "min_price", "max_price", "avg_price", "price_range", "total_volume"))
    indicators = F.when(F.col("sma_20").isNotNull(), F.struct("sma_20", "volatility", "trend_direction"))
    return measured.withColumns({
        "intraday": F.when(kind == "intraday", F.struct(
            symbol, F.coalesce("interval", F.lit("unknown")).alias("interval"),
            points.alias("data_points_count"), statistics.alias("summary_statistics"),
            F.col("trend").alias("trend"))),
        "daily": F.when(kind == "daily", F.struct(
            symbol, points.alias("data_points_count"), indicators.alias("technical_indicators")))}) \
        .select(*before, "intraday", "daily")


def validate_enriched(envelopes: DataFrame) -> DataFrame:
    """Envelope metadata, an original symbol and a non-empty enrichment."""
    ok = (F.col("processing_timestamp").isNotNull() & F.col("processor").isNotNull()
          & (F.length("original_data.symbol") > 0) & F.col("enriched").isNotNull())
    return envelopes.withColumn("is_valid", F.coalesce(ok, F.lit(False)))


def dead_letter_split(envelopes: DataFrame) -> DataFrame:
    """``result`` decides the output folder: Ok or ProcessingFailed."""
    return validate_enriched(envelopes).withColumn(
        "result", F.when(F.col("is_valid"), "Ok").otherwise("ProcessingFailed"))


# -- warehouse shapes ----------------------------------------------------------------

PRICE = T.DecimalType(20, 8)


def _decimal(name: str, kind: T.DecimalType) -> Column:
    return F.coalesce(number(F.col(name)), F.lit(0.0)).try_cast(kind)


def format_warehouse_price(records: DataFrame) -> DataFrame:
    """Warehouse column names and types; a value that is present but not a number drops
    the row, an absent one becomes 0."""
    prices = ("open", "high", "low", "close")
    bad = F.lit(False)
    for c in (*prices, "volume"):
        bad = bad | (F.col(c).isNotNull() & number(F.col(c)).isNull())
    ts = parse_time_loose(F.col("timestamp"))
    return records.filter(~bad & ts.isNotNull()).select(
        F.coalesce("symbol", F.lit("")).alias("SYMBOL"), ts.alias("TIMESTAMP"),
        *[_decimal(c, PRICE).alias(f"{c.upper()}_PRICE") for c in prices],
        F.coalesce(number(F.col("volume")).cast("bigint"), F.lit(0)).alias("VOLUME"),
        F.coalesce("source", F.lit("unknown")).alias("SOURCE"))


def format_warehouse_indicators(records: DataFrame) -> DataFrame:
    names = ("macd", "macd_signal", "macd_histogram", "sma_20", "sma_50")
    bad = F.lit(False)
    for c in ("rsi", *names):
        bad = bad | (F.col(c).isNotNull() & number(F.col(c)).isNull())
    ts = parse_time_loose(F.col("timestamp"))
    return records.filter(~bad & ts.isNotNull()).select(
        F.coalesce("symbol", F.lit("")).alias("SYMBOL"), ts.alias("TIMESTAMP"),
        _decimal("rsi", T.DecimalType(5, 2)).alias("RSI"),
        *[_decimal(c, PRICE).alias(c.upper()) for c in names])


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric columns and missing values, from one aggregate."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    nulls = df.agg(F.count(F.lit(1)).alias("row_count"),
                   *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return nulls.select(
        "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(len(numeric)).cast("bigint").alias("numeric_columns"),
        sum((F.col(c) for c in df.columns), F.lit(0)).cast("bigint").alias("missing_values"))
