"""Parsers from landed provider payloads (text columns) to typed rows.

Payload numbers arrive as text; a missing key gives the default, text that is not a number
gives NULL. Exploding a document stays in the task that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import number
from tickloom.functions.times import from_millis
from tickloom.schemas import BAR, JOB_OUTPUT

_MAP = "map<string,string>"


def _value(fields: Column, key: str, default: float = 0.0, kind: str = "double") -> Column:
    text = fields[key]
    return F.when(text.isNull(), F.lit(default).cast(kind)).otherwise(number(text, kind))


def parse_quote_payload(landed: DataFrame, body: str = "payload") -> DataFrame:
    """Real-time quote with numbered keys."""
    q = F.from_json(body, f"`Global Quote` {_MAP}")["Global Quote"]
    fields = F.col("_q")
    parsed = landed.withColumn("_q", F.coalesce(q, F.create_map().cast(_MAP)))
    return parsed.select(
        F.coalesce(fields["01. symbol"], F.col("symbol")).alias("symbol"),
        _value(fields, "02. open").alias("open"), _value(fields, "03. high").alias("high"),
        _value(fields, "04. low").alias("low"), _value(fields, "05. price").alias("price"),
        _value(fields, "06. volume", 0, "bigint").alias("volume"),
        F.coalesce(fields["07. latest trading day"], F.lit("")).alias("latest_trading_day"),
        _value(fields, "08. previous close").alias("previous_close"),
        _value(fields, "09. change").alias("change"),
        number(F.regexp_replace(fields["10. change percent"], "%", "")).alias("change_percent"),
        F.lit("real_time_quote").alias("data_type"))


def _keyed_series(landed: DataFrame, body: str, series: str, zone_key: str) -> DataFrame:
    schema = f"`Meta Data` {_MAP}, `{series}` map<string,{_MAP}>"
    doc = F.from_json(body, schema)
    return (landed.withColumn("_d", doc)
            .select("symbol",
                    F.coalesce(F.col("_d.`Meta Data`")["3. Last Refreshed"], F.lit(""))
                    .alias("last_refreshed"),
                    F.coalesce(F.col("_d.`Meta Data`")[zone_key], F.lit("US/Eastern"))
                    .alias("timezone"),
                    F.explode(F.col(f"_d.`{series}`")).alias("timestamp", "_f")))


def parse_intraday_payload(landed: DataFrame, body: str = "payload",
                           interval: str = "1min") -> DataFrame:
    rows = _keyed_series(landed, body, f"Time Series ({interval})", "6. Time Zone")
    f = F.col("_f")
    return rows.select(
        "symbol", F.lit(interval).alias("interval"), "last_refreshed", "timezone",
        F.lit("intraday").alias("data_type"), "timestamp",
        _value(f, "1. open").alias("open"), _value(f, "2. high").alias("high"),
        _value(f, "3. low").alias("low"), _value(f, "4. close").alias("close"),
        _value(f, "5. volume", 0, "bigint").alias("volume"))


def parse_daily_payload(landed: DataFrame, body: str = "payload") -> DataFrame:
    rows = _keyed_series(landed, body, "Time Series (Daily)", "5. Time Zone")
    f = F.col("_f")
    return rows.select(
        "symbol", "last_refreshed", "timezone", F.lit("daily").alias("data_type"),
        F.col("timestamp").alias("date"),
        _value(f, "1. open").alias("open"), _value(f, "2. high").alias("high"),
        _value(f, "3. low").alias("low"), _value(f, "4. close").alias("close"),
        _value(f, "5. adjusted close").alias("adjusted_close"),
        _value(f, "6. volume", 0, "bigint").alias("volume"),
        _value(f, "7. dividend amount").alias("dividend_amount"),
        _value(f, "8. split coefficient", 1.0).alias("split_coefficient"))


def parse_stock_chart(landed: DataFrame, body: str = "payload", source: str = "stock_chart",
                      market: str = "stocks") -> DataFrame:
    """Array of day (and minute) points."""
    schema = ("array<struct<date:string,minute:string,open:double,high:double,low:double,"
              "close:double,volume:bigint>>")
    return (landed.select("symbol", F.explode(F.from_json(body, schema)).alias("p"))
            .select("symbol", F.concat_ws(" ", "p.date", F.coalesce("p.minute", F.lit("00:00")))
                    .alias("timestamp"),
                    "p.open", "p.high", "p.low", "p.close", "p.volume",
                    F.lit(source).alias("source"), F.lit(market).alias("market")))


def parse_price_series(landed: DataFrame, body: str = "payload", source: str = "price_series",
                       market: str = "crypto") -> DataFrame:
    """Parallel arrays of [ms, price] and [ms, volume], paired by position."""
    schema = "prices array<array<double>>, total_volumes array<array<double>>"
    pairs = landed.withColumn("_d", F.from_json(body, schema)).select(
        "symbol", F.posexplode("_d.prices").alias("i", "p"),
        F.col("_d.total_volumes").alias("vs"))
    price = F.get("p", 1)
    return pairs.select(
        "symbol", from_millis(F.get("p", 0)).alias("ts"), price.alias("open"),
        price.alias("high"), price.alias("low"), price.alias("close"),
        F.coalesce(F.get(F.get("vs", F.col("i")), 1), F.lit(0.0)).cast("bigint").alias("volume"),
        F.lit(source).alias("source"), F.lit(market).alias("market"))


def parse_klines(landed: DataFrame, body: str = "payload", source: str = "klines",
                 market: str = "crypto") -> DataFrame:
    """Positional arrays: ms, open, high, low, close, volume."""
    rows = landed.select("symbol", F.explode(F.from_json(body, "array<array<string>>"))
                         .alias("k"))

    def at(i: int) -> Column:
        return number(F.get("k", i))

    return rows.select(
        "symbol", from_millis(number(F.get("k", 0), "bigint")).alias("ts"),
        at(1).alias("open"), at(2).alias("high"), at(3).alias("low"), at(4).alias("close"),
        at(5).cast("bigint").alias("volume"),
        F.lit(source).alias("source"), F.lit(market).alias("market"))


def decode_stream_payload(stream: DataFrame, value: str = "value", arrived: str = "arrived_at"
                          ) -> DataFrame:
    """Message bytes to bar columns, arrival time kept. Works on streams."""
    parsed = F.from_json(F.col(value).cast("string"), BAR).alias("d")
    return stream.select(parsed, arrived).select("d.*", arrived)


def decode_base64_batch(records: DataFrame, schema, data: str = "data") -> DataFrame:
    """base64 to JSON to columns, with ``decoded`` false where a step fails."""
    text = F.decode(F.try_to_binary(F.col(data), F.lit("base64")), "UTF-8")
    # PERMISSIVE keeps broken JSON in the extra column, so it can be told from a row of NULLs.
    shape = f"{schema}, _corrupt string"
    parsed = records.withColumn("_t", text).withColumn("_j", F.from_json(
        "_t", shape, {"columnNameOfCorruptRecord": "_corrupt"}))
    names = [part.split()[0] for part in schema.split(", ")]
    keep = [c for c in records.columns if c != data]
    return parsed.select(*keep, *[F.col(f"_j.{n}").alias(n) for n in names],
                         (F.col("_t").isNotNull() & F.col("_j._corrupt").isNull()
                          & F.col("_j").isNotNull()).alias("decoded"))


def split_job_output(documents: DataFrame, body: str = "payload") -> DataFrame:
    """One result document to rows tagged ``price_data`` or ``technical_indicators``.

    Both lists are exploded together, so the documents are read once; each table is a filter
    on ``kind``.
    """
    doc = documents.select(F.from_json(body, JOB_OUTPUT).alias("d"))
    empty_bar = F.lit(None).cast(JOB_OUTPUT["price_data"].dataType.elementType)
    empty_ind = F.lit(None).cast(JOB_OUTPUT["technical_indicators"].dataType.elementType)
    none = F.array().cast("array<struct<kind:string,p:{},i:{}>>".format(
        JOB_OUTPUT["price_data"].dataType.elementType.simpleString(),
        JOB_OUTPUT["technical_indicators"].dataType.elementType.simpleString()))
    prices = F.transform("d.price_data", lambda x: F.struct(
        F.lit("price_data").alias("kind"), x.alias("p"), empty_ind.alias("i")))
    inds = F.transform("d.technical_indicators", lambda x: F.struct(
        F.lit("technical_indicators").alias("kind"), empty_bar.alias("p"), x.alias("i")))
    return (doc.select(F.explode(F.concat(F.coalesce(prices, none), F.coalesce(inds, none)))
                       .alias("r")).select("r.*"))


def price_table(split: DataFrame) -> DataFrame:
    return split.filter("kind = 'price_data'").select("p.*")


def indicator_table(split: DataFrame) -> DataFrame:
    return split.filter("kind = 'technical_indicators'").select("i.*")
