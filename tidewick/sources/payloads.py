"""Landed vendor responses (JSON text) as candles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewick.functions.scalar import iso_to_seconds
from tidewick.operators.clean import validate_candles
from tidewick.operators.gaps import dedupe_candles
from tidewick.schema import OHLCV
from tidewick.sources.universe import VENDORS

# fixed values: field names of vendors that send objects
OBJECT_FIELDS = {
    "coincap": {"time": "period", "open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume"},
    "hitbtc": {"time": "timestamp", "open": "open", "high": "max", "low": "min", "close": "close", "volume": "volume"},
    "poloniex": {"time": "date", "open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume"},
}


def _from_arrays(rows: Column, order: list[str]) -> Column:
    """[[..], ..] -> structs, by the vendor's column order."""

    def candle(r: Column) -> Column:
        at = {name: F.try_element_at(r, F.lit(i)) for i, name in enumerate(order, 1)}
        return F.struct(
            at["time"].cast("long").cast("string").alias("raw_time"), *[at[c].alias(c) for c in OHLCV]
        )

    return F.transform(rows, candle)


def _from_objects(rows: Column, fields: dict[str, str]) -> Column:
    return F.transform(
        rows,
        lambda r: F.struct(
            r[fields["time"]].alias("raw_time"), *[r[fields[c]].try_cast("double").alias(c) for c in OHLCV]
        ),
    )


def _objects(fields: dict[str, str]) -> str:
    # read as text: some vendors quote their numbers
    return "array<struct<" + ",".join(f"`{f}`:string" for f in fields.values()) + ">>"


def payload_candles(api: Column, payload: Column) -> Column:
    """The candles of one response as structs (raw_time, open, high, low, close, volume)."""
    arrays = "array<array<double>>"
    wrapped = F.from_json(payload, f"struct<result:map<string,{arrays}>>")["result"]
    listed = F.from_json(payload, arrays)
    coincap = F.from_json(payload, f"struct<data:{_objects(OBJECT_FIELDS['coincap'])}>")["data"]
    out = F.when(
        api == "cryptowatch", _from_arrays(F.try_element_at(F.map_values(wrapped), F.lit(1)), VENDORS["cryptowatch"]["candle"])
    ).when(api == "coincap", _from_objects(coincap, OBJECT_FIELDS["coincap"]))
    for vendor in ("bitfinex", "coinbase"):
        out = out.when(api == vendor, _from_arrays(listed, VENDORS[vendor]["candle"]))
    for vendor in ("hitbtc", "poloniex"):
        fields = OBJECT_FIELDS[vendor]
        out = out.when(api == vendor, _from_objects(F.from_json(payload, _objects(fields)), fields))
    return out


def unwrap_payloads(landed: DataFrame) -> DataFrame:
    """One row per candle in the vendor's own time unit; all vendors in one pass over the text.

    A response that cannot be read, or of an unknown vendor, gives one row without values, which
    :func:`normalize_candles` rejects; a readable response without candles gives none.
    """
    found = payload_candles(F.col("api"), F.col("payload"))
    d = landed.withColumn("_c", F.explode(F.coalesce(found, F.array(F.lit(None)))))
    return d.select(*[c for c in landed.columns if c != "payload"], "_c.*")


def unit_seconds(api: Column, raw_time: Column) -> Column:
    """Unix seconds of a vendor's time text; null where it cannot be read."""
    by_unit = {unit: [v for v, s in VENDORS.items() if s["time_unit"] == unit] for unit in ("ms", "iso8601")}
    whole = raw_time.try_cast("long")
    return (
        F.when(api.isin(by_unit["ms"]), F.floor(whole / 1000))
        .when(api.isin(by_unit["iso8601"]), iso_to_seconds(raw_time))
        .otherwise(whole)
    )


def normalize_candles(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) candles with ``timestamp`` in unix seconds."""
    d = raw.withColumn("timestamp", unit_seconds(F.col("api"), F.col("raw_time"))).drop("raw_time")
    return validate_candles(d)


def vendor_candles(landed: DataFrame, landed_at: str | None = None) -> DataFrame:
    """Archive rows (closing_time, OHLC, base_volume), one per candle however often it landed.

    Pages that disagree: the newest by ``landed_at`` (a number) wins, else the least values, so
    that the result does not depend on the order of files.
    Vendors stamp candles with their opening time, except cryptowatch; hitbtc writes usd for usdt.
    """
    valid, _ = normalize_candles(unwrap_payloads(landed))
    opened = F.col("timestamp") + F.col("period")
    pair = F.when(
        F.col("exchange") == "hitbtc", F.regexp_replace("trading_pair", "usd$", "usdt")
    ).otherwise(F.col("trading_pair"))
    d = valid.select(
        "exchange",
        pair.alias("trading_pair"),
        "period",
        F.when(F.col("api") == "cryptowatch", F.col("timestamp")).otherwise(opened).alias("closing_time"),
        *OHLCV[:-1],
        F.col("volume").alias("base_volume"),
        *([(-F.col(landed_at)).alias("_age")] if landed_at else []),
    )
    keys = ["exchange", "trading_pair", "period", "closing_time"]
    return dedupe_candles(d, [*(["_age"] if landed_at else []), *OHLCV[:-1], "base_volume"], keys).drop("_age")
