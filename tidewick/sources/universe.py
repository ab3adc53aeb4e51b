"""Vendors, the series they list, and how they name pairs and intervals."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: what each vendor lists and how it writes pairs, intervals and candles
VENDORS = {
    "cryptowatch": {
        "exchanges": {
            "gemini": ["eth_btc", "btc_usd"],
            "kraken": ["eth_btc", "btc_usd", "bat_btc", "link_eth", "bch_btc", "eos_usd"],
        },
        "no_underscore": True,
        "candle": ["time", "open", "high", "low", "close", "volume"],
        "time_unit": "s",
    },
    "coincap": {
        "exchanges": {"binance": ["eth_btc", "btc_usdt", "bat_btc", "link_eth", "bch_btc"]},
        "full_names": True,
        "intervals": {"w": [1], "d": [1], "h": [1, 2, 4, 8, 12], "m": [1, 5, 15, 30]},
        "time_unit": "ms",
    },
    "hitbtc": {
        "exchanges": {"hitbtc": ["eth_btc", "btc_usd", "bat_btc", "eos_usd"]},
        "no_underscore": True,
        "uppercase": True,
        "intervals": {"d": [1, 7], "h": [1, 4], "m": [1, 3, 5, 15, 30]},
        "interval_style": "upper",
        "limit": 1000,
        "time_unit": "iso8601",
    },
    "bitfinex": {
        "exchanges": {"bitfinex": ["eth_btc", "btc_usd", "bat_btc", "bch_btc", "eos_usd"]},
        "renames": {"bch_btc": "bab_btc"},
        "no_underscore": True,
        "uppercase": True,
        "intervals": {"d": [1, 7, 14], "h": [1, 3, 6, 12], "m": [1, 5, 15, 30]},
        "interval_style": "reversed",
        "limit": 5000,
        "candle": ["time", "open", "close", "high", "low", "volume"],
        "time_unit": "ms",
    },
    "coinbase": {
        "exchanges": {"coinbase": ["eth_btc", "btc_usd", "link_eth", "bch_btc", "eos_usd"]},
        "uppercase": True,
        "dash": True,
        "limit": 300,
        "candle": ["time", "low", "high", "open", "close", "volume"],
        "time_unit": "s",
        "disabled": True,
    },
    "poloniex": {
        "exchanges": {"poloniex": ["eth_btc", "btc_usdt", "bat_btc", "eos_usdt"]},
        "reversed": True,
        "uppercase": True,
        "time_unit": "s",
    },
}

# fixed values: currency names that vendors spell out
CURRENCY_NAMES = {
    "btc": "bitcoin",
    "eth": "ethereum",
    "usd": "united-states-dollar",
    "usdt": "tether",
    "bat": "basic-attention-token",
    "link": "chainlink",
    "bch": "bitcoin-cash",
    "eos": "eos",
    "ltc": "litecoin",
}

# fixed values: seconds per interval unit, longest first
UNIT_SECONDS = {"w": 604_800, "d": 86_400, "h": 3_600, "m": 60}

_CONFIG = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("exchanges", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
            T.StructField("renames", T.MapType(T.StringType(), T.StringType())),
            T.StructField("intervals", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
            T.StructField("interval_style", T.StringType()),
            *[
                T.StructField(flag, T.BooleanType())
                for flag in ("no_underscore", "uppercase", "dash", "reversed", "full_names", "disabled")
            ],
            T.StructField("limit", T.IntegerType()),
        ]
    ),
)


def vendor_config(spark: SparkSession, vendors: dict = VENDORS) -> DataFrame:
    """One row per vendor: (api, c: its settings)."""
    text = spark.range(1).select(F.from_json(F.lit(json.dumps(vendors)), _CONFIG).alias("m"))
    return text.select(F.explode("m").alias("api", "c"))


def series_universe(config: DataFrame, include_disabled: bool = False) -> DataFrame:
    """(api, exchange, trading_pair) of every listed series."""
    live = config if include_disabled else config.where(~F.coalesce(F.col("c.disabled"), F.lit(False)))
    by_exchange = live.select("api", F.explode("c.exchanges").alias("exchange", "pairs"))
    return by_exchange.select("api", "exchange", F.explode("pairs").alias("trading_pair"))


def vendor_symbols(pairs: DataFrame, config: DataFrame) -> DataFrame:
    """Vendor spelling of every (api, trading_pair): base_id, quote_id and symbol."""
    on = lambda flag: F.coalesce(F.col(f"c.{flag}"), F.lit(False))
    d = pairs.join(config, "api")
    d = d.withColumn("_p", F.coalesce(F.try_element_at("c.renames", F.col("trading_pair")), F.col("trading_pair")))
    d = d.withColumns({"_a": F.split_part("_p", F.lit("_"), F.lit(1)), "_b": F.split_part("_p", F.lit("_"), F.lit(2))})
    d = d.withColumns(
        {
            "_base": F.when(on("reversed"), F.col("_b")).otherwise(F.col("_a")),
            "_quote": F.when(on("reversed"), F.col("_a")).otherwise(F.col("_b")),
        }
    )
    separator = F.when(on("no_underscore"), "").when(on("dash"), "-").otherwise("_")
    symbol = F.concat(F.col("_base"), separator, F.col("_quote"))
    names = F.create_map(*[F.lit(x) for kv in CURRENCY_NAMES.items() for x in kv])
    spelled = lambda c: F.when(on("full_names"), F.try_element_at(names, F.col(c))).otherwise(F.col(c))
    return d.withColumns(
        {
            "base_id": spelled("_base"),
            "quote_id": spelled("_quote"),
            "symbol": F.when(on("uppercase"), F.upper(symbol)).otherwise(symbol),
        }
    ).drop("c", "_p", "_a", "_b", "_base", "_quote")


def interval_label(period: Column, config: Column) -> Column:
    """The vendor's name of the largest interval it accepts within ``period`` seconds.

    The unit is the longest one that fits into the period (weeks only where the vendor has them).
    """
    accepted = config["intervals"]

    def of(unit: str) -> Column:
        n = period / UNIT_SECONDS[unit]
        choices = accepted[unit]
        if unit == "m":
            choices = F.array_union(F.array(F.lit(1)), choices)
        best = F.array_max(F.filter(choices, lambda x: x <= n)).cast("string")
        style = config["interval_style"]
        return (
            F.when(style == "upper", F.concat(F.lit(unit.upper()), best))
            .when(style == "reversed", F.concat(best, F.lit(unit)))
            .otherwise(F.concat(F.lit(unit), best))
        )

    has_weeks = F.map_contains_key(accepted, "w")
    return (
        F.when(accepted.isNull(), F.lit(None).cast("string"))
        .when((period >= UNIT_SECONDS["w"]) & has_weeks, of("w"))
        .when(period >= UNIT_SECONDS["d"], of("d"))
        .when(period >= UNIT_SECONDS["h"], of("h"))
        .otherwise(of("m"))
    )


# fixed values: abbreviations of one vendor's symbols
VENDOR_ABBREVIATIONS = {"bitfinex": {"usdc": "udc", "usdt": "ust", "dash": "dsh", "bch": "bab"}}


def archive_symbol(api: Column, trading_pair: Column) -> Column:
    """Vendor symbol in the historical archives, where one vendor abbreviates currencies."""
    joined = F.replace(trading_pair, F.lit("_"), F.lit(""))
    short = joined
    for long_name, abbreviation in VENDOR_ABBREVIATIONS["bitfinex"].items():
        short = F.replace(short, F.lit(long_name), F.lit(abbreviation))
    return F.when(api == "bitfinex", F.upper(short)).when(api == "hitbtc", F.upper(joined)).otherwise(joined)
