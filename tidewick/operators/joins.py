"""Joins between series, exchanges and tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewick.operators.chunks import running
from tidewick.schema import OHLC, PAIR, SERIES


def natural_join(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    return a.join(b, [c for c in a.columns if c in b.columns], how)


def merge_candles(candles: DataFrame, arb: DataFrame) -> DataFrame:
    return candles.join(arb, ["trading_pair", "exchange", "period", "datetime", "timestamp"], "inner")


def cross_exchange_join(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All exchange pairs of all trading pairs at once, ``columns`` suffixed per exchange.

    Equality on (trading_pair, period, timestamp) carries the shuffle; both sides read the same
    exchange.  A key holds one row per exchange.
    """
    on = ["trading_pair", "period", "timestamp"]

    def side(n: int) -> DataFrame:
        return df.select(
            *on, F.col("exchange").alias(f"exchange_{n}"), *[F.col(c).alias(f"{c}_exchange_{n}") for c in columns]
        )

    joined = side(1).join(side(2), on).where(F.col("exchange_1") < F.col("exchange_2"))
    first = [*PAIR, "timestamp"]
    return joined.select(*first, *[c for c in joined.columns if c not in first])


def exchange_pairs(series: DataFrame) -> DataFrame:
    """Unordered exchange combinations listing the same trading pair.

    The whole pair name is compared, so usd and usdt never match.
    """
    listed = series.select("exchange", "trading_pair").distinct()
    a = listed.select("trading_pair", F.col("exchange").alias("exchange_1"))
    b = listed.select("trading_pair", F.col("exchange").alias("exchange_2"))
    return (
        a.join(b, "trading_pair")
        .where(F.col("exchange_1") < F.col("exchange_2"))
        .select("exchange_1", "exchange_2", "trading_pair")
    )


def arb_info(df: DataFrame) -> DataFrame:
    """Each close against the mean close of all exchanges at that time.

    A window over (trading_pair, period, timestamp) holds one row per exchange; no join needed.
    """
    avg = F.avg("close").over(Window.partitionBy("trading_pair", "period", "timestamp"))
    gap = F.col("close") - F.col("avg")
    return df.withColumn("avg", avg).withColumns({"arb_diff": gap, "arb_signal": F.try_divide(gap, F.col("avg"))})


def quote_enrich(df: DataFrame, is_quote: Column, needs_quote: Column, name: str = "close_btc") -> DataFrame:
    """Add the quote currency's own price on the same exchange; gaps take the next known one."""
    on = ["exchange", "period", "timestamp"]
    quote = df.where(is_quote).select(*on, F.col("close").alias(name))
    out = df.where(needs_quote).join(quote, on, "inner")
    return running(out, {"_next": ("last", name)}, reverse=True).withColumn(name, F.col("_next")).drop("_next")


def market_average(df: DataFrame) -> DataFrame:
    return df.groupBy("trading_pair", "period", "timestamp").agg(*[F.avg(c).alias(c) for c in OHLC])


def last_volume(requested: DataFrame, candles: DataFrame) -> DataFrame:
    """Volume one period before each requested time; misses take the previous hit, then the next."""
    previous = candles.select(*SERIES, (F.col("timestamp") + F.col("period")).alias("timestamp"), "volume")
    hit = requested.select(*SERIES, "timestamp").join(previous, [*SERIES, "timestamp"], "left")
    filled = running(hit, {"_before": ("last", "volume")})
    filled = running(filled, {"_after": ("last", "_before")}, reverse=True)
    return filled.select(*SERIES, "timestamp", F.coalesce("_before", "_after").alias("volume"))


def new_rows(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti")


def rows_at(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(wanted, list(keys), "left_semi")
