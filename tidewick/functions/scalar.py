"""Scalar column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: share of the price lost to fees, in percent
ARBITRAGE_FEE = 0.55
TRADE_FEE = 0.35


def higher_close(close_1: Column, close_2: Column) -> Column:
    """1 or 2 for the exchange closing higher, 0 when equal or unknown."""
    return F.when(close_1 > close_2, 1).when(close_1 < close_2, 2).otherwise(0)


def pct_higher(close_1: Column, close_2: Column) -> Column:
    """How far the higher close lies above the lower one, in percent."""
    top, bottom = F.greatest(close_1, close_2), F.least(close_1, close_2)
    known = close_1.isNotNull() & close_2.isNotNull() & (close_1 != close_2)
    return F.when(known, (F.try_divide(top, bottom) - 1) * 100).otherwise(0.0)


def arbitrage_state(close_1: Column, close_2: Column, fee: float = ARBITRAGE_FEE) -> Column:
    """-1: buy on exchange 2 and sell on 1; 1: the reverse; 0: the fee eats the difference."""
    side = higher_close(close_1, close_2)
    return F.when(pct_higher(close_1, close_2) < fee, 0).when(side == 1, -1).when(side == 2, 1).otherwise(0)


def pct_diff(close_1: Column, close_2: Column) -> Column:
    return F.try_divide(close_1 - close_2, close_1)


def three_way(value: Column, low: Column, high: Column) -> Column:
    """1 above ``high``, -1 below ``low``, else 0."""
    return F.when(value > high, 1).when(value < low, -1).otherwise(0)


def arbitrage_label(state: Column) -> Column:
    return (
        F.when(state == -1, "arb from exchange_2 to exchange_1")
        .when(state == 1, "arb from exchange_1 to exchange_2")
        .otherwise("no_arbitrage")
    )


def trade_label(rises: Column) -> Column:
    return F.when(rises, "Up").otherwise("Down")


# --- time -----------------------------------------------------------------------------------


def seconds_to_datetime(seconds: Column) -> Column:
    """Zone-less UTC date-time of unix seconds."""
    base = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def seconds_to_date(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))


def date_parts(seconds: Column) -> dict[str, Column]:
    day = seconds_to_date(seconds)
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def iso_to_seconds(text: Column) -> Column:
    """Unix seconds of an ISO-8601 UTC instant such as ``2019-01-01T05:00:00.000Z``."""
    return F.unix_seconds(F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")))


def day_to_seconds(text: Column, pattern: str = "dd-MM-yyyy") -> Column:
    """Unix seconds of midnight UTC of a day written like ``31-12-2019``."""
    return F.unix_date(F.to_date(text, pattern)).cast("long") * 86_400


def scaled_to_seconds(value: Column, per_second: int) -> Column:
    """Whole seconds of an integer count of 1/per_second units (milli, micro, nano)."""
    return F.floor(value / per_second)


# --- names ----------------------------------------------------------------------------------

# fixed pattern: two exchanges (either may hold one underscore), base_quote
PAIR_NAME = r"^([a-z0-9]+(?:_pro)?)_([a-z0-9]+(?:_pro)?)_([a-z0-9]+_[a-z0-9]+)$"


def parse_series_name(name: Column) -> dict[str, Column]:
    """Exchange, trading pair and period (null if absent) of a series or file stem."""
    period = F.regexp_extract(name, r"_(\d+)$", 1)
    stem = F.regexp_replace(name, r"_\d+$", "")
    return {
        "exchange": F.regexp_extract(stem, r"^(.+)_[a-z0-9]+_[a-z0-9]+$", 1),
        "trading_pair": F.regexp_extract(stem, r"^.+_([a-z0-9]+_[a-z0-9]+)$", 1),
        "period": F.when(period != "", period.cast("int")),
    }


def parse_pair_name(name: Column) -> dict[str, Column]:
    return {
        part: F.regexp_extract(name, PAIR_NAME, i)
        for i, part in enumerate(["exchange_1", "exchange_2", "trading_pair"], 1)
    }
