"""Column sets and schemas shared by the whole package.

One candle row is one OHLCV bar of one series.  ``timestamp`` is the bar's
start in unix seconds; its close time is ``timestamp + period``.
"""

from pyspark.sql import types as T

SERIES = ["exchange", "trading_pair", "period"]
PAIR = ["exchange_1", "exchange_2", "trading_pair", "period"]
PK = [*SERIES, "timestamp"]
OHLC = ["open", "high", "low", "close"]
OHLCV = [*OHLC, "volume"]

CANDLE = T.StructType(
    [
        T.StructField("api", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("trading_pair", T.StringType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in OHLCV],
    ]
)

# one file per series; series identity lives in the file or directory name
CANDLE_CSV = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("closing_time", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in OHLC],
        T.StructField("base_volume", T.DoubleType()),
    ]
)

TICK = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# predictions of any model, in long form
PREDICTION = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("exchange", "model_type", "trading_pair")],
        T.StructField("timestamp", T.LongType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("prediction", T.StringType()),
    ]
)
PREDICTION_KEY = ["exchange", "model_type", "trading_pair", "timestamp", "period"]
PREDICTION_LAYOUT = ["model_type", "period"]
ARB_PREDICTION_KEY = ["p_time", "exchange_1", "exchange_2", "trading_pair"]
TRADE_PREDICTION_KEY = ["p_time", "exchange", "trading_pair"]
