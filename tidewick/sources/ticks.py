"""Raw ticks and the candles made of them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewick.schema import PK

def epoch_micros(ntz: str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    days = F.unix_date(F.col(ntz).cast("date")).cast("long") * 86_400_000_000
    clock = F.hour(ntz).cast("long") * 3_600_000_000 + F.minute(ntz).cast("long") * 60_000_000
    return days + clock + (F.date_part(F.lit("SECOND"), F.col(ntz)) * 1_000_000).cast("long")


def read_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Event rows as trades: (exchange, trading_pair, micros, seq, price, qty)."""
    return events.select(
        F.col("event_type").alias("exchange"),
        F.concat(F.lit("p"), F.col("user_id") % 2).alias("trading_pair"),
        epoch_micros("ts").alias("micros"),
        F.col("event_id").alias("seq"),
        (100 + F.col("value") / 100).alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("qty"),
    )


def tick_candles(ticks: DataFrame, period: int) -> DataFrame:
    """OHLCV candles of ``period`` seconds; first and last trade by (micros, seq).

    Trades are combined on the map side, so a bucket or series of any size shuffles as one
    row per task.  The order key is a decimal, which keeps the buffers fixed-width and the
    aggregation hash-based.
    """
    order = F.expr("cast(micros as decimal(38,0)) * 10000000000000000000BD + cast(seq as decimal(19,0))").cast(
        "decimal(38,0)"
    )
    d = ticks.select(
        "exchange",
        "trading_pair",
        F.lit(period).alias("period"),
        F.expr(f"(micros div {period * 1_000_000}L) * {period}L").alias("timestamp"),
        order.alias("_order"),
        "price",
        "qty",
    )
    return d.groupBy(*PK).agg(
        F.min_by("price", "_order").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "_order").alias("close"),
        F.sum("qty").alias("volume"),
    )


def read_candles(spark: SparkSession, sf_dir: str, period: int = 3600) -> DataFrame:
    """Candles of the driver's event table, with the feed (api) they came from."""
    api = F.when(F.col("exchange").isin("click", "view"), "direct").otherwise("aggregator")
    return tick_candles(read_ticks(spark, sf_dir), period).withColumn("api", api)
