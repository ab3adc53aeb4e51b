"""Scans of the candle table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewick.functions.scalar import day_to_seconds, parse_series_name
from tidewick.operators.chunks import edge_rows
from tidewick.schema import CANDLE, CANDLE_CSV, OHLCV, SERIES

SIX = ["open", "close", "high", "low", "timestamp", "volume"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The candle table, partitioned by period and exchange on disk."""
    return spark.read.schema(CANDLE).parquet(path)


def _bound(value: int | str):
    """Unix seconds, given as such or as a day like ``31-12-2019``."""
    return F.lit(value) if isinstance(value, int) else day_to_seconds(F.lit(value))


def scan_candles(
    candles: DataFrame,
    exchange: str | None = None,
    trading_pair: str | None = None,
    start: int | str | None = None,
    end: int | str | None = None,
    period: int = 300,
    n: int | None = None,
    verbose: bool = False,
) -> DataFrame:
    """Candles matching all given conditions (both time bounds inclusive), oldest first; with ``n`` the oldest ``n``."""
    d = candles.where(F.col("period") == period)
    if exchange is not None:
        d = d.where(F.col("exchange") == exchange)
    if trading_pair is not None:
        d = d.where(F.col("trading_pair") == trading_pair)
    if start is not None:
        d = d.where(F.col("timestamp") >= _bound(start))
    if end is not None:
        d = d.where(F.col("timestamp") <= _bound(end))
    # ties in time are broken by series so that a cut is deterministic
    d = d.orderBy("timestamp", "exchange", "trading_pair")
    d = d if n is None else d.limit(n)
    return d if verbose else d.select(*SIX, "period")


def latest_k(candles: DataFrame, k: int) -> DataFrame:
    """Newest ``k`` candles of every series."""
    return edge_rows(candles, k).drop("rank")


def first_k(candles: DataFrame, k: int) -> DataFrame:
    """Oldest ``k`` candles of every series."""
    return edge_rows(candles, k, newest=False).drop("rank")


def chart_series(candles: DataFrame, k: int | None = None) -> DataFrame:
    """Candles of every series for charts: all of them, or the oldest ``k``."""
    return candles if k is None else first_k(candles, k)


def scan_series(candles: DataFrame, exchange: str, trading_pair: str, period: int) -> DataFrame:
    """A whole series, newest first."""
    d = candles.where(
        (F.col("exchange") == exchange) & (F.col("trading_pair") == trading_pair) & (F.col("period") == period)
    )
    return d.orderBy(F.col("timestamp").desc())


def scan_by_api(candles: DataFrame, api: str) -> DataFrame:
    return candles.where(F.col("api") == api)


def read_csv_candles(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Candle files ``<exchange>_<pair>_<period>.csv``, or directories of that name.

    The series comes from the name; ``timestamp`` is the opening time again.
    """
    d = spark.read.schema(CANDLE_CSV).option("header", True).csv(paths)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+_\d+)(?:\.csv)?(?:/[^/]*)?$", 1)
    d = d.select("*", stem.alias("_stem"))
    name = parse_series_name(F.col("_stem"))
    d = d.withColumns({k: name[k] for k in SERIES})
    return d.select(
        *SERIES,
        (F.col("closing_time") - F.col("period")).alias("timestamp"),
        *OHLCV[:-1],
        F.col("base_volume").alias("volume"),
    )


def read_performance(spark: SparkSession, paths: str | list[str], schema) -> DataFrame:
    """Performance files of several runs as one table."""
    return spark.read.schema(schema).option("header", True).csv(paths)


def read_confusions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Confusion documents of several runs; of one model's copies the latest file's wins."""
    d = spark.read.schema("model_name string, confusion string").json(paths)
    d = d.select("*", F.col("_metadata.file_path").alias("_file"))
    return d.groupBy("model_name").agg(F.max_by("confusion", "_file").alias("confusion"))
