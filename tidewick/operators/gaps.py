"""Gaps, duplicates and imputation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.operators.chunks import CHUNK_ROWS, neighbour, running
from tidewick.operators.joins import market_average
from tidewick.schema import OHLC, PK, SERIES


def missing_timesteps(df: DataFrame) -> DataFrame:
    """Rows not followed by the next candle: (timestamp, ntimestamp) around each gap."""
    d = neighbour(df, {"ntimestamp": "timestamp"}, +1)
    return d.where(F.col("ntimestamp") - F.col("timestamp") != F.col("period")).select(
        "api", *SERIES, "timestamp", "ntimestamp"
    )


def bad_timestamps(df: DataFrame, step: int) -> DataFrame:
    """Rows whose successor is not exactly ``step`` seconds later."""
    d = neighbour(df, {"ntimestamp": "timestamp"}, +1)
    return d.where(F.col("timestamp") != F.col("ntimestamp") - step).select(*SERIES, "timestamp", "ntimestamp")


def dedupe_candles(df: DataFrame, prefer: Sequence[str], keys: Sequence[str] = PK) -> DataFrame:
    """One row per key: the least by ``prefer``, nulls last.

    An aggregation, so copies collapse before the shuffle however many a key has.
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    flags = [F.col(c).isNull().alias(f"_null_{c}") for c in prefer]
    ranked = [x for pair in zip(flags, map(F.col, prefer), strict=True) for x in pair]
    best = F.min(F.struct(*ranked, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[c if c in keys else F.col(f"_best.{c}") for c in df.columns])


def _fill_slots(df: DataFrame) -> DataFrame:
    """One row per grid slot; ``_gap`` marks slots without a candle, which repeat the row before.

    Each row fills the slots up to its successor.  Long outages are cut at chunk length first,
    so that no single array grows with the gap.
    """
    d = neighbour(df, {"_next": "timestamp"}, +1)
    last_slot = F.coalesce(F.col("_next") - F.col("period"), F.col("timestamp"))
    d = d.withColumn("_last", F.greatest(last_slot, F.col("timestamp")))
    stride = F.col("period").cast("long") * CHUNK_ROWS
    d = d.withColumn("_from", F.explode(F.sequence("timestamp", "_last", stride)))
    upto = F.least(F.col("_last"), F.col("_from") + stride - F.col("period"))
    d = d.withColumn("_slot", F.explode(F.sequence("_from", upto, F.col("period").cast("long"))))
    d = d.withColumn("_gap", F.col("_slot") != F.col("timestamp"))
    return d.withColumn("timestamp", F.col("_slot")).drop("_next", "_last", "_from", "_slot")


def gap_fill(df: DataFrame) -> DataFrame:
    """Complete time grid: gap candles are flat at the last close with volume 0."""
    d = _fill_slots(df.select(*PK, *OHLC, "volume"))
    flat = {c: F.when(F.col("_gap"), F.col("close")).otherwise(F.col(c)) for c in ("open", "high", "low")}
    return d.withColumns(
        {
            **flat,
            "volume": F.when(F.col("_gap"), 0.0).otherwise(F.col("volume")),
            "nan_ohlcv": F.col("_gap").cast("int"),
        }
    ).drop("_gap")


def impute_candles(df: DataFrame) -> DataFrame:
    """Gaps take the market's average prices and the last volume; what is left, the next prices."""
    d = _fill_slots(df.select(*PK, *OHLC, "volume"))
    market = market_average(df)
    market = market.select("trading_pair", "period", "timestamp", *[F.col(c).alias(f"_avg_{c}") for c in OHLC])
    d = d.join(market, ["trading_pair", "period", "timestamp"], "left")
    d = d.withColumns({c: F.when(F.col("_gap"), F.col(f"_avg_{c}")).otherwise(F.col(c)) for c in OHLC})
    d = running(d.drop(*[f"_avg_{c}" for c in OHLC]), {f"_next_{c}": ("last", c) for c in OHLC}, reverse=True)
    return d.select(
        *PK, *[F.col(f"_next_{c}").alias(c) for c in OHLC], "volume", F.col("_gap").cast("int").alias("imputed")
    )


def prev_volume(df: DataFrame) -> DataFrame:
    return neighbour(df, {"prev_volume": "volume"}, -1)


def backfill_plan(df: DataFrame, limit: int) -> DataFrame:
    """The page requests of ``limit`` candles each that would close every gap."""
    gaps = missing_timesteps(df)
    stride = F.col("period").cast("long") * limit
    pages = gaps.withColumn("n_pages", F.ceil((F.col("ntimestamp") - F.col("timestamp")) / stride))
    pages = pages.withColumn("start", F.explode(F.sequence("timestamp", F.col("ntimestamp") - 1, stride)))
    return pages.withColumn("end", F.least(F.col("start") + stride, F.col("ntimestamp"))).select(
        "api", *SERIES, "timestamp", "ntimestamp", "n_pages", "start", "end"
    )


def fill_forward(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    filled = running(df, {f"_f_{c}": ("last", c) for c in columns}, keys)
    return filled.withColumns({c: F.col(f"_f_{c}") for c in columns}).drop(*[f"_f_{c}" for c in columns])


def fill_backward(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    filled = running(df, {f"_f_{c}": ("last", c) for c in columns}, keys, reverse=True)
    return filled.withColumns({c: F.col(f"_f_{c}") for c in columns}).drop(*[f"_f_{c}" for c in columns])
