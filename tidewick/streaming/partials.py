"""Candles that ticks of any lateness correct: mergeable partial candles as deltas, merged by key.

A partial candle keeps what makes candles mergeable: high, low, volume, number of ticks, and open and close with the order
keys of their ticks.  Merging is associative and commutative, so a micro-batch only aggregates its own ticks (on the map side
first) and writes one delta; no state and no watermark is needed, and a tick that arrives weeks later still
corrects its candle.  A delta is a folder named after the micro-batches it covers and is written whole or not at all, so a
batch that is run again replaces its own delta.  ``compact`` merges neighbouring deltas tier by tier, so that every
partial candle is rewritten once per tier; readers take the widest deltas and merge them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.schema import OHLCV, PK
from tidewick.sinks.tables import names_in
from tidewick.streaming.jobs import run_batches

PARTIAL = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("trading_pair", T.StringType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("first", T.DecimalType(38, 0)),
    T.StructField("last", T.DecimalType(38, 0)),
    *[T.StructField(c, T.DoubleType()) for c in OHLCV],
    T.StructField("n", T.LongType()),
])


def order_key() -> Column:
    """Ticks in order of time and number, as one fixed-width key."""
    return F.expr("cast(micros as decimal(38,0)) * 10000000000000000000BD + cast(seq as decimal(19,0))").cast("decimal(38,0)")


def partial_candles(ticks: DataFrame, period: int) -> DataFrame:
    """Partial candles of the ticks given, whatever ticks others have seen."""
    d = ticks.select(
        "exchange", "trading_pair", F.lit(period).alias("period"), F.expr(f"(micros div {period * 1_000_000}L) * {period}L").alias("timestamp"),
        order_key().alias("first"), order_key().alias("last"), *[F.col("price").alias(c) for c in OHLCV[:4]], F.col("qty").alias("volume"),
        F.lit(1).cast("long").alias("n"),
    )
    return merged(d)


def merged(partials: DataFrame) -> DataFrame:
    """One partial candle per key; merging merged ones changes nothing."""
    return partials.groupBy(*PK).agg(
        F.min("first").alias("_first"), F.max("last").alias("_last"),
        F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "last").alias("close"), F.sum("volume").alias("volume"), F.sum("n").alias("n"),
    ).select(*PK, F.col("_first").alias("first"), F.col("_last").alias("last"), *OHLCV, "n")


def _whole(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The deltas to read: ranges of batches that were written whole, none inside another."""
    ranges = [tuple(map(int, n.split("-"))) for n in names_in(spark, path) if n.replace("-", "").isdigit()]
    ranges = [r for r in ranges if "_SUCCESS" in names_in(spark, _folder(path, r))]
    return sorted(r for r in ranges if not any(r != o and o[0] <= r[0] and r[1] <= o[1] for o in ranges))


def _folder(path: str, batches: tuple[int, int]) -> str:
    return f"{path}/{batches[0]:09d}-{batches[1]:09d}"


def write_deltas(ticks: DataFrame, period: int, path: str, checkpoint: str) -> None:
    """Each micro-batch of a tick stream as one delta; runs on what is available and resumes from the checkpoint."""

    def each(batch: DataFrame, number: int) -> None:
        partial_candles(batch, period).write.mode("overwrite").parquet(_folder(path, (number, number)))

    run_batches(ticks, each, checkpoint)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All partial candles, merged."""
    folders = [_folder(path, r) for r in _whole(spark, path)]
    return merged(spark.read.schema(PARTIAL).parquet(*folders)) if folders else spark.createDataFrame([], PARTIAL)


def candles(spark: SparkSession, path: str, since: int | None = None) -> DataFrame:
    """The candles as all ticks so far make them, of buckets from ``since`` on."""
    found = stored(spark, path)
    return (found if since is None else found.where(F.col("timestamp") >= since)).select(*PK, *OHLCV)


def compact(spark: SparkSession, path: str, fan_in: int = 8) -> int:
    """Merge runs of ``fan_in`` neighbouring deltas of like width into one, while there are any; how many were written.

    The sources stay until ``clean``, so readers that began before are not disturbed, and a broken run leaves nothing readable.
    """
    written = 0
    while True:
        found = _whole(spark, path)
        tier = [(b - a + 1).bit_length() for a, b in found]
        run = next((found[i : i + fan_in] for i in range(len(found) - fan_in + 1) if len({*tier[i : i + fan_in]}) == 1), None)
        if run is None:
            return written
        sources = spark.read.schema(PARTIAL).parquet(*[_folder(path, r) for r in run])
        merged(sources).write.mode("overwrite").parquet(_folder(path, (run[0][0], run[-1][1])))
        written += 1


def clean(spark: SparkSession, path: str) -> int:
    """Remove deltas that a wider one has replaced; how many."""
    keep = {_folder(path, r) for r in _whole(spark, path)}
    gone = [f"{path}/{n}" for n in names_in(spark, path) if n.replace("-", "").isdigit() and f"{path}/{n}" not in keep]
    for folder in gone:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(gone)
