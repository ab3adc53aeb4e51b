"""Writers of candle and prediction tables, snapshots and archives.

Plain Parquet has no MERGE, so an insert-if-absent is an anti-join against the stored keys followed
by an append, with one writer per table.  Only the stored partitions and the time range that the new
rows touch are read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewick.operators.chunks import edge_rows
from tidewick.operators.gaps import dedupe_candles
from tidewick.operators.joins import new_rows
from tidewick.schema import CANDLE, OHLC, PK
from tidewick.session import materialise

LAYOUT = ["period", "exchange"]
# one writing task gets at most so many candles of a series, whatever its period
BUCKET_ROWS = 1 << 17
# partition values of a batch up to which the stored side is pruned by each one's own time range
PRUNED_VALUES = 1000


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = _path(spark, path)
    fs.create(p, True).close()


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def create_table(spark: SparkSession, path: str, schema=CANDLE, partition_by: Sequence[str] = LAYOUT) -> DataFrame:
    """An empty table in the given layout, if there is none yet."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_candles(candles: DataFrame, path: str, mode: str = "append") -> None:
    """Candles partitioned by period and exchange, sorted by pair and time within files.

    A partition value's rows spread over the writing tasks by pair and time, at most ``BUCKET_ROWS`` candles
    each; files hold few pairs and a time range, so that scans of one series skip the others.
    """
    _spread(candles, LAYOUT).write.mode(mode).partitionBy(*LAYOUT).parquet(path)


def _spread(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    if not {"timestamp", "period", "trading_pair"} <= set(rows.columns):
        return rows
    bucket = F.expr(f"timestamp div (period * {BUCKET_ROWS}L)")
    order = list(dict.fromkeys([*partition_by, "trading_pair", "timestamp"]))
    return rows.repartition(*order[:-1], bucket).sortWithinPartitions(*order)


def touched(stored: DataFrame, rows: DataFrame, partition_by: Sequence[str], time: str | None) -> DataFrame:
    """``stored`` without the partitions and times that ``rows`` (a stored table) cannot meet."""
    low, high = (F.min(time), F.max(time)) if time else (F.lit(None), F.lit(None))
    found = rows.groupBy(*partition_by).agg(low.alias("_low"), high.alias("_high")).limit(PRUNED_VALUES + 1).collect()
    if not found:
        return stored.limit(0)
    if len(found) > PRUNED_VALUES:
        if not time:
            return stored
        ends = rows.agg(low.alias("_low"), high.alias("_high")).first()
        return stored.where(F.col(time).between(ends["_low"], ends["_high"]))
    any_of = F.lit(False)
    for r in found:
        one = F.lit(True) if not time else F.col(time).between(r["_low"], r["_high"])
        for c in partition_by:
            one = one & (F.col(c) == F.lit(r[c]))
        any_of = any_of | one
    return stored.where(any_of)


def insert_if_absent(
    new: DataFrame,
    path: str,
    keys: Sequence[str] = PK,
    prefer: Sequence[str] = OHLC,
    partition_by: Sequence[str] = LAYOUT,
    time: str | None = "timestamp",
) -> None:
    """Append the rows whose key the table lacks; of copies in ``new`` the least by ``prefer``.

    ``time``: the key column whose range in ``new`` bounds what is read of the table.
    """
    spark = new.sparkSession
    rows = dedupe_candles(new, [c for c in prefer if c not in keys], keys)
    if exists(spark, path):
        rows = materialise(rows, "insert")
        stored = spark.read.schema(new.schema).parquet(path)
        rows = new_rows(rows, touched(stored, rows, partition_by, time), keys)
    _spread(rows, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def flatten_batches(batches: DataFrame, candles: str = "candles") -> DataFrame:
    """{scalars, candles: [..]} -> one row per candle."""
    scalars = [c for c in batches.columns if c != candles]
    return batches.select(*scalars, F.explode(candles).alias("_c")).select(*scalars, "_c.*")


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def file_stem() -> Column:
    return F.concat_ws("_", "exchange", "trading_pair", F.col("period").cast("string"))


def write_csv_archive(candles: DataFrame, path: str) -> None:
    """One directory ``<exchange>_<pair>_<period>`` of CSV files per series, newest first in a file."""
    out = candles.select(
        file_stem().alias("series"),
        F.lit(None).cast("long").alias("row"),
        (F.col("timestamp") + F.col("period")).alias("closing_time"),
        *OHLC,
        F.col("volume").alias("base_volume"),
    )
    spread = out.repartition("series", F.expr("closing_time div 604800"))
    spread.sortWithinPartitions("series", F.col("closing_time").desc()).write.partitionBy("series").option(
        "header", True
    ).csv(path)


def versions(spark: SparkSession, base: str, prefix: str = "V") -> list[int]:
    """The numbers of the folders ``<prefix><n>`` below ``base``."""
    fs, p = _path(spark, base)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName().removeprefix(prefix) for s in fs.listStatus(p) if s.getPath().getName().startswith(prefix)]
    return sorted(int(n) for n in names if n.isdigit())


def next_version(spark: SparkSession, base: str) -> int:
    return 1 + max(versions(spark, base), default=0)


def export_snapshot(candles: DataFrame, base: str, newest: int = 500) -> str:
    """The newest rows of every series to the next ``V<n>``, all history to the next ``history/V<n>``.

    Nothing is overwritten, so ``candles`` may be read from an earlier snapshot; :func:`current_history`
    gives the newest history that is complete.
    """
    spark = candles.sparkSession
    target = f"{base}/V{next_version(spark, base)}"
    edge_rows(candles, newest).drop("rank").write.mode("errorifexists").partitionBy(*LAYOUT).parquet(target)
    write_candles(candles, f"{base}/history/V{next_version(spark, f'{base}/history')}", mode="errorifexists")
    return target


def current_history(spark: SparkSession, base: str) -> str:
    """The path of the newest history whose write has finished."""
    at = next_version(spark, f"{base}/history") - 1
    while at > 0 and not exists(spark, f"{base}/history/V{at}/_SUCCESS"):
        at -= 1
    if at < 1:
        raise FileNotFoundError(f"no complete history below {base}")
    return f"{base}/history/V{at}"


def write_predictions(
    new: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), time: str = "p_time"
) -> None:
    """Append predictions whose key (time and series) is not stored yet."""
    rest = [c for c in new.columns if c not in keys]
    insert_if_absent(new, path, keys, rest, list(partition_by), time)

