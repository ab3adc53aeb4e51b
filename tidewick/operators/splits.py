"""Train / test splits along time."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.operators.chunks import attach, row_positions
from tidewick.schema import SERIES

WEEK = 7 * 86_400


def embargo_split(
    df: DataFrame, ratio: float = 0.7, embargo: int = WEEK, keys: Sequence[str] = SERIES
) -> DataFrame:
    """``part``: train before, test after the row at ``ratio`` of the series, ``embargo`` seconds apart."""
    d = row_positions(df, keys)
    at_split = F.col("pos") == F.bround(F.col("n_rows") * ratio).cast("long")
    split = d.where(at_split).select(*keys, F.col("timestamp").alias("split_ts"))
    out = attach(df, split, keys)
    part = F.when(F.col("timestamp") < F.col("split_ts") - embargo, "train").when(
        F.col("timestamp") > F.col("split_ts") + embargo, "test"
    )
    return out.withColumn("part", part).where(F.col("part").isNotNull())


def ordered_split(df: DataFrame, ratio: float = 0.8, keys: Sequence[str] = SERIES) -> DataFrame:
    """``part``: the first ``ratio`` of each series' rows train, the rest test."""
    d = row_positions(df, keys)
    is_train = F.col("pos") < F.floor(F.col("n_rows") * ratio)
    return d.withColumn("part", F.when(is_train, "train").otherwise("test")).drop("pos", "n_rows")


def date_split(df: DataFrame, train_before: int, test_after: int) -> DataFrame:
    part = F.when(F.col("timestamp") < train_before, "train").when(F.col("timestamp") > test_after, "test")
    return df.withColumn("part", part).where(F.col("part").isNotNull())


def batch_split(df: DataFrame, batch: int, ratio: float = 0.8, keys: Sequence[str] = SERIES) -> DataFrame:
    """Split with both parts cut to a multiple of ``batch`` rows; the remainder is dropped."""
    d = row_positions(df, keys)
    train = F.floor(F.col("n_rows") * ratio)
    d = d.withColumn("_train", train - train % batch)
    rest = F.col("n_rows") - F.col("_train")
    d = d.withColumn("_total", F.col("_train") + rest - rest % batch).where(F.col("pos") < F.col("_total"))
    part = F.when(F.col("pos") < F.col("_train"), "train").otherwise("validation")
    return d.withColumn("part", part).drop("_train", "_total", "n_rows")


def ordered_slices(df: DataFrame, parts: int = 6, keys: Sequence[str] = SERIES) -> DataFrame:
    """``slice`` 0..parts-1 of equal length along each series; rows past the last slice drop out."""
    d = row_positions(df, keys)
    length = F.floor(F.col("n_rows") / parts)
    d = d.where(F.col("pos") < length * parts)
    return d.withColumn("slice", F.floor(F.col("pos") / length)).drop("pos", "n_rows")
