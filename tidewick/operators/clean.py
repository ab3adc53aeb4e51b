"""Projection, filtering and null repair."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.functions.scalar import seconds_to_datetime
from tidewick.operators.chunks import attach
from tidewick.schema import OHLCV, SERIES

# fixed values: both bounds are exclusive (years 2000 to 2030)
TS_MIN, TS_MAX = 947_362_914, 1_894_131_876
NUMERIC = ["period", *OHLCV, "arb_diff", "arb_signal"]


def time_slice(df: DataFrame, start: int, end: int) -> DataFrame:
    """Rows strictly between ``start`` and ``end``."""
    return df.where((F.col("timestamp") > start) & (F.col("timestamp") < end))


def fix_types(df: DataFrame) -> DataFrame:
    """Known numeric columns as doubles where present, plus ``datetime``."""
    casts = {c: F.col(c).cast("double") for c in NUMERIC if c in df.columns}
    return df.withColumns({**casts, "datetime": seconds_to_datetime(F.col("timestamp").cast("long"))})


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns]))


def numeric_projection(df: DataFrame, drop: Sequence[str] = ("period",), drop_prefix: str = "timestamp_") -> DataFrame:
    keep = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in drop and not f.name.startswith(drop_prefix)
    ]
    return df.select(*keep)


def null_ratios(df: DataFrame) -> dict[str, float]:
    """Share of nulls per column: one pass, one row to the driver."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return {c: row[c] for c in df.columns}


def drop_sparse_columns(df: DataFrame, limit: float = 0.2) -> DataFrame:
    """Keep columns whose null ratio lies below ``limit``."""
    ratios = null_ratios(df)
    return df.select(*[c for c in df.columns if ratios[c] is None or ratios[c] < limit])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep columns without any null."""
    ratios = null_ratios(df)
    return df.select(*[c for c in df.columns if not ratios[c]])


def _doubles(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def is_infinite(c: Column) -> Column:
    return F.abs(c) == float("inf")


def clean_infinite(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~is_infinite(F.col(c)), F.col(c)) for c in _doubles(df)})


def zero_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null, NaN and infinite values become 0."""
    fill = "case when `{0}` is null or isnan(`{0}`) or abs(`{0}`) = double('inf') then 0D else `{0}` end"
    return df.withColumns({c: F.expr(fill.format(c)) for c in (columns or _doubles(df))})


def mean_impute(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    """Nulls become the series' column mean."""
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns])
    out = attach(df, means, keys)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_mean_{c}")) for c in columns}).drop(
        *[f"_mean_{c}" for c in columns]
    )


def is_valid_candle() -> Column:
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*OHLCV, "timestamp"]])
    return complete & (F.col("timestamp") > TS_MIN) & (F.col("timestamp") < TS_MAX)


def validate_candles(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) candles."""
    ok = F.coalesce(is_valid_candle(), F.lit(False))
    return df.where(ok), df.where(~ok)


def closed_candles(df: DataFrame, now: int) -> DataFrame:
    """Candles whose period is over at ``now``."""
    return df.where(F.col("timestamp") + F.col("period") <= now)


def eligible_series(
    df: DataFrame, minimums: dict[str, tuple[Column, int]], keys: Sequence[str] = SERIES
) -> DataFrame:
    """Series where, for every named condition, more than the given number of rows hold it."""
    counts = df.groupBy(*keys).agg(*[F.count_if(cond).alias(name) for name, (cond, _) in minimums.items()])
    return counts.where(reduce(lambda a, b: a & b, [F.col(n) > least for n, (_, least) in minimums.items()]))
