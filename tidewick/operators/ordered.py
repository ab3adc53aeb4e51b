"""Ordered analytics over every series: differences, classes, rolling moments, scans, windows."""

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.functions.scalar import three_way
from tidewick.operators import scan
from tidewick.operators.chunks import (
    attach,
    drop_halo,
    edge_rows,
    halo_window,
    neighbour,
    row_positions,
    with_halo,
)
from tidewick.operators.gaps import fill_backward
from tidewick.schema import SERIES


def _halo(df: DataFrame, back: int, ahead: int, gap_free: bool, keys: Sequence[str] = SERIES) -> DataFrame:
    """Halo by time where rows are evenly spaced, else by counted row positions."""
    if gap_free:
        return with_halo(df, back, ahead)
    return with_halo(row_positions(df, keys), back, ahead, F.col("pos"))


def shifted(
    df: DataFrame, columns: dict[str, str], offset: int, gap_free: bool = False, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Add ``{new: source}`` taken ``offset`` rows later (or earlier, if negative) in the series."""
    if not gap_free and abs(offset) == 1:
        return neighbour(df, columns, offset, keys)
    d = _halo(df, max(0, -offset), max(0, offset), gap_free, keys)
    d = d.withColumns({new: F.lead(src, offset).over(halo_window(keys)) for new, src in columns.items()})
    return drop_halo(d) if gap_free else drop_halo(d).drop("pos", "n_rows")


def close_diff(df: DataFrame, gap_free: bool = False) -> DataFrame:
    """Relative change of the close against the row before."""
    d = shifted(df, {"_prev": "close"}, -1, gap_free)
    return d.withColumn("close_diff", F.try_divide(F.col("close") - F.col("_prev"), F.col("_prev"))).drop("_prev")


def trade_target(df: DataFrame, threshold: float = 0.007, gap_free: bool = False) -> DataFrame:
    """Whether the next row's close rises by more than ``threshold``; first and last row drop out."""
    d = df if "close_diff" in df.columns else close_diff(df, gap_free)
    d = shifted(d, {"_next": "close_diff"}, +1, gap_free)
    known = F.col("close_diff").isNotNull() & F.col("_next").isNotNull()
    return d.where(known).withColumn("target", F.col("_next") - threshold > 0).drop("_next")


def price_direction(df: DataFrame, steps: int = 12, gap_free: bool = False) -> DataFrame:
    """1 where the close ``steps`` rows ago was higher than now, -1 where lower, else 0."""
    d = shifted(df, {"_past": "close"}, -steps, gap_free)
    label = F.when(F.col("_past") > F.col("close"), 1).when(F.col("_past") < F.col("close"), -1).otherwise(0)
    return d.withColumn("price_increased", label).drop("_past")


def arb_signal_class(
    df: DataFrame, high: float = 0.01, low: float = 0.01, offset: int = -1, gap_free: bool = False
) -> DataFrame:
    """Class of the neighbouring row's signal: 1 above ``high``, -1 below ``low``, else 0."""
    d = shifted(df, {"_signal": "arb_signal"}, offset, gap_free)
    return d.withColumn("arb_signal_class", three_way(F.col("_signal"), F.lit(low), F.lit(high))).drop("_signal")


def diff_features(df: DataFrame, columns: Sequence[str], gap_free: bool = False) -> DataFrame:
    """``x - previous x`` of every column as ``x_diff``; the first row differs against 0."""
    d = shifted(df, {f"_prev_{c}": c for c in columns}, -1, gap_free)
    return d.withColumns({f"{c}_diff": F.col(c) - F.coalesce(F.col(f"_prev_{c}"), F.lit(0)) for c in columns}).drop(
        *[f"_prev_{c}" for c in columns]
    )


def sample_skew(skew: Column, n: int) -> Column:
    """Bias-corrected skewness from the population value."""
    return skew * (math.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(kurt: Column, n: int) -> Column:
    """Bias-corrected excess kurtosis from the population value."""
    return (kurt * (n + 1) + 6) * ((n - 1) / ((n - 2) * (n - 3)))


def rolling_moments(df: DataFrame, columns: Sequence[str], n: int = 6, gap_free: bool = False) -> DataFrame:
    """Mean, sample deviation, skewness and excess kurtosis of the last ``n`` rows, backfilled."""
    d = _halo(df, n - 1, 0, gap_free)
    w = halo_window().rowsBetween(-(n - 1), 0)
    out = {}
    for c in columns:
        full = F.count(c).over(w) == n
        flat = F.max(c).over(w) == F.min(c).over(w)
        out[f"{c}_mean"] = F.when(full, F.avg(c).over(w))
        out[f"{c}_std"] = F.when(full, F.stddev_samp(c).over(w))
        out[f"{c}_skew"] = F.when(full & ~flat, sample_skew(F.skewness(c).over(w), n)).when(full, 0.0)
        out[f"{c}_kurt"] = F.when(full & ~flat, sample_kurtosis(F.kurtosis(c).over(w), n)).when(full, -3.0)
    d = drop_halo(d.withColumns(out)).drop("pos", "n_rows")
    return fill_backward(d, list(out))


def rolling_log_mean(df: DataFrame, n: int, gap_free: bool = False) -> DataFrame:
    """``log(close)`` and the log of its mean over the last ``n`` rows (null until n rows exist)."""
    d = _halo(df, n - 1, 0, gap_free)
    w = halo_window().rowsBetween(-(n - 1), 0)
    mean = F.when(F.count("close").over(w) == n, F.avg("close").over(w))
    d = d.withColumns({"log_close": F.log("close"), "log_mean": F.log(mean)})
    return drop_halo(d).drop("pos", "n_rows")


def denoise(df: DataFrame, column: str, repeat: int, keys: Sequence[str] = SERIES) -> DataFrame:
    """``repeat`` smoothing passes ``y[i] = (y[i-1] + x[i+1]) / 2``; both ends keep their value."""
    half = 0.5
    back = scan.rows_needed(half) + 64 * repeat
    d = with_halo(row_positions(df, keys), back, repeat, F.col("pos"))
    ends_here = F.col("pos") == F.col("n_rows") - 1
    d = d.withColumn("denoised", F.col(column))
    for _ in range(repeat):
        ahead = F.lead("denoised").over(halo_window(keys))
        d = d.withColumn("_ahead", F.coalesce(ahead, F.col("denoised")))
        b = f"case when pos = 0 then denoised else _ahead * {half}D end"
        d = scan.affine_scan(d, {"_smooth": (b, half)}, keys)
        d = d.withColumn("denoised", F.when(ends_here, F.col("denoised")).otherwise(F.col("_smooth")))
        d = d.drop("_smooth", "_ahead")
    return drop_halo(d).drop("pos", "n_rows")


def rebase_to_first(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    """``x / (first x + 1e-5) - 1``; ``<x>_first`` stays for :func:`rebase_inverse`."""
    firsts = df.groupBy(*keys).agg(*[F.min_by(c, "timestamp").alias(f"{c}_first") for c in columns])
    d = attach(df, firsts, keys)
    return d.withColumns({f"{c}_rebased": F.col(c) / (F.col(f"{c}_first") + 1e-5) - 1 for c in columns})


def rebase_inverse(rebased: Column, first: Column) -> Column:
    return (1 + rebased) * first


def signed_log(name: str) -> str:
    return f"signum(`{name}`) * log1p(abs(`{name}`))"


def signed_exp(c: Column) -> Column:
    """Inverse of the signed log."""
    return F.signum(c) * F.expm1(F.abs(c))


def signed_log_stats(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    """Mean and population deviation of the signed logs, one row per series."""
    calls = {"mu": "avg", "sigma": "stddev_pop"}
    aggs = [F.expr(f"{f}({signed_log(c)}) as `{c}_{name}`") for c in columns for name, f in calls.items()]
    return df.groupBy(*keys).agg(*aggs)


def signed_log_zscore(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SERIES) -> DataFrame:
    """``<x>_z``: z-score of the signed log within the series; null where a series is constant."""
    d = attach(df, signed_log_stats(df, columns, keys), keys)
    z = [f"try_divide({signed_log(c)} - `{c}_mu`, `{c}_sigma`) as `{c}_z`" for c in columns]
    return d.selectExpr("*", *z)


def denormalize(z: Column, mu: Column, sigma: Column, signed: bool = True) -> Column:
    """Back from the z-score; the plain form holds for non-negative values only."""
    y = z * sigma + mu
    return signed_exp(y) if signed else F.exp(y) - 1


WINDOW_CELLS = 1 << 20  # numbers in a batch of expanded windows
_BLOCK = "times binary, values binary, first int, own int"


def window_blocks(
    df: DataFrame, features: Sequence[str], target: str, history: int, reach: int, gap_free: bool = False
) -> DataFrame:
    """The rows of every chunk as one block of bytes, with the ``history`` rows before it and ``reach`` rows after it.

    Windows are places in a block: what is stored or shuffled grows with rows x features, not with the history.
    ``expand_windows`` makes them where they are used.
    """
    columns = [*features, target]
    d = _halo(df.select(*SERIES, "timestamp", *dict.fromkeys(columns)), history, reach, gap_free)
    d = d.select(*SERIES, "_chunk", "_pos", "_core", "timestamp", F.array(*[F.col(c).cast("double") for c in columns]).alias("_v"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        values = table.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
        own = np.flatnonzero(table.column("_core").to_numpy())
        return pa.table({
            **{k: table.column(k).slice(0, 1) for k in SERIES}, "times": [table.column("timestamp").to_numpy().astype(np.int64).tobytes()],
            "values": [values.tobytes()], "first": pa.array([own[0] if len(own) else 0], pa.int32()), "own": pa.array([len(own)], pa.int32()),
        })

    schema = T.StructType([*[d.schema[k] for k in SERIES], *T.StructType.fromDDL(_BLOCK).fields])
    return d.groupBy(*SERIES, "_chunk").applyInArrow(pack, schema).where("own > 0")


def expand_windows(
    blocks: DataFrame, n_features: int, history: int, step: int, ahead: int, single_step: int | None, target_type: T.DataType
) -> DataFrame:
    """The windows of ``window_blocks`` as rows: series, timestamp, ``x`` and ``y``; a NaN comes out as null."""
    reach = single_step if single_step is not None else ahead
    later = np.array([single_step]) if single_step is not None else np.arange(ahead)
    before = np.arange(-history, 0, step)

    def nested(values: np.ndarray) -> pa.Array:
        out = pa.array(values.ravel(), from_pandas=True)
        for size in reversed(values.shape[1:]):
            out = pa.ListArray.from_arrays(pa.array(np.arange(0, len(out) + 1, size), pa.int32()), out)
        return out

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                times = np.frombuffer(batch.column("times")[i].as_py(), np.int64)
                values = np.frombuffer(batch.column("values")[i].as_py(), float).reshape(-1, n_features + 1)
                first, own = batch.column("first")[i].as_py(), batch.column("own")[i].as_py()
                rows = np.arange(max(first, history), min(first + own, len(times) - reach))
                most = max(1, WINDOW_CELLS // (len(before) * n_features))
                for part in np.split(rows, range(most, len(rows), most)):
                    x = values[part[:, None] + before, :n_features]
                    y = values[part[:, None] + later, n_features]
                    keys = [pa.repeat(batch.column(k)[i], len(part)) for k in SERIES]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(times[part]), nested(x), nested(y)], names=[*SERIES, "timestamp", "x", "y"])

    schema = T.StructType([*[blocks.schema[k] for k in SERIES], *T.StructType.fromDDL("timestamp long, x array<array<double>>, y array<double>").fields])
    return blocks.mapInArrow(expand, schema).withColumn("y", F.col("y").cast(T.ArrayType(target_type)))


def supervised_windows(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    history: int,
    step: int = 1,
    ahead: int = 1,
    single_step: int | None = None,
    gap_free: bool = False,
) -> DataFrame:
    """``x``: every ``step``-th feature row of the ``history`` rows before; ``y``: the rows to predict.

    ``y`` holds the target of this and the following rows (``ahead`` of them), or with
    ``single_step`` only that of the row so many rows later.  Incomplete windows are dropped.
    To keep windows, store ``window_blocks`` and expand them where they are read.
    """
    reach = single_step if single_step is not None else ahead
    blocks = window_blocks(df, features, target, history, reach, gap_free)
    return expand_windows(blocks, len(features), history, step, ahead, single_step, df.schema[target].dataType)


def latest_features(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The newest row of every series."""
    return edge_rows(df, 1, keys=keys).drop("rank")


def forecast_grid(df: DataFrame, n: int, start_offset: int = 1, keys: Sequence[str] = SERIES) -> DataFrame:
    """``n`` future timestamps per series, the first ``start_offset`` periods after the last row."""
    last = df.groupBy(*keys).agg(F.max("timestamp").alias("last_ts"))
    steps = F.sequence(F.lit(start_offset), F.lit(start_offset + n - 1))
    d = last.select(*keys, "last_ts", F.posexplode(steps).alias("i", "_step"))
    return d.withColumn("forecast_ts", F.col("last_ts") + F.col("period") * F.col("_step")).drop("_step")


def regime_transitions(df: DataFrame, state: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Share of moves from each state to each next state, per series."""
    d = neighbour(df, {"next_state": state}, +1, keys).where(F.col("next_state").isNotNull())
    counts = d.groupBy(*keys, F.col(state).alias("state"), "next_state").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys, "state"))
    return counts.withColumn("probability", F.col("n") / total)
