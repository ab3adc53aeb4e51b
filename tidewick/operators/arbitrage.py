"""Arbitrage states between exchanges, how long they last, and training labels."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewick.functions import scalar
from tidewick.operators.chunks import attach, drop_halo, halo_window, running, with_halo
from tidewick.schema import PAIR

C1, C2 = "close_exchange_1", "close_exchange_2"


def with_state(df: DataFrame, fee: float = scalar.ARBITRAGE_FEE) -> DataFrame:
    a, b = F.col(C1), F.col(C2)
    return df.withColumns(
        {
            "higher_closing_price": scalar.higher_close(a, b),
            "pct_higher": scalar.pct_higher(a, b),
            "arbitrage_opportunity": scalar.arbitrage_state(a, b, fee),
        }
    )


def window_length(
    df: DataFrame,
    state: str = "arbitrage_opportunity",
    keys: Sequence[str] = PAIR,
    wrap_first: bool = False,
) -> DataFrame:
    """Minutes the current state has lasted, in ``window_length``; one period on a change.

    A run is identified by its start time, carried forward as a running maximum, so a run may
    span any number of chunks without being gathered.  Rows must be gap-free.
    ``wrap_first`` counts one period more on the first run when the series ends in its state.
    """
    prev = F.lag(state).over(halo_window(keys))
    changed = F.col("_prev").isNull() | (F.col("_prev") != F.col(state))
    d = with_halo(df, back=1).withColumn("_prev", prev)
    d = drop_halo(d.withColumn("_change_at", F.when(changed, F.col("timestamp"))), keep_chunk=True).drop("_prev")
    d = running(d, {"_start": ("max", "_change_at")}, keys).drop("_change_at", "_chunk")
    lasted = F.col("timestamp") - F.col("_start") + F.col("period")
    if wrap_first:
        ends = df.groupBy(*keys).agg(
            F.min("timestamp").alias("_t0"),
            F.min_by(state, "timestamp").alias("_s0"),
            F.max_by(state, "timestamp").alias("_s1"),
        )
        d = attach(d, ends, keys)
        again = (F.col("_start") == F.col("_t0")) & (F.col("_s0") == F.col("_s1"))
        lasted = lasted + F.when(again, F.col("period")).otherwise(0)
    return d.withColumn("window_length", (lasted / 60).cast("long")).drop("_start", "_t0", "_s0", "_s1")


def _rows_ahead(interval: int, period: int) -> int:
    return interval // period


def with_target(df: DataFrame, interval: int, period: int, keys: Sequence[str] = PAIR) -> DataFrame:
    """Label: the state one period after ``interval`` seconds if it lasted that long, else 0.

    Rows too close to the series' end to know it are dropped.
    """
    ahead = _rows_ahead(interval, period) + 1
    w = halo_window(keys)
    d = with_halo(df, ahead=ahead).withColumns(
        {
            "arbitrage_opportunity_shift": F.lead("arbitrage_opportunity", ahead).over(w),
            "window_length_shift": F.lead("window_length", ahead).over(w),
        }
    )
    lasted = F.col("window_length_shift") >= interval // 60
    d = d.withColumn("target", F.when(lasted, F.col("arbitrage_opportunity_shift")).otherwise(0))
    return drop_halo(d).where(F.col("arbitrage_opportunity_shift").isNotNull())


def _profit(sold_1: Column, sold_2: Column, fee: float) -> Column:
    a, b = F.col(C1), F.col(C2)
    side = scalar.higher_close(a, b)
    gain = lambda sold, bought: (F.try_divide(sold, bought) - 1) * 100 - fee
    return F.when(side == 1, gain(sold_1, b)).when(side == 2, gain(sold_2, a)).otherwise(0.0)


def with_profit(
    df: DataFrame, interval: int, period: int, keys: Sequence[str] = PAIR, fee: float = scalar.ARBITRAGE_FEE
) -> DataFrame:
    """Percent gained by buying low two periods from now and selling ``interval`` + 2 periods later."""
    ahead = _rows_ahead(interval, period) + 2
    w = halo_window(keys)
    d = with_halo(df, ahead=ahead + 2).withColumns(
        {f"{c}_shift": F.lead(c, ahead).over(w) for c in (C1, C2)}
    )
    d = d.withColumn("_profit", _profit(F.col(f"{C1}_shift"), F.col(f"{C2}_shift"), fee))
    d = d.withColumn("pct_profit", F.lead("_profit", 2).over(w)).drop("_profit")
    return drop_halo(d)


def markers(df: DataFrame, prediction: str = "pred") -> DataFrame:
    """Signed price difference, and where each direction is predicted."""
    diff = scalar.pct_diff(F.col(C1), F.col(C2))
    p = F.col(prediction)
    return df.withColumns(
        {"pct_diff": diff, "arb_ex1_ex2": F.when(p == 1, diff), "arb_ex2_ex1": F.when(p == -1, diff)}
    )
