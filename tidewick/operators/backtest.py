"""Backtests of up/down predictions with trading fees."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.functions.scalar import TRADE_FEE
from tidewick.operators.chunks import drop_halo, halo_window, row_positions, running, with_halo
from tidewick.schema import SERIES

# fixed value: money at the start of a backtest
ACCOUNT = 10_000.0


def _positions(df: DataFrame, prediction: str, keys: Sequence[str]) -> DataFrame:
    """``pos``, ``binary_y_preds`` (in the market) and ``trade_trig`` where that changes (null on rows 0, 1).

    Keeps ``_chunk`` for the running values that follow.
    """
    w = halo_window(keys)
    d = with_halo(row_positions(df, keys).drop("n_rows"), 2, 0, F.col("pos"))
    held = lambda k: F.when(F.lag(prediction, k).over(w), 1).otherwise(0)
    d = d.withColumns({"binary_y_preds": held(1), "_before": held(2)})
    d = d.withColumn("trade_trig", F.when(F.col("pos") >= 2, F.col("binary_y_preds") - F.col("_before")))
    return drop_halo(d, keep_chunk=True).drop("_before")


def trade_triggers(df: DataFrame, prediction: str = "y_pred", keys: Sequence[str] = SERIES) -> DataFrame:
    """Trade on the row after a prediction: held rows, their running count and 1 / -1 on entry / exit."""
    d = _positions(df, prediction, keys)
    d = running(d, {"preds_count": ("sum", "binary_y_preds")}, keys)
    increase = F.when(F.col("pos") >= 1, F.col("binary_y_preds"))
    return d.withColumn("increase_count", increase).drop("pos", "_chunk")


def backtest_summary(
    df: DataFrame, prediction: str = "y_pred", keys: Sequence[str] = SERIES, fee: float = TRADE_FEE
) -> DataFrame:
    """Gross and net result of each series; every entry pays the fee twice."""
    d = _positions(df, prediction, keys)
    out = d.groupBy(*keys).agg(
        F.coalesce(F.sum(F.col("binary_y_preds") * F.col("close_diff")), F.lit(0.0)).alias("pct_gain"),
        F.count_if(F.col("trade_trig") == 1).alias("entries"),
    )
    out = out.withColumns(
        {"gain": F.col("pct_gain") * ACCOUNT, "fees": F.col("entries") * (2 * fee / 100 * ACCOUNT)}
    )
    net = F.col("gain") - F.col("fees")
    return out.withColumns({"net_profit": net, "pct_net_profit": net / ACCOUNT})


def equity_curve(
    df: DataFrame, prediction: str = "y_pred", keys: Sequence[str] = SERIES, fee: float = TRADE_FEE
) -> DataFrame:
    """Money over time: indicator 2 buy, 1 hold, -1 out, -2 sell; an entry on the second row counts."""
    d = _positions(df, prediction, keys)
    entered = (F.col("pos") == 1) & (F.col("binary_y_preds") == 1)
    d = d.withColumn("trade_trig", F.when(entered, 1).otherwise(F.col("trade_trig")))
    d = d.withColumns(
        {
            "_move": F.when(F.col("trade_trig") != 0, F.col("trade_trig")),
            "_growth": F.when(F.col("pos") > 0, F.log1p("close_diff")).otherwise(0.0),
        }
    )
    d = running(d, {"_side": ("last", "_move"), "_held": ("sum", "_growth")}, keys)
    d = d.withColumn("profit_indicator", F.coalesce(F.col("_side") + F.col("trade_trig"), F.lit(-1)).cast("double"))
    side = F.col("profit_indicator")
    d = d.withColumns(
        {
            "profit": F.when(side.isin(-2.0, -1.0), 0.0).otherwise(F.col("close_diff")),
            "fees": F.when(side.isin(-2.0, 2.0), fee / 100).otherwise(0.0),
        }
    )
    d = d.withColumn("net_profit", F.col("profit") - F.col("fees"))
    d = running(d, {"cum_net_profit": ("sum", "net_profit")}, keys)
    d = d.withColumn("my_money", F.col("cum_net_profit") * ACCOUNT + ACCOUNT)
    return d.withColumns(
        {
            "buy_hold": F.exp("_held") * ACCOUNT,
            "buy": F.when(side == 2, F.col("my_money")).otherwise(0.0),
            "sell": F.when(side == -2, F.col("my_money")).otherwise(0.0),
        }
    ).drop("_move", "_growth", "_side", "_held", "pos", "_chunk")


def buy_and_hold(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The account compounded with every close change; needs ``close_diff`` (null counts as no change)."""
    d = df.withColumn("_growth", F.coalesce(F.log1p("close_diff"), F.lit(0.0)))
    d = running(d, {"_held": ("sum", "_growth")}, keys)
    return d.withColumn("buy_hold", F.exp("_held") * ACCOUNT).drop("_growth", "_held")
