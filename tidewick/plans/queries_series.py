"""Registered queries: gaps, ordered analytics, arbitrage labels, backtests, splits."""

from pyspark.sql import functions as F

from tidewick.operators import arbitrage, backtest, gaps, ordered, splits
from tidewick.operators.joins import arb_info
from tidewick.plans import base
from tidewick.plans.base import (
    HOUR,
    K,
    OHLCV_SQL,
    PAIR_PK,
    PK,
    PRICES,
    W,
    candles,
    grid,
    restated,
    runs,
    sql,
    targets,
    tidy,
)
from tidewick.schema import OHLC, OHLCV, PAIR
from tidewick.schema import PK as PK_COLS
from tidewick.sources.candles import latest_k

QUERIES, ORACLES = {}, {}


def add(key, query, oracle=None):
    QUERIES[key] = query
    if oracle is not None:
        ORACLES[key] = oracle


# --- gaps and duplicates ---------------------------------------------------------------------

add(
    "gap_fill",
    lambda s, d: tidy(grid(s, d)),
    sql(f"select {PK}, {OHLCV_SQL}, nan_ohlcv from grid", PRICES),
)
_LEAD = f"""(select *, lead("timestamp") over ({W}) as ntimestamp from candles)"""
add(
    "missing_timesteps",
    lambda s, d: gaps.missing_timesteps(candles(s, d)),
    sql(f'select api, {PK}, ntimestamp from {_LEAD} where ntimestamp - "timestamp" <> period'),
)
add(
    "bad_timestamps",
    lambda s, d: gaps.bad_timestamps(candles(s, d), 2 * HOUR),
    sql(f'select {PK}, ntimestamp from {_LEAD} where "timestamp" <> ntimestamp - 7200'),
)
add(
    "dedupe_candles",
    lambda s, d: tidy(gaps.dedupe_candles(restated(s, d), ["close"]).select("api", *PK_COLS, *OHLCV)),
    sql(f"select api, {PK}, {OHLCV_SQL} from candles", PRICES),
)
add(
    "prev_volume",
    lambda s, d: tidy(gaps.prev_volume(candles(s, d)).select(*PK_COLS, "volume", "prev_volume")),
    sql(f"select {PK}, volume, lag(volume) over ({W}) as prev_volume from candles", "volume prev_volume"),
)
add(
    "backfill_plan",
    lambda s, d: gaps.backfill_plan(candles(s, d), 2),
    sql(
        f"""select api, {PK}, ntimestamp, cast(ceil((ntimestamp - "timestamp") / 7200) as bigint) as n_pages,
        start, least(start + 7200, ntimestamp) as "end"
        from (select *, unnest(range("timestamp", ntimestamp, 7200)) as start from {_LEAD}
              where ntimestamp - "timestamp" <> period)"""
    ),
)
_IMPUTED = "imputed as (select g.exchange, g.trading_pair, g.period, g.\"timestamp\", " + ", ".join(
    f'case when g."close" is null then m."{c}" else g."{c}" end as "{c}"' for c in OHLC
) + f""", g.volume, cast(g."close" is null as integer) as imputed
  from raw_grid g left join (select trading_pair, period, "timestamp", avg(open) as open, avg(high) as high,
    avg(low) as low, avg("close") as "close" from candles group by all) m using (trading_pair, period, "timestamp")),
full_grid as (select {PK}, """ + ", ".join(
    f'first_value("{c}" ignore nulls) over ({W} rows between current row and unbounded following) as "{c}"'
    for c in OHLC
) + f", last_value(volume ignore nulls) over ({W}) as volume, imputed from imputed)"
add(
    "impute_candles",
    lambda s, d: tidy(gaps.impute_candles(candles(s, d))),
    sql("select * from full_grid", PRICES, ctes=_IMPUTED),
)


def _holes(s, d):
    """The grid where prices of gaps are unknown."""
    g = grid(s, d)
    return g.select(*PK_COLS, F.when(F.col("nan_ohlcv") == 0, F.col("close")).alias("close"))


def _filled(s, d):
    f = gaps.fill_forward(_holes(s, d).withColumn("forward", F.col("close")), ["forward"])
    return gaps.fill_backward(f.withColumn("backward", F.col("close")), ["backward"])


add(
    "fill_directional",
    lambda s, d: tidy(_filled(s, d)),
    sql(
        f"""select {PK}, "close", last_value("close" ignore nulls) over ({W}) as forward,
        first_value("close" ignore nulls) over ({W} rows between current row and unbounded following) as backward
        from raw_grid""",
        "close forward backward",
    ),
)

# --- arbitrage -------------------------------------------------------------------------------

add(
    "arb_window_length",
    lambda s, d: runs(s, d).select(*PAIR, "timestamp", "arbitrage_opportunity", "window_length"),
    sql(f"select {PAIR_PK}, arbitrage_opportunity, window_length from runs"),
)
add(
    "arb_target",
    lambda s, d: targets(s, d).select(
        *PAIR, "timestamp", "arbitrage_opportunity_shift", "window_length_shift", "target"
    ),
    sql(f"select {PAIR_PK}, arbitrage_opportunity_shift, window_length_shift, target from targets"),
)
_SHIFTED = ["close_exchange_1_shift", "close_exchange_2_shift", "pct_profit"]
add(
    "arb_profit",
    lambda s, d: tidy(
        arbitrage.with_profit(targets(s, d), 6 * HOUR, HOUR).select(*PAIR, "timestamp", *_SHIFTED)
    ),
    sql(f"select {PAIR_PK}, {', '.join(_SHIFTED)} from profits", " ".join(_SHIFTED)),
)

# --- differences, classes --------------------------------------------------------------------

add(
    "close_diff",
    lambda s, d: tidy(base.diffs(s, d).select(*PK_COLS, "close_diff")),
    sql(f"select {PK}, close_diff from diffs", "close_diff"),
)
add(
    "trade_target",
    lambda s, d: tidy(ordered.trade_target(candles(s, d)).select(*PK_COLS, "close_diff", "target")),
    sql(
        f"""select {PK}, close_diff, nxt > 0.007 as target
        from (select *, lead(close_diff) over ({W}) as nxt from diffs) where close_diff is not null and nxt is not null""",
        "close_diff",
    ),
)
add(
    "price_direction",
    lambda s, d: ordered.price_direction(candles(s, d)).select(*PK_COLS, "price_increased"),
    sql(
        f"""select {PK}, case when past > "close" then 1 when past < "close" then -1 else 0 end as price_increased
        from (select *, lag("close", 12) over ({W}) as past from candles)"""
    ),
)
_ARB = """arb as (select exchange, trading_pair, period, "timestamp", "close", volume, avg, "close" - avg as arb_diff,
  ("close" - avg) / avg as arb_signal
  from (select *, avg("close") over (partition by trading_pair, period, "timestamp") as avg from candles))"""


def _arb(s, d):
    return arb_info(candles(s, d)).select(*PK_COLS, "close", "volume", "arb_diff", "arb_signal")


add(
    "arb_signal_class",
    lambda s, d: ordered.arb_signal_class(_arb(s, d), 0.001, -0.001).select(*PK_COLS, "arb_signal_class"),
    sql(
        f"""select {PK}, case when sig > 0.001 then 1 when sig < -0.001 then -1 else 0 end as arb_signal_class
        from (select *, lag(arb_signal) over ({W}) as sig from arb)""",
        ctes=_ARB,
    ),
)
add(
    "diff_features",
    lambda s, d: tidy(ordered.diff_features(candles(s, d).select(*PK_COLS, *OHLCV), OHLCV)),
    sql(
        f"select {PK}, {OHLCV_SQL}, "
        + ", ".join(f'"{c}" - coalesce(lag("{c}") over ({W}), 0) as {c}_diff' for c in OHLCV)
        + " from candles",
        PRICES + " " + " ".join(f"{c}_diff" for c in OHLCV),
    ),
)
_MOMENT_COLUMNS = ["close", "volume", "diff", "arb_signal"]
_MOMENT_NAMES = [f"{c}_{m}" for c in _MOMENT_COLUMNS for m in ("mean", "std", "skew", "kurt")]


def _moments(s, d):
    a = ordered.shifted(_arb(s, d), {"_p": "close"}, -1)
    a = a.withColumn("diff", F.coalesce(F.col("close") - F.col("_p"), F.lit(0.0)))
    out = ordered.rolling_moments(a, _MOMENT_COLUMNS)
    # the third and fourth moments of six values agree to fewer digits between engines
    coarse = {f"{c}_{m}": F.round(f"{c}_{m}", 3) for c in _MOMENT_COLUMNS for m in ("skew", "kurt")}
    return out.withColumns(coarse).select(*PK_COLS, *_MOMENT_NAMES)


_FRAME = f"({W} rows between 5 preceding and current row)"


def _moment(c, f, name, flat):
    v = f'case when max("{c}") over {_FRAME} = min("{c}") over {_FRAME} then {flat} else {f}("{c}") over {_FRAME} end'
    return f"case when count(*) over {_FRAME} = 6 then {v} end as {c}_{name}"


_MOMENT_SQL = ", ".join(
    _moment(c, f, name, flat)
    for c in _MOMENT_COLUMNS
    for f, name, flat in (
        ("avg", "mean", f'avg("{c}") over {_FRAME}'),
        ("stddev_samp", "std", "0.0"),
        ("skewness", "skew", "0.0"),
        ("kurtosis", "kurt", "-3.0"),
    )
)
add(
    "rolling_moments",
    lambda s, d: tidy(_moments(s, d)),
    sql(
        f"select {PK}, "
        + ", ".join(
            f"round(first_value({n} ignore nulls) over ({W} rows between current row and unbounded following), "
            f"{6 if n.endswith(('mean', 'std')) else 3}) as {n}"
            for n in _MOMENT_NAMES
        )
        + f""" from (select {PK}, {_MOMENT_SQL} from
        (select *, coalesce("close" - lag("close") over ({W}), 0) as diff from arb))""",
        " ".join(_MOMENT_NAMES),
        ctes=_ARB,
    ),
)
add(
    "rolling_log_mean",
    lambda s, d: tidy(ordered.rolling_log_mean(candles(s, d), 24).select(*PK_COLS, "log_close", "log_mean")),
    sql(
        f"""select {PK}, ln("close") as log_close, case when count(*) over w = 24 then ln(avg("close") over w) end as log_mean
        from candles window w as ({W} rows between 23 preceding and current row)""",
        "log_close log_mean",
    ),
)

# --- scans -----------------------------------------------------------------------------------

_DENOISE = f"""numbered as (
  select *, row_number() over ({W}) as i, count(*) over (partition by {K}) as n,
         lead("close") over ({W}) as nx from candles),
pass1 as (
  select {K}, "timestamp", i, n, "close" as y from numbered where i = 1
  union all
  select p.exchange, p.trading_pair, p.period, b."timestamp", b.i, b.n,
         case when b.i = b.n then b."close" else (p.y + b.nx) / 2 end
  from pass1 p join numbered b on b.exchange = p.exchange and b.trading_pair = p.trading_pair and b.i = p.i + 1),
ahead1 as (select *, lead(y) over (partition by {K} order by i) as nx from pass1),
pass2 as (
  select {K}, "timestamp", i, n, y from ahead1 where i = 1
  union all
  select p.exchange, p.trading_pair, p.period, b."timestamp", b.i, b.n,
         case when b.i = b.n then b.y else (p.y + b.nx) / 2 end
  from pass2 p join ahead1 b on b.exchange = p.exchange and b.trading_pair = p.trading_pair and b.i = p.i + 1)"""
add(
    "denoise",
    # repeated halving ends exactly between two roundings; a small shift avoids that
    lambda s, d: tidy(
        ordered.denoise(candles(s, d), "close", 2).select(*PK_COLS, (F.col("denoised") + 3.3e-9).alias("denoised"))
    ),
    sql(f"select {PK}, y + 3.3e-9 as denoised from pass2", "denoised", ctes=_DENOISE),
)

# --- normalisation ---------------------------------------------------------------------------


def _rebased(s, d):
    r = ordered.rebase_to_first(candles(s, d), ["close", "volume"])
    back = ordered.rebase_inverse(F.col("close_rebased"), F.col("close_first"))
    return r.select(*PK_COLS, "close_rebased", "volume_rebased", back.alias("close_restored"))


add(
    "rebase_to_first",
    lambda s, d: tidy(_rebased(s, d)),
    sql(
        f"""select {PK}, "close" / (c0 + 1e-5) - 1 as close_rebased, volume / (v0 + 1e-5) - 1 as volume_rebased,
        "close" / (c0 + 1e-5) * c0 as close_restored
        from (select *, first_value("close") over ({W}) as c0, first_value(volume) over ({W}) as v0 from candles)""",
        "close_rebased volume_rebased close_restored",
    ),
)
_Z = ["close", "volume", "arb_diff"]


def _slog(c):
    return f'sign("{c}") * ln(abs("{c}") + 1)'


_ZSCORES = "zs as (select *, " + ", ".join(
    f"({_slog(c)} - avg({_slog(c)}) over (partition by {K})) / stddev_pop({_slog(c)}) over (partition by {K}) as {c}_z"
    for c in _Z
) + " from arb)"
add(
    "signed_log_zscore",
    lambda s, d: tidy(ordered.signed_log_zscore(_arb(s, d), _Z).select(*PK_COLS, *[f"{c}_z" for c in _Z])),
    sql(f"select {PK}, close_z, volume_z, arb_diff_z from zs", "close_z volume_z arb_diff_z", ctes=f"{_ARB}, {_ZSCORES}"),
)


def _restored(s, d):
    """Back from the z-scores: signed for the difference, plain for the price."""
    z = ordered.signed_log_zscore(_arb(s, d), _Z)
    back = lambda c, signed: ordered.denormalize(
        F.col(f"{c}_z"), F.col(f"{c}_mu"), F.col(f"{c}_sigma"), signed
    )
    return z.select(*PK_COLS, back("close", False).alias("close"), back("arb_diff", True).alias("arb_diff"))


add(
    "denormalize",
    lambda s, d: tidy(_restored(s, d), 8),
    sql(f'select {PK}, "close", arb_diff from arb', "close arb_diff", 8, ctes=_ARB),
)

# --- backtests -------------------------------------------------------------------------------

_TRADES = f"""trades as (
  select *, case when i >= 3 then binary_y_preds - before end as trade_trig,
         case when i >= 2 then binary_y_preds end as increase_count
  from (
    select *, case when lag(y_pred) over ({W}) then 1 else 0 end as binary_y_preds,
           case when lag(y_pred, 2) over ({W}) then 1 else 0 end as before, row_number() over ({W}) as i
    from predictions))"""
add(
    "trade_triggers",
    lambda s, d: backtest.trade_triggers(base.predictions(s, d)).select(
        *PK_COLS, "y_pred", "binary_y_preds", "preds_count", "increase_count", "trade_trig"
    ),
    sql(
        f"""select {PK}, y_pred, binary_y_preds, cast(sum(binary_y_preds) over ({W}) as bigint) as preds_count,
        increase_count, trade_trig from trades""",
        ctes=_TRADES,
    ),
)
add(
    "backtest_summary",
    lambda s, d: tidy(backtest.backtest_summary(base.predictions(s, d))),
    sql(
        f"""select *, gain - fees as net_profit, (gain - fees) / 10000 as pct_net_profit
        from (select {K}, sum(binary_y_preds * close_diff) as pct_gain,
              count(*) filter (where trade_trig = 1) as entries,
              sum(binary_y_preds * close_diff) * 10000 as gain,
              count(*) filter (where trade_trig = 1) * 2 * 0.35 / 100 * 10000 as fees
              from trades group by all)""",
        "pct_gain gain fees net_profit pct_net_profit",
        ctes=_TRADES,
    ),
)
_CURVE = ["profit_indicator", "profit", "fees", "net_profit", "cum_net_profit", "my_money", "buy_hold", "buy", "sell"]
_CURVE_SQL = f"""{_TRADES},
patched as (select * replace (case when i = 2 and binary_y_preds = 1 then 1 else trade_trig end as trade_trig) from trades),
sided as (select *, coalesce(last_value(case when trade_trig <> 0 then trade_trig end ignore nulls) over ({W})
                             + trade_trig, -1) as profit_indicator from patched),
priced as (select *, case when profit_indicator in (-2, -1) then 0.0 else close_diff end as profit,
                  case when profit_indicator in (-2, 2) then 0.0035 else 0.0 end as fees from sided),
curve as (
  select *, cum_net_profit * 10000 + 10000 as my_money,
         10000 * exp(sum(case when i > 1 then ln(1 + close_diff) else 0 end) over ({W})) as buy_hold
  from (select *, profit - fees as net_profit, sum(profit - fees) over ({W}) as cum_net_profit from priced))"""
add(
    "equity_curve",
    lambda s, d: tidy(backtest.equity_curve(base.predictions(s, d)).select(*PK_COLS, *_CURVE)),
    sql(
        f"""select {PK}, profit_indicator, profit, fees, net_profit, cum_net_profit, my_money, buy_hold,
        case when profit_indicator = 2 then my_money else 0.0 end as buy,
        case when profit_indicator = -2 then my_money else 0.0 end as sell from curve""",
        " ".join(_CURVE),
        ctes=_CURVE_SQL,
    ),
)
add(
    "buy_and_hold",
    lambda s, d: tidy(backtest.buy_and_hold(base.diffs(s, d)).select(*PK_COLS, "buy_hold")),
    sql(
        f"select {PK}, 10000 * exp(sum(coalesce(ln(1 + close_diff), 0)) over ({W})) as buy_hold from diffs", "buy_hold"
    ),
)

# --- supervised windows and splits -----------------------------------------------------------


def _windows(s, d):
    return ordered.supervised_windows(candles(s, d), ["close", "volume"], "close", history=12, step=3, ahead=2)


add(
    "supervised_windows",
    lambda s, d: _windows(s, d).select(
        *PK_COLS, F.array_join(F.transform(F.flatten("x"), lambda v: v.cast("decimal(20,4)").cast("string")), ",").alias("x"),
        F.array_join(F.transform("y", lambda v: v.cast("decimal(20,4)").cast("string")), ",").alias("y"),
    ),
    sql(
        f"""select {PK}, concat_ws(',', """
        + ", ".join(
            f'cast(cast(lag("{c}", {k}) over ({W}) as decimal(20,4)) as varchar)'
            for k in (12, 9, 6, 3)
            for c in ("close", "volume")
        )
        + f""") as x, concat_ws(',', cast(cast("close" as decimal(20,4)) as varchar),
            cast(cast(lead("close") over ({W}) as decimal(20,4)) as varchar)) as y
        from candles qualify lag("close", 12) over ({W}) is not null and lead("close", 2) over ({W}) is not null"""
    ),
)
_NUM = f"""num as (select *, row_number() over ({W}) - 1 as pos, count(*) over (partition by {K}) as n from candles)"""
add(
    "batch_split",
    lambda s, d: splits.batch_split(candles(s, d), 32).select(*PK_COLS, "pos", "part"),
    sql(
        f"""select {PK}, pos, case when pos < tr then 'train' else 'validation' end as part
        from (select *, cast(floor(n * 0.8) as bigint) // 32 * 32 as tr from num)
        where pos < tr + (n - tr) // 32 * 32""",
        ctes=_NUM,
    ),
)
add(
    "embargo_split",
    lambda s, d: splits.embargo_split(candles(s, d)).select(*PK_COLS, "split_ts", "part"),
    sql(
        f"""select {PK}, split_ts, case when "timestamp" < split_ts - 604800 then 'train' else 'test' end as part
        from num join (select {K}, "timestamp" as split_ts from num where pos = round_even(n * 0.7, 0)) using ({K})
        where "timestamp" < split_ts - 604800 or "timestamp" > split_ts + 604800""",
        ctes=_NUM,
    ),
)
add(
    "ordered_split",
    lambda s, d: splits.ordered_split(candles(s, d)).select(*PK_COLS, "part"),
    sql(
        f"select {PK}, case when pos < floor(n * 0.8) then 'train' else 'test' end as part from num", ctes=_NUM
    ),
)
D0, D1 = 1_705_100_000, 1_705_500_000
add(
    "date_split",
    lambda s, d: splits.date_split(candles(s, d), D0, D1).select(*PK_COLS, "part"),
    sql(
        f"""select {PK}, case when "timestamp" < {D0} then 'train' else 'test' end as part from candles
        where "timestamp" < {D0} or "timestamp" > {D1}"""
    ),
)
add(
    "ordered_slices",
    lambda s, d: splits.ordered_slices(candles(s, d)).select(*PK_COLS, "slice"),
    sql(f"select {PK}, pos // (n // 6) as slice from num where pos < n // 6 * 6", ctes=_NUM),
)
add(
    "latest_features",
    lambda s, d: tidy(ordered.latest_features(base.diffs(s, d)).select(*PK_COLS, "close", "close_diff")),
    sql(
        f"""select {PK}, "close", close_diff from diffs
        qualify row_number() over (partition by {K} order by "timestamp" desc) = 1""",
        "close close_diff",
    ),
)
add(
    "latest_k_per_series",
    lambda s, d: tidy(latest_k(candles(s, d), 100).select(*PK_COLS, *OHLCV)),
    sql(
        f"""select {PK}, {OHLCV_SQL} from candles
        qualify row_number() over (partition by {K} order by "timestamp" desc) <= 100""",
        PRICES,
    ),
)
add(
    "forecast_grid",
    lambda s, d: ordered.forecast_grid(candles(s, d), 24),
    sql(
        f"""select {K}, last_ts, cast(i as integer) as i, last_ts + period * (i + 1) as forecast_ts
        from (select {K}, max("timestamp") as last_ts from candles group by all), range(24) r(i)"""
    ),
)


def _states_of_change(s, d):
    x = base.predictions(s, d)
    return x.withColumn("state", F.when(F.col("close_diff") > 0.005, 2).when(F.col("close_diff") > -0.005, 1).otherwise(0))


add(
    "regime_transitions",
    lambda s, d: tidy(ordered.regime_transitions(_states_of_change(s, d), "state")),
    sql(
        f"""select {K}, state, next_state, n, n / sum(n) over (partition by {K}, state) as probability
        from (select {K}, state, next_state, count(*) as n
              from (select *, lead(state) over ({W}) as next_state
                    from (select *, case when close_diff > 0.005 then 2 when close_diff > -0.005 then 1 else 0 end as state
                          from predictions)) where next_state is not null group by all)""",
        "probability",
    ),
)
