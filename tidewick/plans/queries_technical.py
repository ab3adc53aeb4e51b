"""Registered queries: technical indicators and feature pipelines."""


from pyspark.sql import functions as F

from tidewick.functions import indicators
from tidewick.operators.gaps import impute_candles
from tidewick.operators.joins import arb_info
from tidewick.plans import features
from tidewick.plans.base import HOUR, K, PAIR_PK, PK, PRICES, W, candles, grid, sql, tidy
from tidewick.plans.queries_series import _IMPUTED
from tidewick.schema import OHLCV, PAIR
from tidewick.schema import PK as PK_COLS
from tidewick.session import materialise

QUERIES, ORACLES = {}, {}
QUOTED_CLOSE = '"close"'


def add(key, query, oracle=None):
    QUERIES[key] = query
    if oracle is not None:
        ORACLES[key] = oracle


def fr(n: int) -> str:
    return f"({W} rows between {n - 1} preceding and current row)"


def _roc(n: int) -> str:
    return f'("close" - lag("close", {n}) over ({W})) / lag("close", {n}) over ({W}) as roc{n}'


def _ema(name: str, x: str, alpha: str) -> str:
    return f"({alpha}) * ({x}) + (1 - {alpha}) * p.{name} as {name}"


def ta_sql(w: indicators.Windows) -> str:
    """CTEs ending in ``ta``: all indicators of the rows of ``grid``, with exponential averages by recursion."""
    span, wilder = lambda n: f"2.0/{n + 1}", lambda n: f"1.0/{n}"
    l1 = {
        "ef": ('"close"', span(w.macd_fast)),
        "es": ('"close"', span(w.macd_slow)),
        "et": ('"close"', span(w.trix)),
        "atr": ("tr", wilder(w.atr)),
        "str": ("tr", wilder(w.adx)),
        "fi": ("dc * volume", span(w.force)),
        "sp": ("dmp", wilder(w.adx)),
        "sn": ("dmn", wilder(w.adx)),
        "er": ("high - low", span(w.mass_fast)),
        "sg": ("gain", wilder(w.rsi)),
        "sl": ("loss", wilder(w.rsi)),
        "m1": ("dc", span(w.tsi_slow)),
        "a1": ("abs(dc)", span(w.tsi_slow)),
    }
    l2 = {
        "sig": ("ef - es", span(w.macd_signal)),
        "eet": ("et", span(w.trix)),
        "adx": ("dx", wilder(w.adx)),
        "eer": ("er", span(w.mass_fast)),
        "m2": ("m1", span(w.tsi_fast)),
        "a2": ("a1", span(w.tsi_fast)),
    }
    dx = "coalesce(100 * abs(sp - sn) / nullif(str, 0) / nullif((sp + sn) / nullif(str, 0), 0), 0) as dx"
    u7, u14, u28 = w.ultimate
    return f"""
b0 as (
  select *, row_number() over w as i, lag("close") over w as pc, lag(high) over w as ph, lag(low) over w as pl,
         lag(volume) over w as pv from grid window w as ({W})),
b1 as (
  select *, greatest(high - low, abs(high - pc), abs(low - pc)) as tr, (high + low + "close") / 3 as tp,
         coalesce("close" - pc, 0) as dc,
         coalesce((("close" - low) - (high - "close")) / nullif(high - low, 0), 0) as clv,
         case when high - ph > pl - low and high - ph > 0 then high - ph else 0.0 end as dmp,
         case when pl - low > high - ph and pl - low > 0 then pl - low else 0.0 end as dmn,
         greatest(coalesce("close" - pc, 0), 0) as gain, greatest(-coalesce("close" - pc, 0), 0) as loss
  from b0),
e as (
  select {K}, i, {', '.join(f'{x} as {n}' for n, (x, _) in l1.items())},
         0.0::double as dx, 0.0::double as sig, "close" as eet, 0.0::double as adx, high - low as eer,
         0.0::double as m2, 0.0::double as a2, "close" as eeet
  from b1 where i = 1
  union all
  select exchange, trading_pair, period, i, {', '.join(l1)}, dx, {', '.join(l2)}, {_ema('eeet', 'eet', span(w.trix)).replace('p.eeet', 'peeet')}
  from (
    select exchange, trading_pair, period, i, {', '.join(l1)}, dx, peeet,
           {', '.join(_ema(n, x, a).replace(f'p.{n}', f'p{n}') for n, (x, a) in l2.items())}
    from (
      select *, {dx} from (
        select b.exchange, b.trading_pair, b.period, b.i, p.eeet as peeet,
               {', '.join(f'p.{n} as p{n}' for n in l2)},
               {', '.join(_ema(n, x, a) for n, (x, a) in l1.items())}
        from e p join b1 b on b.exchange = p.exchange and b.trading_pair = p.trading_pair and b.i = p.i + 1)))),
ta0 as (
  select b1.*, e.* exclude (exchange, trading_pair, period, i),
         ((high - ph) + (low - pl)) / 2 * (high - low) / nullif(volume, 0) as em,
         {', '.join(_roc(n) for n in w.rocs)},
         list(tp) over {fr(w.cci)} as tps, avg(tp) over {fr(w.cci)} as tpm,
         list("close") over {fr(w.aroon)} as cs,
         (max(high) over {fr(w.ichimoku[0])} + min(low) over {fr(w.ichimoku[0])}) / 2 as conv,
         (max(high) over {fr(w.ichimoku[1])} + min(low) over {fr(w.ichimoku[1])}) / 2 as base,
         (max(high) over {fr(w.ichimoku[2])} + min(low) over {fr(w.ichimoku[2])}) / 2 as ich_b,
         max(high) over {fr(w.stoch)} as hs, min(low) over {fr(w.stoch)} as ls,
         max(high) over {fr(w.williams)} as hw, min(low) over {fr(w.williams)} as lw,
         lag(tp) over ({W}) as ptp, "close" - least(low, pc) as bp,
         coalesce(100 * sp / nullif(str, 0), 0) as adx_pos, coalesce(100 * sn / nullif(str, 0), 0) as adx_neg
  from b1 join e using (exchange, trading_pair, period, i)),
ta1 as (
  select *, conv / 2 + base / 2 as ich_a,
         100 * ({' + '.join(f'{k} * avg(roc{n}) over {fr(m)}' for k, (n, m) in enumerate(zip(w.rocs, w.kst, strict=True), 1))}) as kst,
         100 * ("close" - ls) / nullif(hs - ls, 0) as stoch,
         list_avg(list_transform(tps, lambda x: abs(x - tpm))) as mad, lag(eeet) over ({W}) as pe,
         er / nullif(eer, 0) as mass,
         sum(case when tp > ptp then tp * volume else 0 end) over {fr(w.flow_index)} as mfp,
         sum(case when tp < ptp then tp * volume else 0 end) over {fr(w.flow_index)} as mfn,
         sum(abs(high - pl)) over {fr(w.vortex)} as vmp, sum(abs(low - ph)) over {fr(w.vortex)} as vmn, sum(tr) over {fr(w.vortex)} as trv,
         sum(tr) over {fr(u14)} as tr14, sum(tr) over {fr(u7)} as tr7, sum(tr) over {fr(u28)} as tr28,
         sum(bp) over {fr(u14)} as bp14, sum(bp) over {fr(u7)} as bp7, sum(bp) over {fr(u28)} as bp28,
         avg("close") over {fr(w.bollinger)} as c20, stddev_pop("close") over {fr(w.bollinger)} as sd20,
         avg("close") over {fr(w.dpo)} as cd,
         avg((4 * high - 2 * low + "close") / 3) over {fr(w.keltner)} as kch,
         avg((-2 * high + 4 * low + "close") / 3) over {fr(w.keltner)} as kcl,
         max("close") over {fr(w.donchian)} as dch, min("close") over {fr(w.donchian)} as dcl
  from ta0),
ta as (
  select *,
    sum(clv * volume) over ({W}) as volume_adi,
    sum(coalesce(sign("close" - pc) * volume, 0)) over ({W}) as volume_obv,
    sum(clv * volume) over {fr(w.money_flow)} / nullif(sum(volume) over {fr(w.money_flow)}, 0) as volume_cmf,
    fi as volume_fi, avg(em) over {fr(w.ease)} as volume_em,
    sum(coalesce(volume * ("close" / pc - 1), 0)) over ({W}) as volume_vpt,
    1000 * exp(sum(case when volume < pv then ln("close" / pc) else 0 end) over ({W})) as volume_nvi,
    atr as volatility_atr, c20 + 2 * sd20 as volatility_bbh, c20 - 2 * sd20 as volatility_bbl, c20 as volatility_bbm,
    case when "close" > c20 + 2 * sd20 then 1.0 else 0.0 end as volatility_bbhi,
    case when "close" < c20 - 2 * sd20 then 1.0 else 0.0 end as volatility_bbli,
    avg(tp) over {fr(w.keltner)} as volatility_kcc, kch as volatility_kch, kcl as volatility_kcl,
    case when "close" > kch then 1.0 else 0.0 end as volatility_kchi,
    case when "close" < kcl then 1.0 else 0.0 end as volatility_kcli,
    dch as volatility_dch, dcl as volatility_dcl,
    case when "close" >= dch then 1.0 else 0.0 end as volatility_dchi,
    case when "close" <= dcl then 1.0 else 0.0 end as volatility_dcli,
    ef - es as trend_macd, sig as trend_macd_signal, ef - es - sig as trend_macd_diff,
    ef as trend_ema_fast, es as trend_ema_slow, adx as trend_adx, adx_pos as trend_adx_pos, adx_neg as trend_adx_neg,
    vmp / nullif(trv, 0) as trend_vortex_ind_pos, vmn / nullif(trv, 0) as trend_vortex_ind_neg,
    (vmp - vmn) / nullif(trv, 0) as trend_vortex_diff, 100 * (eeet - pe) / pe as trend_trix,
    sum(mass) over {fr(w.mass_slow)} as trend_mass_index, (tp - tpm) / nullif(0.015 * mad, 0) as trend_cci,
    lag("close", {w.dpo // 2 + 1}) over ({W}) - cd as trend_dpo, kst as trend_kst, avg(kst) over {fr(w.kst_signal)} as trend_kst_sig,
    kst - avg(kst) over {fr(w.kst_signal)} as trend_kst_diff, ich_a as trend_ichimoku_a, ich_b as trend_ichimoku_b,
    lag(ich_a, {w.ichimoku[1]}) over ({W}) as trend_visual_ichimoku_a, lag(ich_b, {w.ichimoku[1]}) over ({W}) as trend_visual_ichimoku_b,
    100.0 * ({w.aroon} - (len(cs) - list_position(cs, list_max(cs)))) / {w.aroon} as trend_aroon_up,
    100.0 * ({w.aroon} - (len(cs) - list_position(cs, list_min(cs)))) / {w.aroon} as trend_aroon_down,
    100.0 * (list_position(cs, list_max(cs)) - list_position(cs, list_min(cs))) / {w.aroon} as trend_aroon_ind,
    coalesce(100 - 100 / (1 + sg / nullif(sl, 0)), 100) as momentum_rsi,
    coalesce(100 - 100 / (1 + mfp / nullif(mfn, 0)), 100) as momentum_mfi,
    coalesce(100 * m2 / nullif(a2, 0), 0) as momentum_tsi,
    100 * (4 * bp7 / nullif(tr7, 0) + 2 * bp14 / nullif(tr14, 0) + bp28 / nullif(tr28, 0)) / 7 as momentum_uo,
    stoch as momentum_stoch, avg(stoch) over {fr(w.stoch_signal)} as momentum_stoch_signal,
    -100 * (hw - "close") / nullif(hw - lw, 0) as momentum_wr,
    avg((high + low) / 2) over {fr(w.awesome[0])} - avg((high + low) / 2) over {fr(w.awesome[1])} as momentum_ao,
    ("close" / pc - 1) * 100 as others_dr, 100 * ln("close" / pc) as others_dlr,
    ("close" / first_value("close") over ({W}) - 1) * 100 as others_cr
  from ta1)"""


TA = ta_sql(indicators.DEFAULT)

for _family, _columns in indicators.COLUMNS.items():
    add(
        f"ta_{_family}",
        lambda s, d, f=_family, c=tuple(_columns): tidy(
            indicators.add_indicators(grid(s, d), [f]).select(*PK_COLS, *c)
        ),
        sql(f"select {PK}, {', '.join(_columns)} from ta", " ".join(_columns), ctes=TA),
    )

# every window unlike its default
OTHER_WINDOWS = indicators.Windows(
    money_flow=12, ease=9, force=21, bollinger=30, keltner=15, donchian=11, atr=21, macd_fast=8, macd_slow=34, macd_signal=6,
    adx=10, vortex=18, trix=9, mass_fast=12, mass_slow=16, cci=27, dpo=13, rocs=(5, 9, 14, 22), kst=(6, 7, 8, 12),
    kst_signal=5, ichimoku=(7, 22, 44), aroon=18, rsi=9, flow_index=17, tsi_slow=31, tsi_fast=9, ultimate=(5, 11, 23),
    stoch=10, stoch_signal=4, williams=22, awesome=(3, 29),
)
_OTHER_TA = ta_sql(OTHER_WINDOWS)
for _family, _columns in indicators.COLUMNS.items():
    if _family != "others":
        add(
            f"ta_{_family}_windows",
            lambda s, d, f=_family, c=tuple(_columns): tidy(
                indicators.add_indicators(grid(s, d), [f], windows=OTHER_WINDOWS).select(*PK_COLS, *c)
            ),
            sql(f"select {PK}, {', '.join(_columns)} from ta", " ".join(_columns), ctes=_OTHER_TA),
        )

add(
    "series_features",
    lambda s, d: tidy(features.series_features(candles(s, d), HOUR).select(*PK_COLS, *OHLCV, "nan_ohlcv", *indicators.ALL)),
    sql(
        f"select {PK}, {', '.join(f'g.{x}' for x in (*OHLCV[:3], QUOTED_CLOSE, 'volume', 'nan_ohlcv'))}, "
        + ", ".join(f"coalesce(t.{c}, 0) as {c}" for c in indicators.ALL)
        + f" from grid g join ta t using ({PK})",
        " ".join([*OHLCV, *indicators.ALL]),
        ctes=TA,
    ),
)

_PAIR_COLUMNS = features.ARB_SERIES
_BOTH = [f"{c}_exchange_{n}" for n in (1, 2) for c in _PAIR_COLUMNS]


def _pair_sql(table: str, extra: str = "") -> str:
    return (
        f"select {PAIR_PK}, "
        + ", ".join(f'{t}."{c}" as {c}_exchange_{n}' for t, n in (("a", 1), ("b", 2)) for c in _PAIR_COLUMNS)
        + f""", cast(year(t) as integer) as year, cast(month(t) as integer) as month, cast(day(t) as integer) as day,
        higher_closing_price, pct_higher, arbitrage_opportunity, window_length{extra}
        from (select *, make_timestamp("timestamp" * 1000000) as t from {table}) r
        join feats a on a.exchange = exchange_1 and a.trading_pair = r.trading_pair and a."timestamp" = r."timestamp"
        join feats b on b.exchange = exchange_2 and b.trading_pair = r.trading_pair and b."timestamp" = r."timestamp" """
    ).replace(PAIR_PK, 'exchange_1, exchange_2, r.trading_pair, r.period, r."timestamp"')


_PAIR_DOUBLES = " ".join([*[c for c in _BOTH if not c.startswith("nan_")], "pct_higher"])
# every feature of one exchange, nulls as 0
_FEATS = TA + f""",
feats as (select {PK}, g."close", g.volume, g.nan_ohlcv, {", ".join(f"coalesce(t.{c}, 0) as {c}" for c in features.ARB_SERIES[3:])}
  from grid g join ta t using ({PK}))"""


def _pair_features(s, d):
    return features.arb_features(features.feature_store(features.series_features(candles(s, d), HOUR)))


add(
    "arb_features",
    lambda s, d: tidy(_pair_features(s, d).select(*PAIR, "timestamp", *_BOTH, *features.ARB_SHARED)),
    sql(_pair_sql("runs"), _PAIR_DOUBLES, ctes=_FEATS),
)


def _training(s, d):
    table = features.feature_store(features.series_features(candles(s, d), HOUR))
    return features.arb_training_set(table, HOUR)


add(
    "arb_training_set",
    lambda s, d: tidy(_training(s, d).select(*PAIR, "timestamp", *_BOTH, *features.ARB_SHARED, "target")),
    sql(_pair_sql("targets", ", target"), _PAIR_DOUBLES, ctes=_FEATS),
)

FOUR = 4 * HOUR
_FOUR_CTES = f"""
c4 as (select exchange, trading_pair, {FOUR}::integer as period, ("timestamp" // {FOUR}) * {FOUR} as "timestamp",
  arg_min(open, "timestamp") as open, max(high) as high, min(low) as low, arg_max("close", "timestamp") as "close",
  sum(volume) as volume from candles group by all),
s4 as (select {K}, unnest(range(min("timestamp"), max("timestamp") + 1, {FOUR})) as "timestamp" from c4 group by {K}),
g4 as (select *, last_value("close" ignore nulls) over ({W}) as fc
       from (select s4.*, open, high, low, "close", volume from s4 left join c4 using ({PK}))),
t4 as (select *, lag(fc) over ({W}) as pc, lead(fc) over ({W}) as nc, make_timestamp("timestamp" * 1000000) as t from g4),
grid4 as (select {K}, "timestamp", coalesce(open, fc) as open, coalesce(high, fc) as high, coalesce(low, fc) as low, fc as "close",
          coalesce(volume, 0) as volume, cast("close" is null as integer) as nan_ohlcv from g4),
""" + TA.replace("from grid ", "from grid4 ") + f""",
filled as (select {PK}, {", ".join(f"case when avg(cast({c} is null as double)) over s < 0.2 then coalesce({c}, avg({c}) over s) end as {c}" for c in features.TRADE_INDICATORS)}
  from (select {PK}, {", ".join(f"case when isfinite({c}) then {c} end as {c}" for c in features.TRADE_INDICATORS)} from ta)
  window s as (partition by {K}))"""
_TRADE = [*features.TRADE_FEATURES, "target"]
_TRADE_SQL = f"""select {PK}, coalesce(open, fc) as open, coalesce(high, fc) as high, coalesce(low, fc) as low, fc as "close",
        coalesce(volume, 0) as volume, cast("close" is null as integer) as nan_ohlcv, cast(year(t) as integer) as year,
        cast(month(t) as integer) as month, cast(day(t) as integer) as day, {", ".join(features.TRADE_INDICATORS)},
        (fc - pc) / pc as close_diff"""
add(
    "trade_features",
    lambda s, d: tidy(features.trade_features(candles(s, d), FOUR).select(*PK_COLS, *_TRADE)),
    sql(
        f"""{_TRADE_SQL}, (nc - fc) / fc - 0.007 > 0 as target from t4 join filled using ({PK})
        where pc is not null and nc is not null""",
        " ".join([PRICES, "close_diff", *features.TRADE_INDICATORS]),
        ctes=_FOUR_CTES,
    ),
)
add(
    "trade_scoring_row",
    lambda s, d: tidy(features.trade_scoring_rows(candles(s, d), FOUR)),
    sql(
        f"{_TRADE_SQL} from t4 join filled using ({PK}) where nc is null",
        " ".join([PRICES, "close_diff", *features.TRADE_INDICATORS]),
        ctes=_FOUR_CTES,
    ),
)

_LIVE_IN = [*OHLCV, "imputed", "avg", "arb_diff", "arb_signal", "high_m_low", "close_m_open"]
_LIVE_DIFFS = [f"{c}_diff" for c in _LIVE_IN]
_LIVE = [*_LIVE_IN, *_LIVE_DIFFS, "diff_percent", "price_increased", "arb_signal_class"]


def _live(s, d):
    return features.live_features(arb_info(impute_candles(candles(s, d))))


_LIVE_SQL = (
    f"select {PK}, "
    + ", ".join(f'"{c}"' for c in _LIVE_IN)
    + ", "
    + ", ".join(f'"{c}" - coalesce(lag("{c}") over ({W}), 0) as "{c}_diff"' for c in _LIVE_IN)
    + f""", coalesce(("close" - lag("close") over ({W})) / lag("close") over ({W}), 0) as diff_percent,
    case when lag("close", 12) over ({W}) > "close" then 1 when lag("close", 12) over ({W}) < "close" then -1
         else 0 end as price_increased,
    case when lag(arb_signal) over ({W}) > 0.01 then 1 when lag(arb_signal) over ({W}) < 0.01 then -1
         else 0 end as arb_signal_class
    from (select *, "close" - avg as arb_diff, ("close" - avg) / avg as arb_signal, high - low as high_m_low,
                 "close" - open as close_m_open
          from (select *, avg("close") over (partition by trading_pair, period, "timestamp") as avg from full_grid))"""
)
add(
    "live_features",
    lambda s, d: tidy(_live(s, d).select(*PK_COLS, *_LIVE)),
    sql(
        _LIVE_SQL,
        " ".join([c for c in _LIVE_IN + _LIVE_DIFFS if not c.startswith("imputed")] + ["diff_percent"]),
        ctes=_IMPUTED,
    ),
)
# The whole frame: indicators of the imputed candles beside them, and the step of every column.  Means of means of prices with
# four digits often lie exactly between two numbers of six digits, so both engines round a hair above the value.
_HAIR = 1.7e-8
_FRAME_IN = [*_LIVE_IN, *indicators.ALL]
_FRAME_STEPS = {c: f"{c}_step" if f"{c}_diff" in indicators.ALL else f"{c}_diff" for c in _FRAME_IN}
_FRAME = [c for c in [*_FRAME_IN, *_FRAME_STEPS.values(), *_LIVE[len(_LIVE_IN) + len(_LIVE_DIFFS):]] if c != "volume_adi"]


def _frame_sql(hair: float = _HAIR) -> str:
    joined = f"""(select l.*, {", ".join(f"coalesce({c}, 0) as {c}" for c in indicators.ALL)}
      from ({_LIVE_SQL}) l join (select {PK}, {", ".join(indicators.ALL)} from ta) using ({PK}))"""
    steps = ", ".join(f'"{c}" - coalesce(lag("{c}") over ({W}), 0) as "{_FRAME_STEPS[c]}"' for c in indicators.ALL)
    columns = ", ".join(f'"{c}" + {hair} as "{c}"' if c in _FRAME_DOUBLES else f'"{c}"' for c in _FRAME)
    return f"""select {PK}, {columns} from (select *, {steps} from {joined})"""


_FRAME_DOUBLES = [c for c in _FRAME if not c.startswith(("imputed", "price_increased", "arb_signal_class"))]


def _frame(d):
    return tidy(d.select(*PK_COLS, *[(F.col(c) + _HAIR).alias(c) if c in _FRAME_DOUBLES else c for c in _FRAME]))


_FULL_TA = TA.replace("from grid ", "from full_grid ")
add(
    "live_frame",
    lambda s, d: _frame(_live(s, d)),
    sql(_frame_sql(), " ".join(_FRAME_DOUBLES), ctes=f"{_IMPUTED},{_FULL_TA}"),
)

_NOW, _NEWEST = 1_706_659_200, 480
_RECENT = f"""
recent as (select * from candles where "timestamp" >= {_NOW - _NEWEST * HOUR}),
recent_slots as (select {K}, unnest(range(min("timestamp"), max("timestamp") + 1, {HOUR})) as "timestamp" from recent group by {K}),
recent_grid as (select s.*, open, high, low, "close", volume from recent_slots s left join recent c using ({PK})),
""" + _IMPUTED.replace("raw_grid", "recent_grid").replace("from candles", "from recent")
add(
    "latest_data",
    lambda s, d: _frame(features.get_latest_data(candles(s, d), HOUR, _NOW, _NEWEST)),
    sql(_frame_sql(), " ".join(_FRAME_DOUBLES), ctes=f"{_RECENT},{_FULL_TA}"),
)
_SCALED = [*_LIVE_IN, *_LIVE_DIFFS]


def _slog(c):
    return f'sign("{c}") * ln(abs("{c}") + 1)'


def _z(c):
    one = f"partition by {K}"
    return f'coalesce(({_slog(c)} - avg({_slog(c)}) over ({one})) / nullif(stddev_pop({_slog(c)}) over ({one}), 0), 0) as "{c}"'


_NOT_SCALED = ["diff_percent", "arb_signal", "arb_signal_class", "price_increased"]
_NORMALISED = [c for c in _FRAME if c not in _NOT_SCALED]
add(
    "get_data",
    lambda s, d: tidy(features.normalised(features.get_data(candles(s, d), HOUR, 1_704_067_200)), 4),
    sql(
        f"select {PK}, {', '.join(map(_z, _NORMALISED))}, {', '.join(_NOT_SCALED)} from ({_frame_sql(0)})",
        " ".join([*_NORMALISED, "diff_percent", "arb_signal"]),
        4,
        ctes=f"{_IMPUTED},{_FULL_TA}",
    ),
)
add(
    "get_data_prices",
    lambda s, d: tidy(
        features.normalised(features.get_data(candles(s, d), HOUR, 1_704_067_200, families=[]))
        .select(*PK_COLS, *dict.fromkeys([*_SCALED, *_NOT_SCALED])),
        4,
    ),
    sql(
        f"""select {PK}, {", ".join(_z(c) for c in _SCALED if c not in _NOT_SCALED)}, {", ".join(_NOT_SCALED)}
        from ({_LIVE_SQL})""",
        " ".join([c for c in _SCALED if c not in _NOT_SCALED] + ["diff_percent", "arb_signal"]),
        4,
        ctes=_IMPUTED,
    ),
)
