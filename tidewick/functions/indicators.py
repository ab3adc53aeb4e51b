"""Technical-analysis columns, computed for all series in one shuffle.

:func:`indicator_frame` brings each chunk's rows together with the rows before that any window reaches
(:func:`halo_rows`, 1024 with the default :class:`Windows`); every rolling frame, lag and exponential average below then runs over that one partitioning and
sort.  Rolling frames shorter than their window at the start of a series use the rows there
are.  A lag before the start is null.  Input: gap-free candles.
"""

import math
from collections.abc import Sequence
from dataclasses import astuple, dataclass
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.operators import chunks as spans
from tidewick.operators import scan
from tidewick.operators.chunks import BLOCK_ROWS, drop_halo, with_halo
from tidewick.schema import PK, SERIES


@dataclass(frozen=True)
class Windows:
    """Rows that each indicator looks back; the defaults are the usual ones."""

    money_flow: int = 20
    ease: int = 20
    force: int = 13
    bollinger: int = 20
    keltner: int = 10
    donchian: int = 20
    atr: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    adx: int = 14
    vortex: int = 14
    trix: int = 15
    mass_fast: int = 9
    mass_slow: int = 25
    cci: int = 20
    dpo: int = 20
    rocs: tuple[int, int, int, int] = (10, 15, 20, 30)
    kst: tuple[int, int, int, int] = (10, 10, 10, 15)
    kst_signal: int = 9
    ichimoku: tuple[int, int, int] = (9, 26, 52)
    aroon: int = 25
    rsi: int = 14
    flow_index: int = 14
    tsi_slow: int = 25
    tsi_fast: int = 13
    ultimate: tuple[int, int, int] = (7, 14, 28)
    stoch: int = 14
    stoch_signal: int = 3
    williams: int = 14
    awesome: tuple[int, int] = (5, 34)


DEFAULT = Windows()
# what is left of a seed this small is lost beside the values it is added to
_LOST = 1e-14


def rolling_rows(w: Windows) -> int:
    """Rows that rolling frames reach back, one frame upon another."""
    flat = [x for v in astuple(w) for x in (v if isinstance(v, (list, tuple)) else [v])]
    return max(max(flat) * 2, max(w.rocs) + max(w.kst) + w.kst_signal) + 1


def halo_rows(w: Windows) -> int:
    """Rows before a chunk that any of its values depends on, in whole blocks.

    A rolling frame needs its own length, an exponential average as many rows as its seed takes to fade; stages that
    build on each other add up.
    """

    def fade(alpha: float) -> float:
        return math.log(_LOST) / math.log(1 - alpha)

    chains = [
        fade(scan.wilder(w.atr)), 2 * fade(scan.wilder(w.adx)), fade(scan.wilder(w.rsi)), fade(scan.span(w.force)),
        fade(scan.span(max(w.macd_fast, w.macd_slow))) + fade(scan.span(w.macd_signal)), 3 * fade(scan.span(w.trix)) + 1,
        2 * fade(scan.span(w.mass_fast)) + w.mass_slow, fade(scan.span(w.tsi_slow)) + fade(scan.span(w.tsi_fast)),
    ]
    return BLOCK_ROWS * math.ceil(max(rolling_rows(w), *chains) / BLOCK_ROWS)


# fixed names
VOLUME = ["volume_adi", "volume_obv", "volume_cmf", "volume_fi", "volume_em", "volume_vpt", "volume_nvi"]
VOLATILITY = [
    "volatility_atr", "volatility_bbh", "volatility_bbl", "volatility_bbm", "volatility_bbhi", "volatility_bbli",
    "volatility_kcc", "volatility_kch", "volatility_kcl", "volatility_kchi", "volatility_kcli",
    "volatility_dch", "volatility_dcl", "volatility_dchi", "volatility_dcli",
]
TREND = [
    "trend_macd", "trend_macd_signal", "trend_macd_diff", "trend_ema_fast", "trend_ema_slow",
    "trend_adx", "trend_adx_pos", "trend_adx_neg",
    "trend_vortex_ind_pos", "trend_vortex_ind_neg", "trend_vortex_diff", "trend_trix", "trend_mass_index",
    "trend_cci", "trend_dpo", "trend_kst", "trend_kst_sig", "trend_kst_diff",
    "trend_ichimoku_a", "trend_ichimoku_b", "trend_visual_ichimoku_a", "trend_visual_ichimoku_b",
    "trend_aroon_up", "trend_aroon_down", "trend_aroon_ind",
]
MOMENTUM = [
    "momentum_rsi", "momentum_mfi", "momentum_tsi", "momentum_uo", "momentum_stoch", "momentum_stoch_signal",
    "momentum_wr", "momentum_ao",
]
OTHERS = ["others_dr", "others_dlr", "others_cr"]
ALL = [*VOLUME, *VOLATILITY, *TREND, *MOMENTUM, *OTHERS]

_OVER = "over (partition by exchange, trading_pair, period, _chunk order by _block, _pos"


def _last(call: str, n: int) -> str:
    """An aggregate over the last ``n`` rows of the series."""
    return f"{call} {_OVER} rows between {n - 1} preceding and current row)"


def _lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) {_OVER})"


def _sma(x: str, n: int) -> str:
    return _last(f"avg({x})", n)


def _sum(x: str, n: int) -> str:
    return _last(f"sum({x})", n)


def _mid(n: int) -> str:
    return f"({_last('max(high)', n)} + {_last('min(low)', n)}) / 2"


def _flag(condition: str) -> str:
    return f"case when {condition} then 1D else 0D end"


def _ratio(a: str, b: str) -> str:
    return f"try_divide({a}, {b})"


def _index(up: str, down: str) -> str:
    """100 - 100 / (1 + up/down); without any ``down`` the index is 100."""
    return f"coalesce(100 - try_divide(100D, 1 + try_divide({up}, {down})), 100D)"


# where the close lies within the range: -1 at the low, 1 at the high, 0 on a flat candle
_CLV = "coalesce(try_divide((close - low) - (high - close), high - low), 0D)"

# what each candle adds to the indicators that accumulate from the start of the series
_STEPS = {
    "_adi": f"{_CLV} * volume",
    "_obv": "coalesce(signum(close - _pc) * volume, 0D)",
    "_vpt": "coalesce(volume * (try_divide(close, _pc) - 1), 0D)",
    "_nvi": "coalesce(case when volume < _pv then ln(try_divide(close, _pc)) end, 0D)",
}


def _total(step: str) -> str:
    """The total before the chunk plus the chunk's own steps so far."""
    return f"_before{step} + sum(case when _core then {step} end) {_OVER} rows between unbounded preceding and current row)"


# Each family lists its columns by stage; the stages of all requested families run together, so that
# one window serves them all.  Stages named ema hold (source, smoothing factor).
STAGES = ["scalar_0", "rolling_1", "ema_1", "scalar_1", "rolling_2", "ema_2", "scalar_2", "rolling_3", "ema_3", "rolling_4", "scalar_4"]

@cache
def _families(w: Windows) -> dict[str, dict[str, dict]]:
    return {
        "volume": {
            "scalar_0": {
                **_STEPS,
                "_clvv": f"{_CLV} * volume",
                "_fi": "_dc * volume",
                "_em": _ratio("((high - _ph) + (low - _pl)) / 2 * (high - low)", "volume"),
            },
            "rolling_1": {
                "volume_cmf": _ratio(_sum("_clvv", w.money_flow), _sum("volume", w.money_flow)),
                "volume_em": _sma("_em", w.ease),
                "volume_adi": _total("_adi"),
                "volume_obv": _total("_obv"),
                "volume_vpt": _total("_vpt"),
                "volume_nvi": f"exp({_total('_nvi')}) * 1000",
            },
            "ema_1": {"volume_fi": ("_fi", scan.span(w.force))},
        },
        "volatility": {
            "rolling_1": {
                "volatility_bbm": _sma("close", w.bollinger),
                "_sd": _last("stddev_pop(close)", w.bollinger),
                "volatility_kcc": _sma("_tp", w.keltner),
                "volatility_kch": _sma("(4 * high - 2 * low + close) / 3", w.keltner),
                "volatility_kcl": _sma("(-2 * high + 4 * low + close) / 3", w.keltner),
                "volatility_dch": _last("max(close)", w.donchian),
                "volatility_dcl": _last("min(close)", w.donchian),
            },
            "ema_1": {"_atr": ("_tr", scan.wilder(w.atr))},
            "scalar_1": {
                "volatility_atr": "_atr",
                "volatility_bbh": "volatility_bbm + 2 * _sd",
                "volatility_bbl": "volatility_bbm - 2 * _sd",
                "volatility_bbhi": _flag("close > volatility_bbm + 2 * _sd"),
                "volatility_bbli": _flag("close < volatility_bbm - 2 * _sd"),
                "volatility_kchi": _flag("close > volatility_kch"),
                "volatility_kcli": _flag("close < volatility_kcl"),
                "volatility_dchi": _flag("close >= volatility_dch"),
                "volatility_dcli": _flag("close <= volatility_dcl"),
            },
        },
        "trend": {
            "scalar_0": {
                "_dmp": "case when high - _ph > _pl - low and high - _ph > 0 then high - _ph else 0D end",
                "_dmn": "case when _pl - low > high - _ph and _pl - low > 0 then _pl - low else 0D end",
                "_range": "high - low",
            },
            "rolling_1": {
                **{f"_p{n}": _lag("close", n) for n in sorted({*w.rocs, w.dpo // 2 + 1})},
                # an array of the window: as fast as a sum over lags when measured, and a smaller plan
                "_tps": _last("collect_list(_tp)", w.cci),
                "_tpm": _sma("_tp", w.cci),
                "_dpo": _sma("close", w.dpo),
                "_conv": _mid(w.ichimoku[0]),
                "_base": _mid(w.ichimoku[1]),
                "trend_ichimoku_b": _mid(w.ichimoku[2]),
                # the earliest row holding the extreme
                "_top": f"-{_last('max(struct(close, -_pos as at))', w.aroon)}.at",
                "_low": f"{_last('min(struct(close, _pos as at))', w.aroon)}.at",
                "trend_vortex_ind_pos": _ratio(_sum("abs(high - _pl)", w.vortex), _sum("_tr", w.vortex)),
                "trend_vortex_ind_neg": _ratio(_sum("abs(low - _ph)", w.vortex), _sum("_tr", w.vortex)),
            },
            "ema_1": {
                "trend_ema_fast": ("close", scan.span(w.macd_fast)),
                "trend_ema_slow": ("close", scan.span(w.macd_slow)),
                "_e15": ("close", scan.span(w.trix)),
                "_str": ("_tr", scan.wilder(w.adx)),
                "_sdmp": ("_dmp", scan.wilder(w.adx)),
                "_sdmn": ("_dmn", scan.wilder(w.adx)),
                "_er": ("_range", scan.span(w.mass_fast)),
            },
            "scalar_1": {
                "trend_macd": "trend_ema_fast - trend_ema_slow",
                "trend_adx_pos": f"coalesce(100 * {_ratio('_sdmp', '_str')}, 0D)",
                "trend_adx_neg": f"coalesce(100 * {_ratio('_sdmn', '_str')}, 0D)",
                "_dx": f"coalesce(100 * {_ratio('abs(_sdmp - _sdmn)', '_sdmp + _sdmn')}, 0D)",
                "trend_vortex_diff": "trend_vortex_ind_pos - trend_vortex_ind_neg",
                "trend_cci": _ratio(
                    "_tp - _tpm", "0.015D * (aggregate(_tps, 0D, (a, x) -> a + abs(x - _tpm)) / size(_tps))"
                ),
                "trend_dpo": f"_p{w.dpo // 2 + 1} - _dpo",
                **{f"_roc{n}": _ratio(f"close - _p{n}", f"_p{n}") for n in w.rocs},
                "trend_ichimoku_a": "(_conv + _base) / 2",
                "trend_aroon_up": f"100 * ({w.aroon} - (_pos - _top)) / {w.aroon}",
                "trend_aroon_down": f"100 * ({w.aroon} - (_pos - _low)) / {w.aroon}",
                "trend_aroon_ind": f"100 * (_top - _low) / {w.aroon}",
            },
            "rolling_2": {
                "trend_kst": "100 * ("
                + " + ".join(f"{k} * {_sma(f'_roc{n}', m)}" for k, (n, m) in enumerate(zip(w.rocs, w.kst, strict=True), 1))
                + ")",
                "trend_visual_ichimoku_a": _lag("trend_ichimoku_a", w.ichimoku[1]),
                "trend_visual_ichimoku_b": _lag("trend_ichimoku_b", w.ichimoku[1]),
            },
            "ema_2": {
                "trend_macd_signal": ("trend_macd", scan.span(w.macd_signal)),
                "_ee15": ("_e15", scan.span(w.trix)),
                "trend_adx": ("_dx", scan.wilder(w.adx)),
                "_eer": ("_er", scan.span(w.mass_fast)),
            },
            "scalar_2": {
                "trend_macd_diff": "trend_macd - trend_macd_signal",
                "_mass": _ratio("_er", "_eer"),
            },
            "rolling_3": {"trend_kst_sig": _sma("trend_kst", w.kst_signal), "trend_mass_index": _sum("_mass", w.mass_slow)},
            "ema_3": {"_eee15": ("_ee15", scan.span(w.trix))},
            "rolling_4": {"_pe": _lag("_eee15")},
            "scalar_4": {
                "trend_trix": f"100 * {_ratio('_eee15 - _pe', '_pe')}",
                "trend_kst_diff": "trend_kst - trend_kst_sig",
            },
        },
        "momentum": {
            "scalar_0": {
                "_gain": "greatest(_dc, 0D)",
                "_loss": "greatest(-_dc, 0D)",
                "_adc": "abs(_dc)",
                "_bp": "close - least(low, _pc)",
            },
            "rolling_1": {
                "_ptp": _lag("_tp"),
                "_hs": _last("max(high)", w.stoch),
                "_ls": _last("min(low)", w.stoch),
                "_hw": _last("max(high)", w.williams),
                "_lw": _last("min(low)", w.williams),
                "momentum_ao": f"{_sma('(high + low) / 2', w.awesome[0])} - {_sma('(high + low) / 2', w.awesome[1])}",
                **{f"_avg{n}": _ratio(_sum("_bp", n), _sum("_tr", n)) for n in w.ultimate},
            },
            "ema_1": {
                "_sgain": ("_gain", scan.wilder(w.rsi)),
                "_sloss": ("_loss", scan.wilder(w.rsi)),
                "_m1": ("_dc", scan.span(w.tsi_slow)),
                "_a1": ("_adc", scan.span(w.tsi_slow)),
            },
            "scalar_1": {
                "_mfp": "case when _tp > _ptp then _tp * volume else 0D end",
                "_mfn": "case when _tp < _ptp then _tp * volume else 0D end",
                "momentum_stoch": _ratio("100 * (close - _ls)", "_hs - _ls"),
                "momentum_wr": _ratio("-100 * (_hw - close)", "_hw - _lw"),
                "momentum_uo": "100 * (4 * _avg{} + 2 * _avg{} + _avg{}) / 7".format(*w.ultimate),
                "momentum_rsi": _index("_sgain", "_sloss"),
            },
            "rolling_2": {
                "momentum_mfi": _index(_sum("_mfp", w.flow_index), _sum("_mfn", w.flow_index)),
                "momentum_stoch_signal": _sma("momentum_stoch", w.stoch_signal),
            },
            "ema_2": {"_m2": ("_m1", scan.span(w.tsi_fast)), "_a2": ("_a1", scan.span(w.tsi_fast))},
            "scalar_2": {"momentum_tsi": f"coalesce(100 * {_ratio('_m2', '_a2')}, 0D)"},
        },
        "others": {
            "scalar_0": {
                "others_dr": f"({_ratio('close', '_pc')} - 1) * 100",
                "others_dlr": f"100 * ln({_ratio('close', '_pc')})",
                "others_cr": f"({_ratio('close', '_c0')} - 1) * 100",
            }
        },
    }


COLUMNS = {"volume": VOLUME, "volatility": VOLATILITY, "trend": TREND, "momentum": MOMENTUM, "others": OTHERS}
# families with indicators that accumulate from the start of the series
_RUNNING = {"volume", "others"}


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} as {name}" for name, e in columns.items()])


def indicator_frame(df: DataFrame, totals: bool, back: int) -> DataFrame:
    """Candles spread over chunks, with the previous row's values and the true range.

    With ``totals`` also what the chunk inherits; that join uses the chunks' partitioning.
    """
    d = with_halo(df, back=back)
    if totals:
        d = d.join(carried_totals(df, back), [*SERIES, "_chunk"], "left")
    d = d.withColumn("_first", scan.is_first())
    d = _with(d, {"_pc": _lag("close"), "_ph": _lag("high"), "_pl": _lag("low"), "_pv": _lag("volume")})
    return _with(
        d,
        {
            "_tr": "greatest(high - low, abs(high - _pc), abs(low - _pc))",
            "_tp": "(high + low + close) / 3",
            "_dc": "coalesce(close - _pc, 0D)",
        },
    )


def carried_totals(df: DataFrame, back: int) -> DataFrame:
    """What each chunk inherits: the totals of all steps before it and the series' first close.

    A narrow pass over prices and volume that leaves one row per chunk.
    """
    # the same chunks as the frame's, which grow with a long halo
    d = with_halo(df.select(*PK, "high", "low", "close", "volume"), back=1, rows=max(spans.CHUNK_ROWS, back))
    d = _with(_with(d, {"_pc": _lag("close"), "_pv": _lag("volume")}), _STEPS)
    own = [f"sum({name}) as {name}" for name in _STEPS]
    chunks = drop_halo(d, keep_chunk=True).groupBy(*SERIES, "_chunk")
    chunks = chunks.agg(*[F.expr(e) for e in own], F.min_by("close", "timestamp").alias("_c0"))
    upto = f"(partition by {', '.join(SERIES)} order by _chunk rows between unbounded preceding and"
    return chunks.selectExpr(
        *SERIES,
        "_chunk",
        *[f"coalesce(sum({name}) over {upto} 1 preceding), 0D) as _before{name}" for name in _STEPS],
        f"first(_c0) over {upto} current row) as _c0",
    )


def add_indicators(
    df: DataFrame, families: Sequence[str] = tuple(COLUMNS), fill: float | None = None, windows: Windows = DEFAULT
) -> DataFrame:
    """Add the indicator columns of the given families; ``fill`` replaces their nulls."""
    keep = df.columns
    names = [c for f in families for c in COLUMNS[f]]
    d = indicator_frame(df, bool(_RUNNING & set(families)), halo_rows(windows))
    stages = _families(windows)
    for stage in STAGES:
        columns = {k: v for f in families for k, v in stages[f].get(stage, {}).items()}
        if columns:
            d = scan.ema(d, columns) if stage.startswith("ema") else _with(d, columns)
    d = drop_halo(d).select(*keep, *names)
    return d.fillna(fill, names) if fill is not None else d
