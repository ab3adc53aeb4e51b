"""Indicators and trade features of a live candle stream, from a small state per series instead of its history.

The state of a series holds what the next row's 58 indicators depend on: the last candles (as many as the longest rolling
frame reaches), every exponential average, the totals of the accumulating indicators, the first close, and per
indicator the sum and count that its mean so far is made of.  It does not grow with the series, so a micro-batch costs
its own rows only, whatever came before, and Spark's state store carries it over restarts.

A micro-batch's rows of one series are one task's work, in stretches of ``STRETCH`` rows; limit the files a trigger
takes.  Frames are summed from the oldest row to the newest, as a batch window does, so flat stretches give exactly
the flags of :func:`tidewick.functions.indicators.add_indicators`.

Every row that comes in goes out once, with a ``status``:

* ``ok``: the next candle of its series; slots left out before it are filled as by ``gap_fill`` (``nan_ohlcv`` 1);
* ``late``: no newer than one that has left, or a repetition; without indicators, for batch repair;
* ``invalid``: no time, no period above zero, or a price or volume that is null or not finite; without indicators, and the state ignores it.

Of several rows with one time in one batch the first valid one by (open, high, low, close, volume) is taken.
"""

from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewick.functions import indicators
from tidewick.functions.indicators import DEFAULT, Windows
from tidewick.functions.scalar import date_parts
from tidewick.operators import scan
from tidewick.schema import OHLCV, SERIES
from tidewick.streaming.jobs import run_batches

STRETCH = 8192
# share of missing values from which an indicator is not filled with its mean
SPARSE = 0.2

_DOUBLES = T.ArrayType(T.DoubleType())
STATE = T.StructType([
    T.StructField("rows", T.LongType()),
    T.StructField("seen", T.LongType()),
    T.StructField("first_close", T.DoubleType()),
    T.StructField("totals", _DOUBLES),
    T.StructField("averages", _DOUBLES),
    T.StructField("ring", _DOUBLES),
    T.StructField("sums", _DOUBLES),
    T.StructField("counts", T.ArrayType(T.LongType())),
])
OUTPUT = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("trading_pair", T.StringType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in OHLCV],
    T.StructField("nan_ohlcv", T.IntegerType()),
    T.StructField("status", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in (*indicators.ALL, "close_diff")],
])

# what the ring keeps of a row: prices, volume, and the one rolled column that averages go into
_RING = ("high", "low", "close", "volume", "mass")
_TOTALS = ("adi", "obv", "vpt", "nvi")


@cache
def _averages(w: Windows) -> tuple[dict[str, float], ...]:
    """Smoothing factors of the exponential averages, by how many averages lie below them."""
    return (
        {
            "fi": scan.span(w.force), "atr": scan.wilder(w.atr), "fast": scan.span(w.macd_fast), "slow": scan.span(w.macd_slow),
            "trix": scan.span(w.trix), "tr": scan.wilder(w.adx), "up": scan.wilder(w.adx), "down": scan.wilder(w.adx),
            "range": scan.span(w.mass_fast), "gain": scan.wilder(w.rsi), "loss": scan.wilder(w.rsi),
            "move": scan.span(w.tsi_slow), "size": scan.span(w.tsi_slow),
        },
        {
            "signal": scan.span(w.macd_signal), "trix_2": scan.span(w.trix), "adx": scan.wilder(w.adx), "range_2": scan.span(w.mass_fast),
            "move_2": scan.span(w.tsi_fast), "size_2": scan.span(w.tsi_fast),
        },
        {"trix_3": scan.span(w.trix)},
    )


# --- columns of one series as arrays; NaN is null ---------------------------------------------


def _divide(a, b):
    return np.where(b == 0, np.nan, a / np.where(b == 0, 1.0, b))


def _ln(x):
    return np.where(x > 0, np.log(np.where(x > 0, x, 1.0)), np.nan)


def _or(x, other=0.0):
    return np.where(np.isnan(x), other, x)


def _lag(x, n=1):
    return np.concatenate([np.full(n, np.nan), x])[: len(x)]


def _frames(x, n):
    """The last ``n`` values at every row, oldest first; NaN before the start."""
    return sliding_window_view(np.concatenate([np.full(n - 1, np.nan), x]), n)


def _sum_count(frames):
    total, count = np.zeros(len(frames)), np.zeros(len(frames))
    for column in frames.T:
        known = ~np.isnan(column)
        total += np.where(known, column, 0.0)
        count += known
    return total, count


def _sum(x, n):
    total, count = _sum_count(_frames(x, n))
    return np.where(count > 0, total, np.nan)


def _mean(x, n):
    return _divide(*_sum_count(_frames(x, n)))


def _deviation(x, n):
    count, mean, squares = (np.zeros(len(x)) for _ in range(3))
    for column in _frames(x, n).T:
        known = ~np.isnan(column)
        count += known
        delta = np.where(known, column - mean, 0.0)
        step = delta / np.maximum(count, 1)
        mean += step
        squares += delta * (delta - step)
    return np.sqrt(squares / count)


def _mean_distance(x, mean, n):
    """Mean distance of the last ``n`` values from ``mean``."""
    return _divide(*_sum_count(np.abs(_frames(x, n) - mean[:, None])))


def _max(x, n):
    return np.fmax.reduce(_frames(x, n), axis=1)


def _min(x, n):
    return np.fmin.reduce(_frames(x, n), axis=1)


def _rows_since(x, n, pick):
    """Rows since the earliest extreme among the last ``n`` values."""
    return n - 1 - pick(_frames(x, n), axis=1)


def _index(up, down):
    ratio = _divide(up, down)
    return np.where(np.isnan(ratio), 100.0, 100 - 100 / (1 + ratio))


class Series:
    """One series so far; :meth:`advance` takes its next gap-free rows and gives their indicators."""

    def __init__(self, windows: Windows, state: tuple | None = None):
        self.w = windows
        self.alphas = _averages(windows)
        names = [n for level in self.alphas for n in level]
        if state is None:
            self.rows, self.seen, self.first_close = 0, None, None
            self.totals = dict.fromkeys(_TOTALS, 0.0)
            self.averages = dict.fromkeys(names)
            self.ring = {c: np.empty(0) for c in _RING}
            self.sums, self.counts = np.zeros(len(indicators.ALL)), np.zeros(len(indicators.ALL), "int64")
        else:
            self.rows, self.seen, self.first_close, totals, averages, ring, sums, counts = state
            self.totals = dict(zip(_TOTALS, totals, strict=True))
            self.averages = dict(zip(names, averages, strict=True))
            ring = np.array([np.nan if x is None else x for x in ring], "float64").reshape(len(_RING), -1)
            self.ring = dict(zip(_RING, ring, strict=True))
            self.sums, self.counts = np.array(sums, "float64"), np.array(counts, "int64")

    def state(self) -> tuple:
        ring = [None if np.isnan(x) else float(x) for c in _RING for x in self.ring[c]]
        return (
            self.rows, self.seen, self.first_close, [float(self.totals[c]) for c in _TOTALS],
            [float(x) for x in self.averages.values()], ring, self.sums.tolist(), self.counts.tolist(),
        )

    def _smooth(self, level: int, sources: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The averages of one level over the new rows; a series' first value is the seed."""
        alpha = np.array([self.alphas[level][name] for name in sources])
        x = np.column_stack(list(sources.values()))
        out = np.empty_like(x)
        y = x[0] if self.rows == 0 else np.array([self.averages[name] for name in sources])
        added = x * alpha
        for i in range(len(x)):
            if i or self.rows:
                y = y * (1.0 - alpha) + added[i]
            out[i] = y
        self.averages.update(zip(sources, y.tolist(), strict=True))
        return dict(zip(sources, out.T, strict=True))

    def _accumulate(self, name: str, steps: np.ndarray) -> np.ndarray:
        found = np.cumsum(np.concatenate([[self.totals[name]], _or(steps)]))[1:]
        self.totals[name] = found[-1]
        return found

    def advance(self, timestamp: np.ndarray, rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        w, new = self.w, slice(len(self.ring["close"]), None)
        h, l, c, v = (np.concatenate([self.ring[x], rows[x]]) for x in _RING[:4])  # noqa: E741
        pc, ph, pl, pv = (_lag(x) for x in (c, h, l, v))
        change = _or(c - pc)
        tr = np.fmax(np.fmax(h - l, np.abs(h - pc)), np.abs(l - pc))
        tp, mid = (h + l + c) / 3, (h + l) / 2
        placed = _or(_divide((c - l) - (h - c), h - l)) * v
        rise, fall = _or(h - ph, -1.0), _or(pl - l, -1.0)
        if self.first_close is None:
            self.first_close = float(c[0])

        # what accumulates and what is averaged: new rows only
        steps = {
            "adi": placed, "obv": np.sign(c - pc) * v, "vpt": v * (_divide(c, pc) - 1),
            "nvi": np.where(v < pv, _ln(_divide(c, pc)), np.nan),
        }
        totals = {name: self._accumulate(name, x[new]) for name, x in steps.items()}
        one = self._smooth(0, {
            "fi": (change * v)[new], "atr": tr[new], "fast": c[new], "slow": c[new], "trix": c[new], "tr": tr[new],
            "up": np.where((rise > fall) & (rise > 0), rise, 0.0)[new], "down": np.where((fall > rise) & (fall > 0), fall, 0.0)[new],
            "range": (h - l)[new], "gain": np.maximum(change, 0.0)[new], "loss": np.maximum(-change, 0.0)[new],
            "move": change[new], "size": np.abs(change)[new],
        })
        macd = one["fast"] - one["slow"]
        trix_before = self.averages["trix_3"]
        two = self._smooth(1, {
            "signal": macd, "trix_2": one["trix"], "range_2": one["range"], "move_2": one["move"], "size_2": one["size"],
            "adx": _or(100 * _divide(np.abs(one["up"] - one["down"]), one["up"] + one["down"])),
        })
        trix = self._smooth(2, {"trix_3": two["trix_2"]})["trix_3"]
        trix_lag = np.concatenate([[np.nan if trix_before is None else trix_before], trix[:-1]])
        mass = np.concatenate([self.ring["mass"], _divide(one["range"], two["range_2"])])

        # rolling frames: over the ring and the new rows
        bbm, sd = _mean(c, w.bollinger), _deviation(c, w.bollinger)
        kch, kcl = _mean((4 * h - 2 * l + c) / 3, w.keltner), _mean((-2 * h + 4 * l + c) / 3, w.keltner)
        dch, dcl = _max(c, w.donchian), _min(c, w.donchian)
        flag = lambda condition: condition.astype("float64")
        plus, minus = (_divide(_sum(np.abs(x), w.vortex), _sum(tr, w.vortex)) for x in (h - pl, l - ph))
        middle = lambda n: (_max(h, n) + _min(l, n)) / 2
        ich_a, ich_b = (middle(w.ichimoku[0]) + middle(w.ichimoku[1])) / 2, middle(w.ichimoku[2])
        rates = [_divide(c - _lag(c, n), _lag(c, n)) for n in w.rocs]
        kst = 100 * sum(k * _mean(r, m) for k, (r, m) in enumerate(zip(rates, w.kst, strict=True), 1))
        kst_sig, tpm = _mean(kst, w.kst_signal), _mean(tp, w.cci)
        top, low = _rows_since(c, w.aroon, np.nanargmax), _rows_since(c, w.aroon, np.nanargmin)
        hs, ls, hw, lw = _max(h, w.stoch), _min(l, w.stoch), _max(h, w.williams), _min(l, w.williams)
        stoch = _divide(100 * (c - ls), hs - ls)
        buying = c - np.fmin(l, pc)
        u7, u14, u28 = (_divide(_sum(buying, n), _sum(tr, n)) for n in w.ultimate)
        inflow, outflow = (_sum(np.where(x, tp * v, 0.0), w.flow_index) for x in (tp > _lag(tp), tp < _lag(tp)))
        growth = _divide(c, pc)
        rolled = {
            "volume_cmf": _divide(_sum(placed, w.money_flow), _sum(v, w.money_flow)),
            "volume_em": _mean(_divide(((h - ph) + (l - pl)) / 2 * (h - l), v), w.ease),
            "volatility_bbh": bbm + 2 * sd, "volatility_bbl": bbm - 2 * sd, "volatility_bbm": bbm,
            "volatility_bbhi": flag(c > bbm + 2 * sd), "volatility_bbli": flag(c < bbm - 2 * sd),
            "volatility_kcc": _mean(tp, w.keltner), "volatility_kch": kch, "volatility_kcl": kcl,
            "volatility_kchi": flag(c > kch), "volatility_kcli": flag(c < kcl),
            "volatility_dch": dch, "volatility_dcl": dcl, "volatility_dchi": flag(c >= dch), "volatility_dcli": flag(c <= dcl),
            "trend_vortex_ind_pos": plus, "trend_vortex_ind_neg": minus, "trend_vortex_diff": plus - minus,
            "trend_mass_index": _sum(mass, w.mass_slow),
            "trend_cci": _divide(tp - tpm, 0.015 * _mean_distance(tp, tpm, w.cci)),
            "trend_dpo": _lag(c, w.dpo // 2 + 1) - _mean(c, w.dpo),
            "trend_kst": kst, "trend_kst_sig": kst_sig, "trend_kst_diff": kst - kst_sig,
            "trend_ichimoku_a": ich_a, "trend_ichimoku_b": ich_b,
            "trend_visual_ichimoku_a": _lag(ich_a, w.ichimoku[1]), "trend_visual_ichimoku_b": _lag(ich_b, w.ichimoku[1]),
            "trend_aroon_up": 100 * (w.aroon - top) / w.aroon, "trend_aroon_down": 100 * (w.aroon - low) / w.aroon,
            "trend_aroon_ind": 100 * (low - top) / w.aroon,
            "momentum_mfi": _index(inflow, outflow), "momentum_uo": 100 * (4 * u7 + 2 * u14 + u28) / 7,
            "momentum_stoch": stoch, "momentum_stoch_signal": _mean(stoch, w.stoch_signal),
            "momentum_wr": _divide(-100 * (hw - c), hw - lw), "momentum_ao": _mean(mid, w.awesome[0]) - _mean(mid, w.awesome[1]),
            "others_dr": (growth - 1) * 100, "others_dlr": 100 * _ln(growth),
            "others_cr": (_divide(c, np.full(len(c), self.first_close)) - 1) * 100,
            "close_diff": _divide(c - pc, pc),
        }
        out = {
            **{name: x[new] for name, x in rolled.items()},
            **{f"volume_{name}": x for name, x in totals.items()},
            "volume_nvi": np.exp(totals["nvi"]) * 1000, "volume_fi": one["fi"], "volatility_atr": one["atr"],
            "trend_macd": macd, "trend_macd_signal": two["signal"], "trend_macd_diff": macd - two["signal"],
            "trend_ema_fast": one["fast"], "trend_ema_slow": one["slow"], "trend_adx": two["adx"],
            "trend_adx_pos": _or(100 * _divide(one["up"], one["tr"])), "trend_adx_neg": _or(100 * _divide(one["down"], one["tr"])),
            "trend_trix": 100 * _divide(trix - trix_lag, trix_lag),
            "momentum_rsi": _index(one["gain"], one["loss"]), "momentum_tsi": _or(100 * _divide(two["move_2"], two["size_2"])),
        }
        keep = indicators.rolling_rows(w)
        self.ring = {name: x[-keep:] for name, x in zip(_RING, (h, l, c, v, mass), strict=True)}
        self.rows += len(timestamp)
        self.seen = int(timestamp[-1])
        return out

    def fill(self, columns: dict[str, np.ndarray], before: int) -> None:
        """Replace missing and infinite values by the mean of the rows so far, where few enough are missing.

        ``before`` is the number of rows before these.  A row's values depend on no later row.
        """
        at = before + 1 + np.arange(len(columns["close_diff"]))
        for i, name in enumerate(indicators.ALL):
            x = np.where(np.isinf(columns[name]), np.nan, columns[name])
            known = ~np.isnan(x)
            total = np.cumsum(np.concatenate([self.sums[i : i + 1], np.where(known, x, 0.0)]))[1:]
            count = self.counts[i] + np.cumsum(known)
            usable = (at - count) / at < SPARSE
            columns[name] = np.where(usable, np.where(known, x, _divide(total, count)), np.nan)
            self.sums[i], self.counts[i] = total[-1], count[-1]


def _stretches(series: Series, period: int, rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]]:
    """Rows in order with the slots left out before them, at most ``STRETCH`` at a time: times, candles, gap marks."""
    at = rows["timestamp"].to_numpy("int64")
    values = {x: rows[x].to_numpy("float64") for x in OHLCV}
    before = np.concatenate([[at[0] - period if series.seen is None else series.seen], at[:-1]])
    last = np.concatenate([[np.nan if series.seen is None else series.ring["close"][-1]], values["close"][:-1]])
    gaps = np.maximum((at - before) // period - 1, 0)
    ends = np.cumsum(gaps + 1)
    for start in range(0, int(ends[-1]), STRETCH):
        place = np.arange(start, min(start + STRETCH, int(ends[-1])))
        row = np.searchsorted(ends, place, "right")
        gap = place < ends[row] - 1
        slot = before[row] + (place - (ends[row] - gaps[row] - 1) + 1) * period
        candles = {x: np.where(gap, 0.0 if x == "volume" else last[row], values[x][row]) for x in OHLCV}
        yield np.where(gap, slot, at[row]), candles, gap


def _frame(key: tuple, timestamp, candles: dict, gap, status: str, found: dict | None = None) -> pd.DataFrame:
    n = len(timestamp)
    empty = np.full(n, np.nan)
    data = {**dict(zip(SERIES, key, strict=True)), "timestamp": timestamp, **candles, "nan_ohlcv": np.asarray(gap).astype("int32"), "status": status}
    return pd.DataFrame({**data, **{c: empty if found is None else found[c] for c in (*indicators.ALL, "close_diff")}}, index=range(n))[OUTPUT.fieldNames()]


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, windows: Windows, filled: bool) -> Iterator[pd.DataFrame]:
    series = Series(windows, state.get if state.exists else None)
    rows = pd.concat(list(batches))
    aside = lambda d, status: _frame(
        key, d["timestamp"].astype("Int64").array, {x: d[x].array for x in OHLCV}, np.zeros(len(d)), status)
    dated = rows["timestamp"].notna() & bool(pd.notna(key[2]) and key[2] > 0)
    valid = dated & np.isfinite(rows[OHLCV].astype("float64")).all(axis=1)
    if not valid.all():
        yield aside(rows[~valid], "invalid")
    rows = rows[valid].sort_values(["timestamp", *OHLCV], kind="stable")
    late = rows["timestamp"].duplicated()
    if series.seen is not None:
        late |= rows["timestamp"] <= series.seen
    if late.any():
        yield aside(rows[late], "late")
    rows = rows[~late]
    if rows.empty:
        return
    for timestamp, candles, gap in _stretches(series, key[2], rows):
        before = series.rows
        found = series.advance(timestamp, candles)
        if filled:
            series.fill(found, before)
        yield _frame(key, timestamp, candles, gap, "ok", found)
    state.update(series.state())


def live_indicators(candles: DataFrame, windows: Windows = DEFAULT, filled: bool = False) -> DataFrame:
    """All indicators and ``close_diff`` of every new candle of a stream, and of the slots left out before it.

    With ``filled`` missing and infinite indicators take their mean over the series so far, as trade models expect; an
    indicator that a fifth of the rows so far lack stays null.
    """
    d = candles.select(*SERIES, "timestamp", *OHLCV)
    return d.groupBy(*SERIES).applyInPandasWithState(
        partial(_advance, windows=windows, filled=filled), OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout
    )


def newest_rows(features: DataFrame) -> DataFrame:
    """The newest row of each series among one micro-batch's, with the parts of its date."""
    names = [c for c in features.columns if c not in SERIES]
    best = F.max_by(F.struct(*names), "timestamp").alias("_row")
    found = features.where(F.col("status") == "ok").groupBy(*SERIES).agg(best).select(*SERIES, "_row.*")
    return found.drop("status").withColumns(date_parts(F.col("timestamp")))


def score_stream(features: DataFrame, score: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand the newest feature row of every series that a micro-batch touches to ``score``.

    ``features`` are :func:`live_indicators`; a batch that is run again after a failure has the same rows and number.
    """
    run_batches(features, lambda batch, number: score(newest_rows(batch), number), checkpoint)
