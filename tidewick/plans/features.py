"""Feature pipelines composed of the operators."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.functions import indicators
from tidewick.functions.scalar import date_parts
from tidewick.operators import arbitrage, clean, ordered
from tidewick.operators.aggregate import resample
from tidewick.operators.chunks import attach, drop_halo, edge_rows, with_halo
from tidewick.operators.gaps import gap_fill, impute_candles
from tidewick.operators.joins import arb_info, cross_exchange_join
from tidewick.schema import OHLCV, PAIR, PK, SERIES
from tidewick.session import bucketed, materialise

# fixed names: features of one exchange in an arbitrage model
ARB_SERIES = [
    "close", "volume", "nan_ohlcv",
    "volume_adi", "volume_obv", "volume_cmf", "volume_fi", "volume_em", "volume_vpt", "volume_nvi",
    "volatility_atr", "volatility_bbhi", "volatility_bbli", "volatility_kchi", "volatility_kcli",
    "volatility_dchi", "volatility_dcli",
    "trend_macd_signal", "trend_macd_diff", "trend_adx", "trend_adx_pos", "trend_adx_neg",
    "trend_vortex_ind_pos", "trend_vortex_ind_neg", "trend_vortex_diff", "trend_trix", "trend_mass_index",
    "trend_cci", "trend_dpo", "trend_kst_sig", "trend_kst_diff",
    "trend_aroon_up", "trend_aroon_down", "trend_aroon_ind",
    "momentum_rsi", "momentum_mfi", "momentum_tsi", "momentum_uo", "momentum_stoch_signal", "momentum_wr",
    "momentum_ao", "others_dr",
]
ARB_SHARED = ["year", "month", "day", "higher_closing_price", "pct_higher", "arbitrage_opportunity", "window_length"]
ARB_FEATURES = [*[f"{c}_exchange_1" for c in ARB_SERIES], *[f"{c}_exchange_2" for c in ARB_SERIES], *ARB_SHARED]

# fixed names: features of a trade model (all indicators but one)
TRADE_INDICATORS = [c for c in indicators.ALL if c != "trend_adx"]
TRADE_FEATURES = [*OHLCV, "nan_ohlcv", "year", "month", "day", *TRADE_INDICATORS, "close_diff"]


def series_grid(candles: DataFrame, period: int) -> DataFrame:
    """Candles at ``period`` without gaps, gaps flagged in ``nan_ohlcv``."""
    return gap_fill(resample(candles, period))


def series_features(candles: DataFrame, period: int, families: Sequence[str] | None = None) -> DataFrame:
    """Grid plus indicators of every series; the grid is stored, as rows and running totals both start from it."""
    grid = materialise(series_grid(candles, period), "grid")
    return indicators.add_indicators(grid, families, fill=0.0) if families else indicators.add_indicators(grid, fill=0.0)


# what a feature store is bucketed by: all exchanges of a trading pair at one time lie together
SLOT = ["trading_pair", "period", "timestamp"]


def feature_store(features: DataFrame) -> DataFrame:
    """Features of single exchanges, stored so that pairing exchanges shuffles none of them (see :func:`bucketed`)."""
    return bucketed(features, SLOT, "features")


def arb_features(features: DataFrame, columns: Sequence[str] = ARB_SERIES) -> DataFrame:
    """Every pair of exchanges listing the same trading pair, with the state between them.

    ``features`` may be any table with one row per candle; a :func:`feature_store` is read without a shuffle.
    """
    return _both_sides(_pair_states(features), features, columns)


def _pair_states(features: DataFrame) -> DataFrame:
    """The state of every exchange pair and how long it has lasted, on the closes alone."""
    return arbitrage.window_length(arbitrage.with_state(cross_exchange_join(features, ["close"])))


def _both_sides(pairs: DataFrame, features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``pairs`` with the features of both exchanges, joined last so that no ordered step carries them.

    A slot's exchanges are gathered, one row each, and each pair, which comes from the same rows, picks its two: one join instead of two, and no row
    travels with one exchange's features to meet the other's.
    """
    wide = [c for c in columns if c != "close"]
    sides = features.groupBy(*SLOT).agg(F.collect_list(F.struct("exchange", *wide)).alias("_sides"))
    d = pairs.withColumns(date_parts(F.col("timestamp"))).join(sides, SLOT)
    d = d.withColumns({f"_side_{n}": F.expr(f"get(filter(_sides, x -> x.exchange = exchange_{n}), 0)") for n in (1, 2)})
    d = d.withColumns({f"{c}_exchange_{n}": F.col(f"_side_{n}.{c}") for n in (1, 2) for c in wide})
    d = d.drop("_sides", "_side_1", "_side_2")
    first = [*PAIR, "timestamp"]
    both = [f"{c}_exchange_{n}" for n in (1, 2) for c in columns]
    closes = [f"close_exchange_{n}" for n in (1, 2)]
    return d.select(*first, *both, *[c for c in d.columns if c not in (*first, *both, *closes)])


def arb_training_set(
    features: DataFrame, period: int, interval: int | None = None, columns: Sequence[str] = ARB_SERIES
) -> DataFrame:
    """Features and target of all exchange pairs in one job."""
    labelled = arbitrage.with_target(_pair_states(features), interval or 6 * period, period)
    return _both_sides(labelled, features, columns)


def fill_features(df: DataFrame, columns: Sequence[str], limit: float = 0.2) -> DataFrame:
    """Infinite values and nulls become the series' mean; a column mostly null in a series stays null.

    One aggregate per series decides both, instead of a pass that drops columns first.
    """
    d = df.withColumns({c: F.when(~clean.is_infinite(F.col(c)), F.col(c)) for c in columns})
    usable = lambda c: F.avg(F.col(c).isNull().cast("double")) < limit
    means = d.groupBy(*SERIES).agg(*[F.when(usable(c), F.avg(c)).alias(f"_m_{c}") for c in columns])
    d = attach(d, means)
    filled = {c: F.when(F.col(f"_m_{c}").isNotNull(), F.coalesce(F.col(c), F.col(f"_m_{c}"))) for c in columns}
    return d.withColumns(filled).drop(*[f"_m_{c}" for c in columns])


def _trade_frame(candles: DataFrame, period: int, families: Sequence[str] | None) -> DataFrame:
    grid = materialise(series_grid(candles, period), "grid")
    d = indicators.add_indicators(grid, families) if families is not None else indicators.add_indicators(grid)
    # several passes follow (series means, their join, the newest rows): compute the indicators once
    d = materialise(d.withColumns(date_parts(F.col("timestamp"))), "indicators")
    d = fill_features(d, [c for c in d.columns if c in TRADE_INDICATORS])
    return ordered.close_diff(d, gap_free=True)


def trade_features(candles: DataFrame, period: int, families: Sequence[str] | None = None) -> DataFrame:
    """Features and next-period target of every series."""
    d = ordered.trade_target(_trade_frame(candles, period, families), gap_free=True)
    return d.select(*PK, *[c for c in TRADE_FEATURES if c in d.columns], "target")


def trade_scoring_rows(candles: DataFrame, period: int, families: Sequence[str] | None = None) -> DataFrame:
    """The newest feature row of every series, without target."""
    d = _trade_frame(candles, period, families)
    return edge_rows(d.select(*PK, *[c for c in TRADE_FEATURES if c in d.columns]), 1).drop("rank")


# columns taken over un-normalised: percentages and classes
PLAIN = ["diff_percent", "arb_signal", "arb_signal_class", "price_increased"]


def live_features(df: DataFrame, families: Sequence[str] | None = None) -> DataFrame:
    """Gap-free candles with ``arb_signal`` -> indicators, differences, change and classes."""
    d = df.withColumns({"high_m_low": F.col("high") - F.col("low"), "close_m_open": F.col("close") - F.col("open")})
    if families is None:
        d = indicators.add_indicators(d, fill=0.0)
    elif families:
        d = indicators.add_indicators(d, families, fill=0.0)
    numeric = [c for c in clean.numeric_projection(d).columns if c != "timestamp"]
    # two indicators are themselves called <x>_diff: their namesake's difference is <x>_step
    name = {c: f"{c}_step" if f"{c}_diff" in d.columns else f"{c}_diff" for c in numeric}
    # every look back of the differences and classes in one pass
    over = f"over (partition by {', '.join(SERIES)}, _chunk order by _block, _pos)"
    d = with_halo(d, back=12).selectExpr(
        "*",
        *[f"`{c}` - coalesce(lag(`{c}`) {over}, 0) as `{name[c]}`" for c in numeric],
        f"lag(close) {over} as _before",
        f"lag(close, 12) {over} as _past",
        f"lag(arb_signal) {over} as _signal",
    )
    d = d.selectExpr(
        "*",
        "coalesce(try_divide(close - _before, _before), 0D) as diff_percent",
        "case when _past > close then 1 when _past < close then -1 else 0 end as price_increased",
        "case when _signal > 0.01 then 1 when _signal < 0.01 then -1 else 0 end as arb_signal_class",
    ).drop("_before", "_past", "_signal")
    return drop_halo(d).drop("volume_adi")


def normalised(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The model matrix: signed-log z-scores per series, 0 where undefined; PLAIN columns as they are."""
    columns = [c for c in clean.numeric_projection(df).columns if c not in (*PLAIN, "timestamp")]
    df = materialise(df, "live")
    d = ordered.signed_log_zscore(df, columns, keys)
    d = clean.zero_fill(d, [f"{c}_z" for c in columns])
    plain = [c for c in PLAIN if c in df.columns]
    return d.select(*keys, "timestamp", *[F.col(f"{c}_z").alias(c) for c in columns], *plain)


def get_data(
    candles: DataFrame,
    period: int,
    start: int,
    end: int | None = None,
    families: Sequence[str] | None = None,
) -> DataFrame:
    """Scan, impute, compare with the market and engineer features, for all series at once."""
    d = candles.where((F.col("period") == period) & (F.col("timestamp") >= start))
    if end is not None:
        d = d.where(F.col("timestamp") <= end)
    return live_features(materialise(arb_info(impute_candles(d)), "imputed"), families)


def get_latest_data(
    candles: DataFrame, period: int, now: int, n: int = 8000, families: Sequence[str] | None = None
) -> DataFrame:
    """:func:`get_data` of the last ``n`` periods before ``now``."""
    return get_data(candles, period, now - n * period, families=families)
