"""Registered queries: aggregation, cleaning, joins between exchanges."""

from pyspark.sql import functions as F

from tidewick.functions import scalar
from tidewick.operators import aggregate, arbitrage, clean, evaluate, joins
from tidewick.operators.chunks import attach
from tidewick.operators.gaps import _fill_slots
from tidewick.plans import base
from tidewick.plans.base import K, OHLCV_SQL, PAIR_PK, PK, PRICES, W, candles, grid, sql, states, tidy
from tidewick.schema import OHLCV, SERIES
from tidewick.schema import PK as PK_COLS
from tidewick.sources.candles import chart_series, first_k
from tidewick.sources.ticks import read_candles

QUERIES, ORACLES = {}, {}


def add(key, query, oracle=None):
    QUERIES[key] = query
    if oracle is not None:
        ORACLES[key] = oracle


# --- aggregation -----------------------------------------------------------------------------

add(
    "candles_from_events",
    lambda s, d: tidy(candles(s, d).select(*PK_COLS, *OHLCV)),
    sql(f"select {PK}, {OHLCV_SQL} from candles", PRICES),
)

_DAY = f"""select exchange, trading_pair, 86400::integer as period, ("timestamp" // 86400) * 86400 as "timestamp",
  arg_min(open, "timestamp") as open, max(high) as high, min(low) as low, arg_max("close", "timestamp") as "close",
  sum(volume) as volume from candles group by all"""
add("resample_ohlcv", lambda s, d: tidy(aggregate.resample(candles(s, d), 86_400)), sql(_DAY, PRICES))


def _mixed(s, d):
    """Five-minute and hourly candles side by side, and pair p1 hourly only after a date."""
    fine = read_candles(s, d, 300)
    fine = fine.where((F.col("trading_pair") == "p0") | (F.col("timestamp") < MIXED_UNTIL))
    return fine.unionByName(candles(s, d))


MIXED_UNTIL = 1_705_276_800  # a midnight
add(
    "resample_mixed_periods",
    lambda s, d: tidy(aggregate.resample(_mixed(s, d), 86_400)),
    sql(_DAY, PRICES),
)
add(
    "resample_one_source",
    lambda s, d: tidy(aggregate.resample(_mixed(s, d), 86_400, source=300)),
    sql(
        f"select * from ({_DAY}) where trading_pair = 'p0' or \"timestamp\" < {MIXED_UNTIL}",
        PRICES,
    ),
)

add(
    "market_avg_candle",
    lambda s, d: tidy(joins.market_average(candles(s, d))),
    sql(
        'select trading_pair, period, "timestamp", avg(open) as open, avg(high) as high, avg(low) as low, '
        'avg("close") as "close" from candles group by all',
        "open high low close",
    ),
)
add(
    "series_bounds",
    lambda s, d: aggregate.series_bounds(candles(s, d)),
    sql(f'select {K}, min("timestamp") as earliest, max("timestamp") as latest from candles group by all'),
)
add(
    "coverage_check",
    lambda s, d: aggregate.coverage_check(candles(s, d), 550),
    sql(f"select {K}, count(*) as n, count(*) > 550 as covered from candles group by all"),
)
add(
    "chart_series",
    lambda s, d: tidy(chart_series(candles(s, d)).select("api", *PK_COLS, *OHLCV)),
    sql(f"select api, {PK}, {OHLCV_SQL} from candles", PRICES),
)
add(
    "first_k_per_series",
    lambda s, d: tidy(first_k(candles(s, d), 100).select("api", *PK_COLS, *OHLCV)),
    sql(
        f"""select api, {PK}, {OHLCV_SQL} from candles
        qualify row_number() over (partition by {K} order by "timestamp") <= 100""",
        PRICES,
    ),
)
add(
    "pearson_corr",
    lambda s, d: tidy(
        aggregate.pearson(states(s, d), "close_exchange_1", "close_exchange_2", arbitrage.PAIR)
    ),
    sql(
        "select exchange_1, exchange_2, trading_pair, period, corr(close_exchange_1, close_exchange_2) as r "
        "from states group by all",
        "r",
    ),
)
add(
    "label_counts",
    lambda s, d: evaluate.label_counts(base.results(s, d), ["actual", "predicted"]),
    sql(
        """select label, count(*) filter (where source = 'a') as n_actual,
        count(*) filter (where source = 'p') as n_predicted
        from (select actual as label, 'a' as source from results union all select predicted, 'p' from results)
        group by all"""
    ),
)

# --- cleaning --------------------------------------------------------------------------------

T0, T1 = 1_704_500_000, 1_706_000_000
add(
    "time_slice",
    lambda s, d: tidy(clean.time_slice(candles(s, d), T0, T1).select(*PK_COLS, *OHLCV)),
    sql(f'select {PK}, {OHLCV_SQL} from candles where "timestamp" > {T0} and "timestamp" < {T1}', PRICES),
)


def _text_candles(s, d):
    c = candles(s, d)
    return c.select(*SERIES, "timestamp", *[F.col(x).cast("string").alias(x) for x in OHLCV])


add(
    "fix_types",
    lambda s, d: tidy(clean.fix_types(_text_candles(s, d))),
    sql(
        f"""select exchange, trading_pair, cast(period as double) as period, "timestamp", {OHLCV_SQL},
        make_timestamp("timestamp" * 1000000) as datetime from candles""",
        PRICES,
    ),
)


def _raw_grid(s, d):
    """The time grid with nulls where there is no candle."""
    g = _fill_slots(candles(s, d).select(*PK_COLS, *OHLCV))
    return g.withColumns({c: F.when(~F.col("_gap"), F.col(c)) for c in OHLCV}).drop("_gap")


add(
    "rows_with_nulls",
    lambda s, d: tidy(clean.rows_with_nulls(_raw_grid(s, d))),
    sql(
        f"""select * from raw_grid where open is null or high is null or low is null or "close" is null
        or volume is null""",
        PRICES,
    ),
)
add(
    "numeric_projection",
    lambda s, d: tidy(
        clean.numeric_projection(candles(s, d).withColumn("timestamp_close", F.col("timestamp") + F.col("period")))
    ),
    sql(f'select "timestamp", {OHLCV_SQL} from candles', PRICES),
)


def _sparse(s, d):
    """The grid's gaps, prices unfilled, with the filled close beside them."""
    g = grid(s, d)
    return g.withColumns({c: F.when(F.col("nan_ohlcv") == 0, F.col(c)) for c in ("open", "high", "low")})


_SPARSE = """sparse as (select exchange, trading_pair, period, "timestamp", case when nan_ohlcv = 0 then open end as open,
 case when nan_ohlcv = 0 then high end as high, case when nan_ohlcv = 0 then low end as low, "close", volume, nan_ohlcv
 from grid)"""
add(
    "drop_sparse_columns",
    lambda s, d: tidy(clean.drop_sparse_columns(_sparse(s, d))),
    sql(f'select {PK}, "close", volume, nan_ohlcv from sparse', "close volume", ctes=_SPARSE),
)
add(
    "drop_null_columns",
    lambda s, d: tidy(clean.drop_null_columns(base.diffs(s, d).select(*PK_COLS, "close", "volume", "close_diff"))),
    sql(f'select {PK}, "close", volume from diffs', "close volume"),
)


def _infinite(s, d):
    ratio = F.when(F.col("volume") == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.col("close"), F.col("volume")))
    return candles(s, d).select(*PK_COLS, "close", ratio.alias("ratio"))


add(
    "clean_infinite",
    lambda s, d: clean.clean_infinite(_infinite(s, d)),
    sql(f'select {PK}, "close", "close" / nullif(volume, 0) as ratio from candles'),
)


def _holes(s, d):
    nan = F.when(F.col("volume") == 0, F.lit(float("nan"))).when(F.col("close_diff").isNull(), F.lit(float("-inf")))
    return base.diffs(s, d).select(*PK_COLS, "close_diff", nan.otherwise(F.col("volume")).alias("volume"))


add(
    "zero_fill",
    lambda s, d: tidy(clean.zero_fill(_holes(s, d))),
    sql(
        f"""select {PK}, coalesce(close_diff, 0) as close_diff,
        case when close_diff is null then 0 else volume end as volume from diffs""",
        "close_diff volume",
    ),
)
add(
    "mean_impute",
    lambda s, d: tidy(clean.mean_impute(_raw_grid(s, d), OHLCV)),
    sql(
        f"select {PK}, "
        + ", ".join(f'coalesce("{c}", avg("{c}") over (partition by {K})) as "{c}"' for c in OHLCV)
        + " from raw_grid",
        PRICES,
    ),
)


def _landed(s, d):
    """Candles of the grid (some without prices), and each candle again stamped in milliseconds."""
    g = _raw_grid(s, d)
    return g.unionByName(g.where(F.col("close").isNotNull()).withColumn("timestamp", F.col("timestamp") * 1000))


def _validated(s, d):
    ok, rejected = clean.validate_candles(_landed(s, d))
    return ok.withColumn("valid", F.lit(True)).unionByName(rejected.withColumn("valid", F.lit(False)))


add(
    "validate_candles",
    lambda s, d: tidy(_validated(s, d)),
    sql(
        f"""select *, "close" is not null and "timestamp" > 947362914 and "timestamp" < 1894131876 as valid
        from (select * from raw_grid union all
              select * replace ("timestamp" * 1000 as "timestamp") from raw_grid where "close" is not null)""",
        PRICES,
    ),
)
NOW = 1_706_227_200 + 1_800
add(
    "closed_candles",
    lambda s, d: tidy(clean.closed_candles(candles(s, d), NOW).select(*PK_COLS, *OHLCV)),
    sql(f'select {PK}, {OHLCV_SQL} from candles where "timestamp" + period <= {NOW}', PRICES),
)
SPLIT = 1_705_968_000


def _eligible(s, d):
    ts = F.col("timestamp")
    return clean.eligible_series(candles(s, d), {"train": (ts < SPLIT, 400), "test": (ts >= SPLIT, 136)})


add(
    "eligible_series",
    _eligible,
    sql(
        f"""select * from (select {K}, count(*) filter (where "timestamp" < {SPLIT}) as train,
        count(*) filter (where "timestamp" >= {SPLIT}) as test from candles group by all)
        where train > 400 and test > 136"""
    ),
)

# --- joins -----------------------------------------------------------------------------------

add(
    "cross_exchange_join",
    lambda s, d: tidy(joins.cross_exchange_join(candles(s, d), OHLCV)),
    sql(
        'select a.exchange as exchange_1, b.exchange as exchange_2, trading_pair, period, "timestamp", '
        + ", ".join(f'{t}."{c}" as {c}_exchange_{n}' for t, n in (("a", 1), ("b", 2)) for c in OHLCV)
        + ' from candles a join candles b using (trading_pair, period, "timestamp") where a.exchange < b.exchange',
        " ".join(f"{c}_exchange_{n}" for n in (1, 2) for c in OHLCV),
    ),
)
_ARB = """arb as (select exchange, trading_pair, period, "timestamp", avg, "close" - avg as arb_diff,
  ("close" - avg) / avg as arb_signal
  from (select *, avg("close") over (partition by trading_pair, period, "timestamp") as avg from candles))"""
add(
    "arb_info",
    lambda s, d: tidy(joins.arb_info(candles(s, d)).select(*PK_COLS, "avg", "arb_diff", "arb_signal")),
    sql("select * from arb", "avg arb_diff arb_signal", ctes=_ARB),
)


def _merged(s, d):
    c = clean.fix_types(candles(s, d).drop("api"))
    info = clean.fix_types(joins.arb_info(candles(s, d)).select(*PK_COLS, "avg", "arb_diff", "arb_signal"))
    return joins.merge_candles(c, info)


add(
    "merge_candles",
    lambda s, d: tidy(_merged(s, d)),
    sql(
        f"""select exchange, trading_pair, cast(period as double) as period, "timestamp",
        make_timestamp("timestamp" * 1000000) as datetime, {OHLCV_SQL}, avg, arb_diff, arb_signal
        from candles join arb using ({PK})""",
        PRICES + " avg arb_diff arb_signal",
        ctes=_ARB,
    ),
)


def _one(s, d, exchange):
    c = candles(s, d).where(F.col("exchange") == exchange)
    return c.select("trading_pair", "period", "timestamp", F.col("close").alias(f"close_{exchange}"))


for _how, _key in (("inner", "natural_inner_join"), ("full_outer", "natural_outer_join")):
    add(
        _key,
        lambda s, d, how=_how: tidy(joins.natural_join(_one(s, d, "click"), _one(s, d, "view"), how)),
        sql(
            f"""select trading_pair, period, "timestamp", close_click, close_view
            from (select trading_pair, period, "timestamp", "close" as close_click from candles where exchange = 'click')
            {_how.split('_')[0]} join (select trading_pair, period, "timestamp", "close" as close_view from candles
                                       where exchange = 'view') using (trading_pair, period, "timestamp")""",
            "close_click close_view",
        ),
    )
add(
    "exchange_pairs",
    lambda s, d: joins.exchange_pairs(candles(s, d)),
    sql(
        """select distinct a.exchange as exchange_1, b.exchange as exchange_2, trading_pair
        from candles a join candles b using (trading_pair) where a.exchange < b.exchange"""
    ),
)
add(
    "btc_enrich",
    lambda s, d: tidy(
        joins.quote_enrich(
            _raw_grid(s, d), F.col("trading_pair") == "p0", F.col("trading_pair") == "p1"
        )
    ),
    sql(
        f"""select {PK}, {OHLCV_SQL},
        first_value(close_btc ignore nulls) over ({W} rows between current row and unbounded following) as close_btc
        from (select a.*, b."close" as close_btc from raw_grid a join raw_grid b using (exchange, period, "timestamp")
              where a.trading_pair = 'p1' and b.trading_pair = 'p0')""",
        PRICES + " close_btc",
    ),
)


def _gap_rows(s, d):
    return grid(s, d).where(F.col("nan_ohlcv") == 1).select(*PK_COLS)


add(
    "last_volume",
    lambda s, d: tidy(joins.last_volume(_gap_rows(s, d), candles(s, d))),
    sql(
        f"""select {PK}, coalesce(last_value(volume ignore nulls) over ({W}),
          first_value(volume ignore nulls) over ({W} rows between current row and unbounded following)) as volume
        from (select g.exchange, g.trading_pair, g.period, g."timestamp", c.volume
              from grid g left join candles c on c.exchange = g.exchange and c.trading_pair = g.trading_pair
                and c.period = g.period and c."timestamp" = g."timestamp" - g.period
              where g.nan_ohlcv = 1)""",
        "volume",
    ),
)
STORED = 1_705_276_800


def _stored(s, d):
    return candles(s, d).where(F.col("timestamp") < STORED)


add(
    "new_candles_anti",
    lambda s, d: tidy(joins.new_rows(candles(s, d), _stored(s, d), PK_COLS).select(*PK_COLS, *OHLCV)),
    sql(f'select {PK}, {OHLCV_SQL} from candles where "timestamp" >= {STORED}', PRICES),
)


def _unstable(s, d):
    """Times at which some exchange had no candle."""
    return grid(s, d).where(F.col("nan_ohlcv") == 1).select("trading_pair", "period", "timestamp").distinct()


add(
    "candles_at",
    lambda s, d: tidy(
        joins.rows_at(candles(s, d), _unstable(s, d), ["trading_pair", "period", "timestamp"]).select(*PK_COLS, *OHLCV)
    ),
    sql(
        f"""select {PK}, {OHLCV_SQL} from candles where (trading_pair, period, "timestamp") in
        (select (trading_pair, period, "timestamp") from grid where nan_ohlcv = 1)""",
        PRICES,
    ),
)

# --- scalar ----------------------------------------------------------------------------------

add(
    "higher_close",
    lambda s, d: tidy(states(s, d).select(*arbitrage.PAIR, "timestamp", "higher_closing_price")),
    sql(f"select {PAIR_PK}, higher_closing_price from states"),
)
add(
    "pct_higher",
    lambda s, d: tidy(states(s, d).select(*arbitrage.PAIR, "timestamp", "pct_higher")),
    sql(f"select {PAIR_PK}, pct_higher from states", "pct_higher"),
)
add(
    "arb_opportunity",
    lambda s, d: tidy(states(s, d).select(*arbitrage.PAIR, "timestamp", "arbitrage_opportunity")),
    sql(f"select {PAIR_PK}, arbitrage_opportunity from states"),
)
add(
    "arb_markers",
    lambda s, d: tidy(
        arbitrage.markers(states(s, d), "arbitrage_opportunity").select(
            *arbitrage.PAIR, "timestamp", "pct_diff", "arb_ex1_ex2", "arb_ex2_ex1"
        )
    ),
    sql(
        f"""select {PAIR_PK}, pct_diff, case when arbitrage_opportunity = 1 then pct_diff end as arb_ex1_ex2,
        case when arbitrage_opportunity = -1 then pct_diff end as arb_ex2_ex1
        from (select *, (close_exchange_1 - close_exchange_2) / close_exchange_1 as pct_diff from states)""",
        "pct_diff arb_ex1_ex2 arb_ex2_ex1",
    ),
)


def _categories(s, d):
    x = base.predictions(s, d)
    cuts = aggregate.exact_quantiles(x, "close_diff", {"bottom": 0.05, "top": 0.95}, SERIES)
    category = scalar.three_way(F.col("close_diff"), F.col("bottom"), F.col("top"))
    return attach(x, cuts).select(*PK_COLS, "close_diff", category.alias("category"))


add(
    "price_category",
    lambda s, d: tidy(_categories(s, d)),
    sql(
        f"""select {PK}, close_diff, case when close_diff > top then 1 when close_diff < bottom then -1 else 0 end as category
        from (select *, row_number() over (partition by {K} order by close_diff) as rk, count(*) over (partition by {K}) as n
              from predictions) p
        join (select {K}, max(close_diff) filter (where rk = ceil(0.05 * n)) as bottom,
                     max(close_diff) filter (where rk = ceil(0.95 * n)) as top
              from (select *, row_number() over (partition by {K} order by close_diff) as rk,
                           count(*) over (partition by {K}) as n from predictions) group by all) using ({K})""",
        "close_diff",
    ),
)
add(
    "date_parts",
    lambda s, d: candles(s, d).select(*PK_COLS).withColumns(scalar.date_parts(F.col("timestamp"))),
    sql(
        f"""select {PK}, cast(year(t) as integer) as year, cast(month(t) as integer) as month,
        cast(day(t) as integer) as day from (select *, make_timestamp("timestamp" * 1000000) as t from candles)"""
    ),
)


def _times(s, d):
    c = candles(s, d).select(*PK_COLS)
    ts = F.col("timestamp")
    when = scalar.seconds_to_datetime(ts)
    c = c.withColumns(
        {
            "utc": when,
            "iso": F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z")),
            "day": F.date_format(when, "dd-MM-yyyy"),
        }
    )
    return c.withColumns(
        {
            "from_iso": scalar.iso_to_seconds(F.col("iso")),
            "from_day": scalar.day_to_seconds(F.col("day")),
            "from_ms": scalar.scaled_to_seconds(ts * 1000 + 999, 1000),
            "from_ns": scalar.scaled_to_seconds(ts * 1_000_000_000 + 7, 1_000_000_000),
            "closing_time": ts + F.col("period"),
        }
    )


add(
    "time_conversions",
    _times,
    sql(
        f"""select {PK}, make_timestamp("timestamp" * 1000000) as utc,
        strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%dT%H:%M:%S.000Z') as iso,
        strftime(make_timestamp("timestamp" * 1000000), '%d-%m-%Y') as day,
        "timestamp" as from_iso, ("timestamp" // 86400) * 86400 as from_day, "timestamp" as from_ms,
        "timestamp" as from_ns, "timestamp" + period as closing_time from candles"""
    ),
)


def _names(s, d):
    c = candles(s, d).select(
        F.when(F.col("exchange") == "click", "coinbase_pro").otherwise(F.col("exchange")).alias("ex"),
        F.when(F.col("trading_pair") == "p0", "eth_btc").otherwise("btc_usdt").alias("tp"),
        "period",
    )
    bare = F.concat_ws("_", "ex", "tp")
    names = F.array(
        F.struct(bare.alias("name"), F.lit(False).alias("_p")),
        F.struct(F.concat_ws("_", bare, F.col("period").cast("string")).alias("name"), F.lit(True).alias("_p")),
    )
    c = c.groupBy("ex", "tp", "period").agg(F.count(F.lit(1)).alias("n")).withColumn("_x", F.explode(names))
    return c.select(F.col("_x.name").alias("name"), "n").withColumns(scalar.parse_series_name(F.col("name")))


add(
    "parse_series_name",
    _names,
    sql(
        """select name, n, ex as exchange, tp as trading_pair, case when p then period end as period
        from (select *, ex || '_' || tp || case when p then '_' || period else '' end as name
              from (select case when exchange = 'click' then 'coinbase_pro' else exchange end as ex,
                           case when trading_pair = 'p0' then 'eth_btc' else 'btc_usdt' end as tp, period, count(*) as n
                    from candles group by all), (values (true), (false)) v(p))"""
    ),
)


def _prediction_texts(s, d):
    rises = base.predictions(s, d).select(*PK_COLS, "y_pred")
    rises = rises.select("timestamp", "trading_pair", "exchange", scalar.trade_label(F.col("y_pred")).alias("trade"))
    arbs = states(s, d).select(
        "timestamp",
        "trading_pair",
        F.col("exchange_1").alias("exchange"),
        "exchange_2",
        scalar.arbitrage_label(F.col("arbitrage_opportunity")).alias("arbitrage"),
    )
    return arbs.join(rises, ["timestamp", "trading_pair", "exchange"])


add(
    "prediction_labels",
    _prediction_texts,
    sql(
        """select "timestamp", trading_pair, exchange, exchange_2, case when y_pred then 'Up' else 'Down' end as trade,
        case arbitrage_opportunity when -1 then 'arb from exchange_2 to exchange_1'
             when 1 then 'arb from exchange_1 to exchange_2' else 'no_arbitrage' end as arbitrage
        from (select "timestamp", trading_pair, exchange_1 as exchange, exchange_2, arbitrage_opportunity from states)
        join predictions using ("timestamp", trading_pair, exchange)"""
    ),
)
