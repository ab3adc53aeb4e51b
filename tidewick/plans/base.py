"""Inputs shared by the registered queries, and the SQL text the oracles share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.operators import arbitrage, ordered
from tidewick.operators.gaps import gap_fill
from tidewick.operators.joins import cross_exchange_join
from tidewick.session import materialise
from tidewick.sources.ticks import read_candles

HOUR = 3600


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (and -0 made 0), so that two engines can be compared."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in doubles}) if doubles else df


def candles(spark: SparkSession, sf: str) -> DataFrame:
    return read_candles(spark, sf, HOUR)


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly candles without gaps."""
    return gap_fill(candles(spark, sf))


def restated(spark: SparkSession, sf: str) -> DataFrame:
    """Every candle twice, the second time with a higher close."""
    c = candles(spark, sf)
    return c.unionByName(c.withColumn("close", F.col("close") + 1))


def diffs(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.close_diff(candles(spark, sf))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Candles with a change and the naive prediction that a rise goes on."""
    d = diffs(spark, sf).where(F.col("close_diff").isNotNull())
    return d.withColumn("y_pred", F.col("close_diff") > 0)


def states(spark: SparkSession, sf: str) -> DataFrame:
    return arbitrage.with_state(cross_exchange_join(materialise(grid(spark, sf)), ["close"]))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return arbitrage.window_length(states(spark, sf))


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return arbitrage.with_target(runs(spark, sf), 6 * HOUR, HOUR)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents' quality against toxicity, as actual and predicted labels."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    return labels.join(docs, "doc_id").select(
        F.col("lang").alias("model_name"), F.col("quality").alias("actual"), F.col("toxic").alias("predicted")
    )


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Arbitrage models to compare: each predicts the state of some hours ago (0, 1, 2).

    One row per prediction: ex_tp, max_features, max_depth, n_estimators, model_name, actual,
    predicted, pct_profit.
    """
    d = targets(spark, sf)
    d = arbitrage.with_profit(d, 6 * HOUR, HOUR)
    d = ordered.shifted(d, {"_lag1": "arbitrage_opportunity"}, -1, True, arbitrage.PAIR)
    d = ordered.shifted(d, {"_lag2": "arbitrage_opportunity"}, -2, True, arbitrage.PAIR)
    models = F.array(
        *[
            F.struct(F.lit(50 + 5 * i).alias("max_features"), F.lit(14 + i).alias("max_depth"), F.col(c).alias("pred"))
            for i, c in enumerate(["arbitrage_opportunity", "_lag1", "_lag2"])
        ]
    )
    d = d.withColumn("_m", F.explode(models)).where(F.col("_m.pred").isNotNull())
    d = d.select(
        F.concat_ws("_", "exchange_1", "exchange_2", "trading_pair").alias("ex_tp"),
        "_m.max_features",
        "_m.max_depth",
        F.lit(100).alias("n_estimators"),
        F.col("target").alias("actual"),
        F.col("_m.pred").alias("predicted"),
        "pct_profit",
    )
    return d.withColumn("model_name", F.concat_ws("_", "ex_tp", "max_features", "max_depth", "n_estimators"))


MODEL = ["ex_tp", "max_features", "max_depth", "n_estimators", "model_name"]

# ---------------------------------------------------------------------------------------------

CTES = """
ticks as (
  select event_type as exchange, 'p' || (user_id % 2) as trading_pair, ts, event_id,
         epoch_us(ts) as micros, 100 + value / 100 as price,
         cast(json_extract_string(props, '$.k') as double) as qty
  from events),
candles as (
  select case when event_type in ('click', 'view') then 'direct' else 'aggregator' end as api, t.*
  from (
    select exchange, exchange as event_type, trading_pair, 3600::integer as period,
           (micros // 3600000000) * 3600 as "timestamp",
           arg_min(price, (micros, event_id)) as open, max(price) as high, min(price) as low,
           arg_max(price, (micros, event_id)) as "close", sum(qty) as volume
    from ticks group by all) t),
slots as (
  select exchange, trading_pair, period, unnest(range(lo, hi + 1, 3600)) as "timestamp"
  from (select exchange, trading_pair, period, min("timestamp") as lo, max("timestamp") as hi
        from candles group by all)),
raw_grid as (
  select s.exchange, s.trading_pair, s.period, s."timestamp", open, high, low, "close", volume
  from slots s left join candles c using (exchange, trading_pair, period, "timestamp")),
grid as (
  select exchange, trading_pair, period, "timestamp",
         coalesce(open, fc) as open, coalesce(high, fc) as high, coalesce(low, fc) as low, fc as "close",
         coalesce(volume, 0) as volume, cast("close" is null as integer) as nan_ohlcv
  from (select *, last_value("close" ignore nulls) over
          (partition by exchange, trading_pair, period order by "timestamp") as fc from raw_grid)),
diffs as (
  select *, ("close" - pc) / pc as close_diff
  from (select *, lag("close") over (partition by exchange, trading_pair, period order by "timestamp") as pc
        from candles)),
predictions as (select *, close_diff > 0 as y_pred from diffs where close_diff is not null),
states as (
  select *, case when pct_higher < 0.55 then 0 when higher_closing_price = 1 then -1
                 when higher_closing_price = 2 then 1 else 0 end as arbitrage_opportunity
  from (
    select a.exchange as exchange_1, b.exchange as exchange_2, a.trading_pair, a.period, a."timestamp",
           a."close" as close_exchange_1, b."close" as close_exchange_2,
           case when a."close" > b."close" then 1 when a."close" < b."close" then 2 else 0 end as higher_closing_price,
           case when a."close" > b."close" then (a."close" / b."close" - 1) * 100
                when a."close" < b."close" then (b."close" / a."close" - 1) * 100 else 0.0 end as pct_higher
    from grid a join grid b using (trading_pair, period, "timestamp") where a.exchange < b.exchange)),
islands as (
  select *, sum(case when prev is null or prev <> arbitrage_opportunity then 1 else 0 end) over
      (partition by exchange_1, exchange_2, trading_pair, period order by "timestamp") as island
  from (select *, lag(arbitrage_opportunity) over
          (partition by exchange_1, exchange_2, trading_pair, period order by "timestamp") as prev from states)),
runs as (
  select * exclude (prev, island), 60 * row_number() over
      (partition by exchange_1, exchange_2, trading_pair, period, island order by "timestamp") as window_length
  from islands),
targets as (
  select *, case when window_length_shift >= 360 then arbitrage_opportunity_shift else 0 end as target
  from (
    select *, lead(arbitrage_opportunity, 7) over w as arbitrage_opportunity_shift,
           lead(window_length, 7) over w as window_length_shift
    from runs window w as (partition by exchange_1, exchange_2, trading_pair, period order by "timestamp"))
  where arbitrage_opportunity_shift is not null),
profits as (
  select * exclude (raw_profit), lead(raw_profit, 2) over w as pct_profit
  from (
    select *, case when higher_closing_price = 1 then (close_exchange_1_shift / close_exchange_2 - 1) * 100 - 0.55
                   when higher_closing_price = 2 then (close_exchange_2_shift / close_exchange_1 - 1) * 100 - 0.55
                   else 0.0 end as raw_profit
    from (
      select *, lead(close_exchange_1, 8) over w as close_exchange_1_shift,
             lead(close_exchange_2, 8) over w as close_exchange_2_shift
      from targets window w as (partition by exchange_1, exchange_2, trading_pair, period order by "timestamp")))
  window w as (partition by exchange_1, exchange_2, trading_pair, period order by "timestamp")),
lagged as (
  select *, lag(arbitrage_opportunity, 1) over w as lag1, lag(arbitrage_opportunity, 2) over w as lag2
  from profits window w as (partition by exchange_1, exchange_2, trading_pair, period order by "timestamp")),
results as (
  select ex_tp || '_' || max_features || '_' || max_depth || '_100' as model_name, *
  from (
    select exchange_1 || '_' || exchange_2 || '_' || trading_pair as ex_tp,
           m.f as max_features, m.d as max_depth, 100 as n_estimators, target as actual, m.p as predicted, pct_profit
    from (select *, unnest([{'f': 50, 'd': 14, 'p': arbitrage_opportunity}, {'f': 55, 'd': 15, 'p': lag1},
                            {'f': 60, 'd': 16, 'p': lag2}]) as m from lagged)
    where m.p is not null)),
labelled as (
  select lang as model_name, quality as actual, toxic as predicted from labels join documents using (doc_id))
"""

K = "exchange, trading_pair, period"
PK = f'{K}, "timestamp"'
PAIR_PK = 'exchange_1, exchange_2, trading_pair, period, "timestamp"'
W = f'partition by {K} order by "timestamp"'
WP = 'partition by exchange_1, exchange_2, trading_pair, period order by "timestamp"'
OHLCV_SQL = 'open, high, low, "close", volume'


def sql(body: str, doubles: str = "", digits: int = 6, ctes: str = "") -> str:
    """An oracle: the shared tables, ``body``, and the given columns rounded."""
    names = doubles.split()
    inner = f"with recursive {CTES}{',' + ctes if ctes else ''} {body}"
    if not names:
        return inner
    rounded = ", ".join(f'round(cast("{c}" as double), {digits}) + 0.0 as "{c}"' for c in names)
    return f"select * replace ({rounded}) from ({inner})"


PRICES = "open high low close volume"
