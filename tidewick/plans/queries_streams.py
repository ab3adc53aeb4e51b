"""Registered queries: streaming jobs."""


from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.functions import indicators
from tidewick.functions.scalar import arbitrage_label, seconds_to_datetime
from tidewick.plans import features, models
from tidewick.plans.base import HOUR, K, OHLCV_SQL, PAIR_PK, PK, PRICES, W, candles, sql, states, tidy
from tidewick.plans.queries_models import _subset, _trade_models
from tidewick.plans.queries_tables import _VENDOR_SQL, STORED, _damaged, _landed
from tidewick.plans.queries_technical import TA
from tidewick.schema import OHLCV, PAIR, SERIES, TRADE_PREDICTION_KEY
from tidewick.schema import PK as PK_COLS
from tidewick.session import materialise, scratch_path
from tidewick.sinks.tables import write_predictions
from tidewick.streaming import jobs, live, partials

QUERIES, ORACLES = {}, {}


def add(key, query, oracle=None):
    QUERIES[key] = query
    if oracle is not None:
        ORACLES[key] = oracle


def _folders(s, name):
    path = scratch_path(s, name)
    return f"{path}/out", f"{path}/checkpoint"


def _stream_candles(s, d):
    out, checkpoint = _folders(s, "stream-candles")
    return jobs.run_to_files(jobs.candle_stream(jobs.tick_stream(s, f"{d}/events.parquet"), HOUR), out, checkpoint)


add(
    "stream_candles",
    lambda s, d: tidy(_stream_candles(s, d)),
    sql(
        f"""select {PK}, {OHLCV_SQL} from candles
        where "timestamp" + 3600 <= (select max(epoch_us(ts)) from events) // 1000 / 1000.0 - 600""",
        PRICES,
    ),
)


LATE_FILES = 12


def _stream_late_ticks(s, d):
    """Ticks land in files that each span all days, so nearly all are late by days; deltas are compacted between two runs."""
    path, checkpoint = _folders(s, "late-ticks")
    landing = scratch_path(s, "late-landing")
    events = s.read.parquet(f"{d}/events.parquet").withColumn("_file", F.pmod(F.xxhash64("event_id"), F.lit(LATE_FILES)))
    for first in (True, False):
        part = events.where((F.col("_file") < LATE_FILES // 2) == F.lit(first))
        part.repartitionByRange(LATE_FILES // 2, "_file").drop("_file").write.mode("append").parquet(landing)
        partials.write_deltas(jobs.tick_stream(s, landing, files_per_trigger=1), HOUR, path, checkpoint)
        partials.compact(s, path, 4)
    return partials.candles(s, path)


add("stream_late_ticks", lambda s, d: tidy(_stream_late_ticks(s, d)), sql(f"select {PK}, {OHLCV_SQL} from candles", PRICES))


def _stream_dedupe(s, d):
    """Two feeds deliver the same ticks."""
    out, checkpoint = _folders(s, "stream-dedupe")
    path = f"{d}/events.parquet"
    both = jobs.tick_stream(s, path).unionByName(jobs.tick_stream(s, path))
    return jobs.run_to_files(jobs.dedupe_stream(both, ["seq"]).drop("at"), out, checkpoint)


add(
    "stream_dedupe",
    lambda s, d: _stream_dedupe(s, d),
    sql("select exchange, trading_pair, micros, event_id as seq, price, qty from ticks"),
)


def _stream_ingest(s, d):
    """Two runs: first the responses of one pair land, then those of all pairs."""
    out, checkpoint = _folders(s, "stream-ingest")
    landing = scratch_path(s, "landing")
    landed = materialise(_landed(s, d), "landed")
    first = landed.where(F.col("trading_pair") == "btc_usd")
    for part in (first, landed):
        part.write.mode("append").json(landing)
        jobs.ingest(s, landing, landed.schema, out, checkpoint, 1_894_000_000)
    return s.read.schema("api string, exchange string, trading_pair string, period int, timestamp long, "
                         + ", ".join(f"{c} double" for c in OHLCV)).parquet(out)


add(
    "stream_ingest",
    lambda s, d: tidy(_stream_ingest(s, d)),
    sql(f"select api, {PK}, {OHLCV_SQL} from vendors", PRICES, ctes=_VENDOR_SQL),
)


def _stream_rejects(s, d):
    """Damaged responses among good ones, in two batches, the second when more candles have closed."""
    out, checkpoint = _folders(s, "stream-rejects")
    landing = scratch_path(s, "landing")
    landed = materialise(_damaged(s, d), "landed")
    for part, now in ((F.col("trading_pair") == "btc_usd", STORED), (F.col("trading_pair") != "btc_usd", 1_894_000_000)):
        landed.where(part).write.mode("append").json(landing)
        jobs.ingest(s, landing, landed.schema, out, checkpoint, now)
    bad = jobs.rejected_candles(s, out, T.StructType.fromDDL("api string, exchange string, trading_pair string, period int"))
    kept = s.read.schema("api string, exchange string, trading_pair string, period int").parquet(out)
    count = lambda df, name: df.groupBy("api", *SERIES).agg(F.count(F.lit(1)).alias(name))
    return count(bad, "rejected").join(count(kept, "kept"), ["api", *SERIES], "full").fillna(0)


add(
    "stream_rejects",
    _stream_rejects,
    sql(
        f"""select * replace (coalesce(kept, 0) as kept) from (
          select api, {K}, sum(n)::bigint as rejected from (
            select api, {K}, count(distinct "timestamp" // 86400) as n from vendors group by all
            union all select 'nobody', {K}, count(distinct "timestamp" // 86400) from vendors group by all
            union all select api, {K}, count(*) from vendors where api = 'poloniex' group by all) group by all)
        left join (select api, {K}, count(*) as kept from vendors group by all) using (api, {K})""",
        ctes=_VENDOR_SQL,
    ),
)


def _stream_runs(s, d):
    """Arbitrage states arriving as twelve files, one a batch, each continuing the runs before; the third comes again."""
    out, checkpoint = _folders(s, "stream-runs")
    source = scratch_path(s, "states")
    table = materialise(states(s, d).select(*PAIR, "timestamp", "arbitrage_opportunity"), "states")
    for k in [*range(SLICES), 2]:
        inside = F.col("timestamp") >= SLICE_FROM + k * SLICE if k else F.lit(True)
        until = F.col("timestamp") < SLICE_FROM + (k + 1) * SLICE if k < SLICES - 1 else F.lit(True)
        table.where(inside & until).coalesce(1).write.mode("append").parquet(source)
    stream = s.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
    return jobs.run_to_files(jobs.window_length_stream(stream), out, checkpoint)


SLICES, SLICE_FROM, SLICE = 12, 1_704_067_200, 216_000
add(
    "stream_window_length",
    lambda s, d: _stream_runs(s, d).where(~F.col("late")).drop("late"),
    sql(f"select {PAIR_PK}, arbitrage_opportunity, window_length from runs"),
)


def _stream_reordered(s, d):
    """The same rows dealt over files that overlap by a slice, so that each file has rows older than the file before."""
    out, checkpoint = _folders(s, "stream-reordered")
    source = scratch_path(s, "states")
    table = materialise(states(s, d).select(*PAIR, "timestamp", "arbitrage_opportunity"), "states")
    shift = F.pmod(F.xxhash64(*PAIR, "timestamp"), F.lit(SLICE))
    place = F.least(F.greatest(F.floor((F.col("timestamp") + shift - SLICE_FROM) / SLICE), F.lit(0)), F.lit(SLICES))
    for k in range(SLICES + 1):
        table.where(place == k).coalesce(1).write.mode("append").parquet(source)
    stream = s.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
    return jobs.run_to_files(jobs.reordered_length_stream(stream, SLICE), out, checkpoint)


add(
    "stream_reordered_length",
    lambda s, d: _stream_reordered(s, d),
    sql(
        f"""select {PAIR_PK}, arbitrage_opportunity, window_length, false as late from runs
        where "timestamp" <= (select max("timestamp") from runs) - {SLICE}"""
    ),
)
add(
    "stream_late_rows",
    lambda s, d: _stream_runs(s, d).where("late").select(*PAIR, "timestamp", "arbitrage_opportunity"),
    sql(
        f"""select {PAIR_PK}, arbitrage_opportunity from states
        where "timestamp" >= {SLICE_FROM + 2 * SLICE} and "timestamp" < {SLICE_FROM + 3 * SLICE}"""
    ),
)



def _arb_predictions(s, d):
    """The state of each pair as its prediction, due one period later."""
    due = seconds_to_datetime(F.col("timestamp") + F.col("period"))
    return states(s, d).select(
        due.alias("p_time"),
        due.alias("c_time"),
        "exchange_1",
        "exchange_2",
        "trading_pair",
        arbitrage_label(F.col("arbitrage_opportunity")).alias("prediction"),
    )


add(
    "recent_alerts",
    lambda s, d: jobs.recent_alerts(_arb_predictions(s, d), F.lit("2024-01-31 00:05:00").cast("timestamp_ntz"), 6 * HOUR),
    sql(
        """select * from (
          select make_timestamp(("timestamp" + period) * 1000000) as p_time,
            make_timestamp(("timestamp" + period) * 1000000) as c_time, exchange_1, exchange_2, trading_pair,
            case arbitrage_opportunity when -1 then 'arb from exchange_2 to exchange_1'
              when 1 then 'arb from exchange_1 to exchange_2' else 'no_arbitrage' end as prediction
          from states)
        where p_time > timestamp '2024-01-30 18:05:00' and prediction <> 'no_arbitrage'"""
    ),
)


def _live_stream(s, d, arriving, each):
    """Hourly candles arriving as twelve files, one a micro-batch; the stream stops half-way and resumes."""
    rows = materialise(candles(s, d).select(*PK_COLS, *OHLCV), "candles")
    place = F.least(F.greatest(F.floor((F.col("timestamp") - SLICE_FROM) / SLICE), F.lit(0)), F.lit(SLICES - 1))
    for half in (range(SLICES // 2), range(SLICES // 2, SLICES)):
        for k in half:
            rows.where(place == k).coalesce(1).write.mode("append").parquet(arriving)
        each(s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(arriving))


def _stream_indicators(s, d):
    """All indicators from the state of each series alone."""
    out, checkpoint = _folders(s, "stream-indicators")
    _live_stream(s, d, scratch_path(s, "arriving"), lambda c: jobs.run_to_files(live.live_indicators(c), out, checkpoint))
    return s.read.schema(live.OUTPUT).parquet(out)


add(
    "stream_indicators",
    lambda s, d: tidy(_stream_indicators(s, d)),
    sql(
        f"""select {PK}, {", ".join(f'g."{x}"' for x in OHLCV)}, g.nan_ohlcv, 'ok' as status, {", ".join(indicators.ALL)},
        (t."close" - t.pc) / nullif(t.pc, 0) as close_diff from grid g join ta t using ({PK})""",
        " ".join([*OHLCV, *indicators.ALL, "close_diff"]),
        ctes=TA,
    ),
)


def _stream_scoring(s, d):
    """The newest row of every series is scored in each of twelve micro-batches, with features from its live state.

    Models are trained on the whole history.  Beside the keys of the predictions come the features they were made from.
    """
    path = scratch_path(s, "models")
    _, columns, forests = _trade_models(s, d, path)
    rows_out, checkpoint = _folders(s, "stream-scoring")
    out = scratch_path(s, "scored")

    def score(newest, number):
        newest.write.mode("overwrite").parquet(f"{rows_out}/batch={number}")
        stored = s.read.schema(newest.schema).parquet(f"{rows_out}/batch={number}")
        rows = models.trade_rows(stored.withColumn("target", F.lit(False)), columns)
        write_predictions(models.score_newest(rows, forests, SERIES, columns, _subset(columns)), out, TRADE_PREDICTION_KEY)

    _live_stream(
        s, d, scratch_path(s, "arriving"),
        lambda c: live.score_stream(live.live_indicators(c, filled=True), score, checkpoint),
    )
    found = s.read.schema("p_time timestamp_ntz, c_time timestamp_ntz, exchange string, trading_pair string, prediction string").parquet(out)
    complete = F.col("prediction").isNotNull() & F.col("c_time").isNotNull()
    made = found.select("p_time", "exchange", "trading_pair", complete.alias("complete"))
    rows = s.read.parquet(rows_out).withColumn("p_time", seconds_to_datetime(F.col("timestamp") + F.col("period")))
    return made.join(rows.select("p_time", *PK_COLS, *features.TRADE_FEATURES), ["p_time", "exchange", "trading_pair"], "full")


_SO_FAR = f"({W} rows between unbounded preceding and current row)"
_BATCH = f"""least(greatest(("timestamp" - {SLICE_FROM}) // {SLICE}, 0), {SLICES - 1})"""
add(
    "stream_scoring",
    lambda s, d: tidy(_stream_scoring(s, d)),
    sql(
        f"""select make_timestamp(("timestamp" + period) * 1000000) as p_time, true as complete, {PK},
        {", ".join(f'g."{x}"' for x in OHLCV)}, g.nan_ohlcv, cast(year(day) as integer) as year, cast(month(day) as integer) as month,
        cast(day(day) as integer) as day, {", ".join(features.TRADE_INDICATORS)}, close_diff
        from (select *, make_timestamp("timestamp" * 1000000) as day from grid) g join so_far using ({PK})
        join (select {K}, max("timestamp") as "timestamp" from candles group by {K}, {_BATCH}) using ({PK})""",
        " ".join([*OHLCV, *features.TRADE_INDICATORS, "close_diff"]),
        ctes=TA + f""",
so_far as (
  select {PK}, ("close" - pc) / nullif(pc, 0) as close_diff,
    {", ".join(f"case when avg(cast({c} is null as double)) over {_SO_FAR} < 0.2 then coalesce({c}, avg({c}) over {_SO_FAR}) end as {c}" for c in features.TRADE_INDICATORS)}
  from (select {PK}, "close", pc, {", ".join(f"case when isfinite({c}) then {c} end as {c}" for c in features.TRADE_INDICATORS)} from ta))""",
    ),
)


def _stream_alerts(s, d):
    """Arbitrage predictions in two batches; what the alert stream hands over is kept."""
    out, checkpoint = _folders(s, "alerts")
    source = scratch_path(s, "predictions")
    table = materialise(_arb_predictions(s, d), "predictions")
    half = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (F.col("p_time") < half, F.col("p_time") >= half):
        table.where(part).write.mode("append").parquet(source)
        jobs.alert_stream(
            s.readStream.schema(table.schema).parquet(source),
            lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}"),
            checkpoint,
        )
    return s.read.schema(table.schema).parquet(out).select(*table.columns)


add(
    "alert_stream",
    _stream_alerts,
    sql(
        """select * from (
          select make_timestamp(("timestamp" + period) * 1000000) as p_time,
            make_timestamp(("timestamp" + period) * 1000000) as c_time, exchange_1, exchange_2, trading_pair,
            case arbitrage_opportunity when -1 then 'arb from exchange_2 to exchange_1'
              when 1 then 'arb from exchange_1 to exchange_2' else 'no_arbitrage' end as prediction
          from states) where prediction <> 'no_arbitrage'"""
    ),
)
