"""Registered queries: scans, files, vendor payloads, writers."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.functions.scalar import seconds_to_datetime
from tidewick.plans import base
from tidewick.plans.base import HOUR, K, OHLCV_SQL, PK, PRICES, candles, restated, sql, tidy
from tidewick.schema import OHLCV, PREDICTION, PREDICTION_KEY, PREDICTION_LAYOUT, SERIES
from tidewick.schema import PK as PK_COLS
from tidewick.session import scratch_path
from tidewick.sinks import tables
from tidewick.sources import candles as scans
from tidewick.sources import payloads, universe

QUERIES, ORACLES = {}, {}


def add(key, query, oracle=None):
    QUERIES[key] = query
    if oracle is not None:
        ORACLES[key] = oracle


# --- scans of the partitioned table ----------------------------------------------------------


def _table(s, d):
    """The candle table on disk, partitioned by period and exchange."""
    path = scratch_path(s, "candles")
    tables.write_candles(candles(s, d), path)
    return scans.read_table(s, path)


T0, T1 = 1_704_200_000, 1_706_000_000
add(
    "scan_candles",
    lambda s, d: tidy(
        scans.scan_candles(_table(s, d), exchange="click", trading_pair="p1", start=T0, end="26-01-2024", period=HOUR)
    ),
    sql(
        f"""select open, "close", high, low, "timestamp", volume, period from candles
        where exchange = 'click' and trading_pair = 'p1' and period = 3600 and "timestamp" >= {T0}
          and "timestamp" <= 1706227200""",
        PRICES,
    ),
)
add(
    "scan_all_candles",
    lambda s, d: tidy(scans.scan_candles(_table(s, d), period=HOUR, verbose=True).select("api", *PK_COLS, *OHLCV)),
    sql(f"select api, {PK}, {OHLCV_SQL} from candles", PRICES),
)
add(
    "scan_series",
    lambda s, d: tidy(scans.scan_series(_table(s, d), "view", "p0", HOUR).select(*PK_COLS, *OHLCV)),
    sql(f"select {PK}, {OHLCV_SQL} from candles where exchange = 'view' and trading_pair = 'p0'", PRICES),
)
add(
    "scan_by_api",
    lambda s, d: tidy(scans.scan_by_api(_table(s, d), "direct").select("api", *PK_COLS, *OHLCV)),
    sql(f"select api, {PK}, {OHLCV_SQL} from candles where api = 'direct'", PRICES),
)


def _named(s, d):
    """Candles under currency-pair names, as the archives call them."""
    pair = F.when(F.col("trading_pair") == "p0", "eth_btc").otherwise("btc_usdt")
    return candles(s, d).withColumn("trading_pair", pair)


_NAMED = f"""select exchange, case when trading_pair = 'p0' then 'eth_btc' else 'btc_usdt' end as trading_pair, period,
  "timestamp", {OHLCV_SQL} from candles"""


def _archive(s, d):
    path = scratch_path(s, "archive")
    tables.write_csv_archive(_named(s, d), path)
    return scans.read_csv_candles(s, f"{path}/series=*")


add("csv_roundtrip", lambda s, d: tidy(_archive(s, d)), sql(_NAMED, PRICES))


def _bulk(s, d):
    """Archive files into the table; the period of a file's name is its partition."""
    path = scratch_path(s, "bulk")
    tables.write_candles(_archive(s, d), path)
    return s.read.schema(T.StructType([f for f in scans.CANDLE.fields if f.name != "api"])).parquet(path)


add("csv_bulk_load", lambda s, d: tidy(_bulk(s, d).select(*PK_COLS, *OHLCV)), sql(_NAMED, PRICES))

# --- vendor payloads -------------------------------------------------------------------------

# which vendor each exchange of the test data stands for
_VENDOR_OF = {
    "error": ("cryptowatch", "kraken"),
    "click": ("coincap", "binance"),
    "view": ("hitbtc", "hitbtc"),
    "signup": ("bitfinex", "bitfinex"),
    "purchase": ("poloniex", "poloniex"),
}
_PAIR_OF = {"p0": "bch_btc", "p1": "btc_usd"}


def _vendor_candles(s, d):
    c = candles(s, d).drop("api")
    m = F.create_map(*[x for k, (a, e) in _VENDOR_OF.items() for x in (F.lit(k), F.struct(F.lit(a), F.lit(e)))])
    p = F.create_map(*[F.lit(x) for kv in _PAIR_OF.items() for x in kv])
    return c.select(
        m[F.col("exchange")]["col1"].alias("api"),
        m[F.col("exchange")]["col2"].alias("exchange"),
        p[F.col("trading_pair")].alias("trading_pair"),
        "period",
        "timestamp",
        *OHLCV,
    )


_VENDOR_SQL = (
    "vendors as (select c.* replace (v.e as exchange, p.n as trading_pair, v.a as api) from candles c join (values "
    + ", ".join(f"('{k}', '{a}', '{e}')" for k, (a, e) in _VENDOR_OF.items())
    + ") v(x, a, e) on v.x = c.exchange join (values "
    + ", ".join(f"('{k}', '{n}')" for k, n in _PAIR_OF.items())
    + ") p(y, n) on p.y = c.trading_pair)"
)


def _landed(s, d):
    """One response per series and day, written the way its vendor writes it."""
    ts, text = F.col("timestamp"), lambda c: F.col(c).cast("string")
    values = {c: text(c) for c in OHLCV}
    iso = F.concat(F.date_format(seconds_to_datetime(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    time = (
        F.when(F.col("api").isin("coincap", "bitfinex"), (ts * 1000).cast("string"))
        .when(F.col("api") == "hitbtc", iso)
        .otherwise(ts.cast("string"))
    )

    def array(order):
        return F.concat(F.lit("["), F.concat_ws(",", *[values.get(c, F.col("_time")) for c in order]), F.lit("]"))

    def record(fields):
        quoted = F.concat(F.lit('"'), F.col("_time"), F.lit('"'))
        parts = [F.concat(F.lit(f'"{f}":'), values.get(c, quoted)) for c, f in fields.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    one = F.when(F.col("api") == "cryptowatch", array(universe.VENDORS["cryptowatch"]["candle"])).when(
        F.col("api") == "bitfinex", array(universe.VENDORS["bitfinex"]["candle"])
    )
    for vendor, fields in payloads.OBJECT_FIELDS.items():
        one = one.when(F.col("api") == vendor, record(fields))
    c = _vendor_candles(s, d).withColumn("_time", time).withColumn("_one", one)
    # a response is one page: at most a day of one series
    pages = c.groupBy("api", *SERIES, F.expr("timestamp div 86400").alias("page")).agg(
        F.array_join(F.array_sort(F.collect_list("_one")), ",").alias("_list")
    )
    body = F.concat(F.lit("["), F.col("_list"), F.lit("]"))
    payload = (
        F.when(F.col("api") == "cryptowatch", F.concat(F.lit('{"result":{"3600":'), body, F.lit("}}")))
        .when(F.col("api") == "coincap", F.concat(F.lit('{"data":'), body, F.lit("}")))
        .otherwise(body)
    )
    return pages.select("api", *SERIES, payload.alias("payload"))


add(
    "parse_candle_payload",
    lambda s, d: tidy(payloads.unwrap_payloads(_landed(s, d))),
    sql(
        f"""select api, {K}, case when api in ('coincap', 'bitfinex') then cast("timestamp" * 1000 as varchar)
          when api = 'hitbtc' then strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%dT%H:%M:%S.000Z')
          else cast("timestamp" as varchar) end as raw_time, {OHLCV_SQL} from vendors""",
        PRICES,
        ctes=_VENDOR_SQL,
    ),
)
add(
    "normalize_candles",
    lambda s, d: tidy(
        payloads.normalize_candles(payloads.unwrap_payloads(_landed(s, d)))[0].select("api", *PK_COLS, *OHLCV)
    ),
    sql(f"select api, {PK}, {OHLCV_SQL} from vendors", PRICES, ctes=_VENDOR_SQL),
)


def _damaged(s, d):
    """Beside the good responses: some cut short, some with a candle without its close, some of an unknown vendor."""
    landed = _landed(s, d)
    cut = landed.withColumn("payload", F.substring("payload", 1, 5))
    unknown = landed.withColumn("api", F.lit("nobody"))
    empty = landed.withColumn("payload", F.lit("[]")).where(F.col("api") == "poloniex")
    partial = landed.where(F.col("api") == "poloniex").withColumn("payload", F.regexp_replace("payload", '"close":[^,}]*', '"close":null'))
    return landed.unionByName(cut).unionByName(unknown).unionByName(empty).unionByName(partial)


add(
    "rejected_payloads",
    lambda s, d: payloads.normalize_candles(payloads.unwrap_payloads(_damaged(s, d)))[1]
    .groupBy("api", *SERIES).agg(F.count(F.lit(1)).alias("n"), F.count("open").alias("with_open")),
    sql(
        f"""select api, {K}, sum(n)::bigint as n, sum(w)::bigint as with_open from (
          select api, {K}, count(distinct "timestamp" // 86400) as n, 0 as w from vendors group by all
          union all select 'nobody', {K}, count(distinct "timestamp" // 86400), 0 from vendors group by all
          union all select api, {K}, count(*), count(*) from vendors where api = 'poloniex' group by all) group by all""",
        ctes=_VENDOR_SQL,
    ),
)


def _twice(s, d):
    """Pages overlap: every response landed twice, first with values since corrected."""
    landed = _landed(s, d)
    stale = landed.where(F.col("api") == "poloniex").withColumn(
        "payload", F.regexp_replace("payload", '"close":[^,}]*', '"close":1')
    )
    first = landed.where(F.col("api") != "poloniex").unionByName(stale).withColumn("landed_at", F.lit(1))
    return landed.withColumn("landed_at", F.lit(2)).unionByName(first)


add(
    "vendor_candles",
    lambda s, d: tidy(payloads.vendor_candles(_twice(s, d), "landed_at")),
    sql(
        f"""select exchange, case when exchange = 'hitbtc' and trading_pair = 'btc_usd' then 'btc_usdt'
          else trading_pair end as trading_pair, period,
          case when api = 'cryptowatch' then "timestamp" else "timestamp" + period end as closing_time,
          open, high, low, "close", volume as base_volume from vendors""",
        "open high low close base_volume",
        ctes=_VENDOR_SQL,
    ),
)
add(
    "union_candles",
    lambda s, d: tidy(
        _vendor_candles(s, d)
        .unionByName(_vendor_candles(s, d).withColumn("source", F.lit("page")), allowMissingColumns=True)
        .drop("source")
        .distinct()
    ),
    sql(f"select api, {PK}, {OHLCV_SQL} from vendors", PRICES, ctes=_VENDOR_SQL),
)


def _universe(s, d):
    """Every listed series and how many candles of it have landed."""
    listed = universe.series_universe(universe.vendor_config(s))
    stored = _vendor_candles(s, d).groupBy("api", "exchange", "trading_pair").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(stored, ["api", "exchange", "trading_pair"], "left").fillna(0, ["n"])


# fixed values: the listed series
_LISTED = [
    (api, exchange, pair)
    for api, exchange, pairs in (
        ("cryptowatch", "gemini", "eth_btc btc_usd"),
        ("cryptowatch", "kraken", "eth_btc btc_usd bat_btc link_eth bch_btc eos_usd"),
        ("coincap", "binance", "eth_btc btc_usdt bat_btc link_eth bch_btc"),
        ("hitbtc", "hitbtc", "eth_btc btc_usd bat_btc eos_usd"),
        ("bitfinex", "bitfinex", "eth_btc btc_usd bat_btc bch_btc eos_usd"),
        ("poloniex", "poloniex", "eth_btc btc_usdt bat_btc eos_usdt"),
    )
    for pair in pairs.split()
]
add(
    "series_universe",
    _universe,
    sql(
        "select api, exchange, trading_pair, coalesce(n, 0) as n from (values "
        + ", ".join(f"('{a}', '{e}', '{p}')" for a, e, p in _LISTED)
        + """) u(api, exchange, trading_pair) left join (select api, exchange, trading_pair, count(*) as n
        from vendors group by all) using (api, exchange, trading_pair)""",
        ctes=_VENDOR_SQL,
    ),
)


def _symbols(s, d):
    landed = _vendor_candles(s, d).groupBy("api", "trading_pair").agg(F.count(F.lit(1)).alias("n"))
    out = universe.vendor_symbols(landed, universe.vendor_config(s))
    return out.withColumn("archive_symbol", universe.archive_symbol(F.col("api"), F.col("trading_pair")))


# api, canonical pair -> base, quote, symbol, symbol in the archives
_SYMBOLS = [
    ("cryptowatch", "bch_btc", "bch", "btc", "bchbtc", "bchbtc"),
    ("cryptowatch", "btc_usd", "btc", "usd", "btcusd", "btcusd"),
    ("coincap", "bch_btc", "bitcoin-cash", "bitcoin", "bch_btc", "bchbtc"),
    ("coincap", "btc_usd", "bitcoin", "united-states-dollar", "btc_usd", "btcusd"),
    ("hitbtc", "bch_btc", "bch", "btc", "BCHBTC", "BCHBTC"),
    ("hitbtc", "btc_usd", "btc", "usd", "BTCUSD", "BTCUSD"),
    ("bitfinex", "bch_btc", "bab", "btc", "BABBTC", "BABBTC"),
    ("bitfinex", "btc_usd", "btc", "usd", "BTCUSD", "BTCUSD"),
    ("poloniex", "bch_btc", "btc", "bch", "BTC_BCH", "bchbtc"),
    ("poloniex", "btc_usd", "usd", "btc", "USD_BTC", "btcusd"),
]
add(
    "pair_format",
    _symbols,
    sql(
        f"""select api, trading_pair, n, base_id, quote_id, symbol, archive_symbol
        from (select api, trading_pair, count(*) as n from vendors group by all)
        join (values {', '.join(str(r) for r in _SYMBOLS)}) v(api, trading_pair, base_id, quote_id, symbol, archive_symbol)
        using (api, trading_pair)""",
        ctes=_VENDOR_SQL,
    ),
)
_PERIODS = [300, 3_600, 7_200, 14_400, 86_400, 604_800]


def _labels(s, d):
    """The interval name of each landed series, resampled to longer periods."""
    c = _vendor_candles(s, d).drop("period").withColumn("period", F.explode(F.array(*[F.lit(p) for p in _PERIODS])))
    n = c.groupBy("api", "period").agg(F.countDistinct(F.expr("timestamp div period")).alias("n"))
    named = n.join(universe.vendor_config(s), "api")
    return named.select("api", "period", "n", universe.interval_label(F.col("period"), F.col("c")).alias("label"))


_LABELS = {
    "coincap": ["m5", "h1", "h2", "h4", "d1", "w1"],
    "hitbtc": ["M5", "H1", "H1", "H4", "D1", "D7"],
    "bitfinex": ["5m", "1h", "1h", "3h", "1d", "7d"],
}
add(
    "interval_label",
    _labels,
    sql(
        f"""select api, cast(p as integer) as period, n, label
        from (select api, p, count(distinct "timestamp" // p) as n
              from vendors, (values {', '.join(f'({p})' for p in _PERIODS)}) t(p) group by all)
        left join (values {', '.join(str((a, p, x)) for a, xs in _LABELS.items() for p, x in zip(_PERIODS, xs))})
          v(api, p, label) using (api, p)""",
        ctes=_VENDOR_SQL,
    ),
)

# --- writers ---------------------------------------------------------------------------------

STORED = 1_705_276_800


def _upserted(s, d):
    """All candles (twice, the copies restated) into a table that holds those before a date."""
    path = scratch_path(s, "upsert")
    every = restated(s, d)
    tables.insert_if_absent(candles(s, d).where(F.col("timestamp") < STORED).select(*every.columns), path)
    tables.insert_if_absent(every, path)
    return s.read.schema(every.schema).parquet(path)


add(
    "upsert_candles",
    lambda s, d: tidy(_upserted(s, d).select("api", *PK_COLS, *OHLCV)),
    sql(f"select api, {PK}, {OHLCV_SQL} from candles", PRICES),
)


def _batches(s, d):
    one = F.struct("timestamp", *OHLCV)
    day = F.expr("timestamp div 86400").alias("day")
    return candles(s, d).groupBy("api", *SERIES, day).agg(
        F.collect_list(one).alias("candles"), F.max("timestamp").alias("last_timestamp")
    )


def _flattened(s, d):
    path = scratch_path(s, "batches")
    rows = tables.flatten_batches(_batches(s, d)).select("api", *PK_COLS, *OHLCV, "last_timestamp")
    tables.insert_if_absent(rows, path)
    return s.read.schema(rows.schema).parquet(path)


add(
    "flatten_batch",
    lambda s, d: tidy(_flattened(s, d)),
    sql(
        f"""select api, {PK}, {OHLCV_SQL}, max("timestamp") over (partition by {K}, "timestamp" // 86400) as last_timestamp
        from candles""",
        PRICES,
    ),
)


def _created(s, d):
    """An empty table in the layout, then filled; one column dropped again."""
    path = scratch_path(s, "created")
    tables.create_table(s, path)
    tables.write_candles(candles(s, d), path)
    return tables.drop_column(scans.read_table(s, path), "api")


add(
    "create_tables",
    lambda s, d: tidy(_created(s, d).select(*PK_COLS, *OHLCV)),
    sql(f"select {PK}, {OHLCV_SQL} from candles", PRICES),
)


def _prediction_table(s, d):
    """The long table of all models' predictions, created empty, then filled twice over."""
    path = scratch_path(s, "predictions")
    tables.create_table(s, path, PREDICTION, PREDICTION_LAYOUT)
    p = base.predictions(s, d).select(
        "exchange", F.lit("trade").alias("model_type"), "trading_pair", "timestamp", "period",
        F.col("y_pred").cast("string").alias("prediction"),
    )
    both = p.unionByName(p.withColumn("model_type", F.lit("arbitrage")))
    for part in (both.where(F.col("timestamp") < STORED), both):
        tables.write_predictions(part, path, PREDICTION_KEY, PREDICTION_LAYOUT, "timestamp")
    return s.read.schema(PREDICTION).parquet(path).select(*PREDICTION.fieldNames())


add(
    "prediction_table",
    _prediction_table,
    sql(
        """select exchange, m as model_type, trading_pair, "timestamp", period, cast(y_pred as varchar) as prediction
        from predictions, (values ('trade'), ('arbitrage')) t(m)"""
    ),
)


def _snapshot(s, d):
    """Two exports in a row: the second goes to V2."""
    path = scratch_path(s, "snapshots")
    c = candles(s, d)
    tables.export_snapshot(c, path)
    latest = tables.export_snapshot(c, path)
    version = F.regexp_extract(F.lit(latest), r"V(\d+)$", 1).cast("int")
    return scans.read_table(s, latest).withColumn("version", version)


def _history(s, d):
    """The history of a second export that was made from the first one's."""
    path = scratch_path(s, "snapshots")
    tables.export_snapshot(candles(s, d), path)
    tables.export_snapshot(scans.read_table(s, tables.current_history(s, path)), path)
    return scans.read_table(s, tables.current_history(s, path))


add(
    "snapshot_history",
    lambda s, d: tidy(_history(s, d).select("api", *PK_COLS, *OHLCV)),
    sql(f"select api, {PK}, {OHLCV_SQL} from candles", PRICES),
)
add(
    "export_snapshot",
    lambda s, d: tidy(_snapshot(s, d).select("version", *PK_COLS, *OHLCV)),
    sql(
        f"""select 2 as version, {PK}, {OHLCV_SQL} from candles
        qualify row_number() over (partition by {K} order by "timestamp" desc) <= 500""",
        PRICES,
    ),
)


def _written(s, d):
    """Predictions written twice; the second run repeats the first one's times."""
    path = scratch_path(s, "predictions")
    p = base.predictions(s, d).select(
        F.col("timestamp").alias("p_time"), "exchange", "trading_pair", F.col("y_pred").cast("string").alias("prediction")
    )
    keys = ["p_time", "exchange", "trading_pair"]
    tables.write_predictions(p.where(F.col("p_time") < STORED), path, keys)
    tables.write_predictions(p, path, keys)
    return s.read.schema(p.schema).parquet(path)


add(
    "write_predictions",
    _written,
    sql('select "timestamp" as p_time, exchange, trading_pair, cast(y_pred as varchar) as prediction from predictions'),
)

