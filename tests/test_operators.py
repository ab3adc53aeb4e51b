"""Golden micro-frames: gaps, duplicates, ties, fees, runs, backtests, names, order statistics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewick.functions import scalar
from tidewick.operators import aggregate, arbitrage, backtest, chunks, clean, evaluate, gaps, joins, ordered, splits
from tidewick.operators.aggregate import exact_median, exact_quantiles
from tidewick.schema import PAIR

P = 300


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


GAP = {("a", "p"): [(0, 1.0), (300, 2.0, 5.0), (1200, 3.0)]}


@pytest.mark.parametrize("chunk", [2, 8192])
def test_gap_fill(make_candles, monkeypatch, chunk):
    monkeypatch.setattr(chunks, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(gaps, "CHUNK_ROWS", chunk)
    got = rows(gaps.gap_fill(make_candles(GAP)), "timestamp", "open", "close", "volume", "nan_ohlcv")
    assert got == [
        (0, 1.0, 1.0, 1.0, 0),
        (300, 2.0, 2.0, 5.0, 0),
        (600, 2.0, 2.0, 0.0, 1),
        (900, 2.0, 2.0, 0.0, 1),
        (1200, 3.0, 3.0, 1.0, 0),
    ]


def test_gap_reports(make_candles):
    c = make_candles(GAP)
    assert rows(gaps.missing_timesteps(c), "timestamp", "ntimestamp") == [(300, 1200)]
    assert rows(gaps.backfill_plan(c, 2), "n_pages", "start", "end") == [(2, 300, 900), (2, 900, 1200)]
    assert rows(gaps.bad_timestamps(c, 900), "timestamp") == [(0,)]


def test_single_row_series(make_candles):
    c = make_candles({("a", "p"): [(600, 4.0)]})
    assert rows(gaps.gap_fill(c), "timestamp", "nan_ohlcv") == [(600, 0)]
    assert gaps.missing_timesteps(c).count() == 0
    assert rows(ordered.close_diff(c), "close_diff") == [(None,)]


def test_imputation_takes_the_market_then_the_next_price(make_candles):
    c = make_candles({("a", "p"): [(0, 1.0, 9.0), (900, 4.0)], ("b", "p"): [(0, 3.0), (300, 5.0), (900, 6.0)]})
    got = rows(gaps.impute_candles(c).where("exchange = 'a'"), "timestamp", "close", "volume", "imputed")
    assert got == [(0, 1.0, 9.0, 0), (300, 5.0, 9.0, 1), (600, 4.0, 9.0, 1), (900, 4.0, 1.0, 0)]


def test_dedupe_keeps_one_row_per_key(make_candles):
    c = make_candles({("a", "p"): [(0, 2.0), (0, 1.0), (0, 1.0), (300, 5.0)]})
    assert rows(gaps.dedupe_candles(c, ["close"]), "timestamp", "close") == [(0, 1.0), (300, 5.0)]


def test_resample_through_an_intermediate_period(make_candles):
    rng = np.random.default_rng(0)
    c = make_candles({("a", "p"): [(300 * i, v, i % 5) for i, v in enumerate(rng.random(100).tolist())]})
    columns = ["timestamp", "open", "high", "low", "close", "volume"]
    direct = rows(aggregate.resample(c, 3600), *columns)
    assert direct == rows(aggregate.resample(aggregate.resample(c, 900), 3600), *columns)
    assert all(low <= o <= high and low <= cl <= high for _, o, high, low, cl, _ in direct)


def pair_frame(spark, closes, period=P):
    data = [("a", "b", "p", period, i * period, float(x) if x else None, float(y)) for i, (x, y) in enumerate(closes)]
    return spark.createDataFrame(
        data,
        "exchange_1 string, exchange_2 string, trading_pair string, period int, timestamp long, "
        "close_exchange_1 double, close_exchange_2 double",
    )


def test_states_ties_nulls_and_the_exact_fee(spark):
    d = arbitrage.with_state(pair_frame(spark, [(100, 100), (None, 5), (100.56, 100), (100, 100.56), (100.54, 100)]))
    got = rows(d, "timestamp", "higher_closing_price", "arbitrage_opportunity")
    assert got == [(0, 0, 0), (300, 0, 0), (600, 1, -1), (900, 2, 1), (1200, 1, 0)]
    assert rows(d.where("timestamp < 600"), "pct_higher") == [(0.0,), (0.0,)]
    exact = spark.range(1).select(scalar.arbitrage_state(F.lit(2.0), F.lit(1.0), 100.0)).first()[0]
    assert exact == -1


def states_frame(spark, states):
    data = [("a", "b", "p", P, i * P, s) for i, s in enumerate(states)]
    return spark.createDataFrame(
        data,
        "exchange_1 string, exchange_2 string, trading_pair string, period int, timestamp long, "
        "arbitrage_opportunity int",
    )


@pytest.mark.parametrize("chunk", [2, 8192])
@pytest.mark.parametrize("wrap", [False, True])
def test_window_length(spark, monkeypatch, chunk, wrap):
    monkeypatch.setattr(chunks, "CHUNK_ROWS", chunk)
    states = [0, 0, 1, 1, 1, 1, 1, 1, -1, 0]
    got = rows(arbitrage.window_length(states_frame(spark, states), wrap_first=wrap), "timestamp", "window_length")
    length, want = 5, []
    for i, s in enumerate(states):
        same = s == states[i - 1] if i or wrap else False
        length = length + 5 if same else 5
        want.append((i * P, length))
    assert got == want


@pytest.mark.parametrize("run,label", [(6, 1), (5, 0)])
def test_target_needs_the_whole_interval(spark, run, label):
    states = [0] * 8 + [1] * run + [0] * 9
    d = arbitrage.with_target(arbitrage.window_length(states_frame(spark, states)), 1800, P)
    got = dict(rows(d, "timestamp", "target"))
    assert len(got) == len(states) - 7
    assert got[(8 + run - 1 - 7) * P] == label
    assert sum(got.values()) == label


def predictions(spark, preds, diffs):
    data = [("a", "p", P, i * P, p, d) for i, (p, d) in enumerate(zip(preds, diffs))]
    return spark.createDataFrame(
        data, "exchange string, trading_pair string, period int, timestamp long, y_pred boolean, close_diff double"
    )


def test_backtest_against_the_loop(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 8)
    rng = np.random.default_rng(5)
    preds, diffs = (rng.random(50) < 0.5).tolist(), rng.normal(0, 0.01, 50).tolist()
    held = [0] + [int(p) for p in preds[:-1]]
    trig = [None, None] + [held[i] - held[i - 1] for i in range(2, 50)]
    gain = sum(h * d for h, d in zip(held, diffs))
    entries = sum(t == 1 for t in trig)
    df = predictions(spark, preds, diffs)
    got = backtest.backtest_summary(df).first()
    assert got["entries"] == entries
    assert got["net_profit"] == pytest.approx(gain * 10_000 - entries * 70)
    t = backtest.trade_triggers(df).orderBy("timestamp").collect()
    assert [r["trade_trig"] for r in t] == trig
    assert [r["preds_count"] for r in t] == np.cumsum(held).tolist()

    if held[1] == 1:
        trig[1] = 1
    side, money, curve = None, 0.0, []
    for i in range(50):
        side = trig[i] if trig[i] in (1, -1) else side
        flag = -1 if side is None or trig[i] is None else side + trig[i]
        money += (0 if flag in (-1, -2) else diffs[i]) - (0.0035 if flag in (2, -2) else 0)
        curve.append(money * 10_000 + 10_000)
    got = [r["my_money"] for r in backtest.equity_curve(df).orderBy("timestamp").collect()]
    assert got == pytest.approx(curve)


def test_validity_bounds_are_exclusive(make_candles):
    c = make_candles({("a", "p"): [(947362914, 1), (947362915, 1), (1894131875, 1), (1894131876, 1)]})
    ok, bad = clean.validate_candles(c)
    assert rows(ok, "timestamp") == [(947362915,), (1894131875,)]
    assert rows(bad, "timestamp") == [(947362914,), (1894131876,)]


@pytest.mark.parametrize(
    "name,want",
    [
        ("coinbase_pro_eth_usd", ("coinbase_pro", "eth_usd", None)),
        ("hitbtc_eth_btc", ("hitbtc", "eth_btc", None)),
        ("coinbase_pro_eth_usd_300", ("coinbase_pro", "eth_usd", 300)),
        ("hitbtc_eth_btc_3600", ("hitbtc", "eth_btc", 3600)),
    ],
)
def test_series_names(spark, name, want):
    got = spark.range(1).select(*[c.alias(k) for k, c in scalar.parse_series_name(F.lit(name)).items()]).first()
    assert tuple(got) == want


def test_pair_names(spark):
    parts = scalar.parse_pair_name(F.lit("bitfinex_coinbase_pro_ltc_usd"))
    got = spark.range(1).select(*[c.alias(k) for k, c in parts.items()]).first()
    assert tuple(got) == ("bitfinex", "coinbase_pro", "ltc_usd")


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_exact_order_statistics(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=n) ** 3, 1)  # skewed, with equal values
    x[: n // 3] = x[0]  # a third of the rows are one value
    df = spark.createDataFrame([("k", float(v)) for v in x], "k string, x double")
    assert exact_median(df, "x", ["k"]).first()["median"] == pytest.approx(np.median(x))
    q = exact_quantiles(df, "x", {"low": 0.05, "high": 0.95}, ["k"]).first()
    s = np.sort(x)
    assert (q["low"], q["high"]) == (s[max(0, int(np.ceil(0.05 * n)) - 1)], s[int(np.ceil(0.95 * n)) - 1])


def test_order_statistics_of_heavy_tails(spark):
    """Nearly all values lie in a sliver of the range, or are one value: brackets follow ranks, not values."""
    rng = np.random.default_rng(8)
    series = {
        "tail": np.exp(rng.normal(size=30_000) * 12), "equal": np.full(9_000, 7.5), "two": np.repeat([1.0, 1e300], [6_000, 6_001]),
        "step": np.concatenate([np.zeros(20_000), np.arange(50.0)]),
    }
    rows = spark.createDataFrame([(k, float(v)) for k, x in series.items() for v in x], "k string, x double").repartition(6)
    fractions = {"a": 0.0, "b": 0.001, "c": 0.05, "d": 0.5, "e": 0.95, "f": 0.9999, "g": 1.0}
    got = {r.k: r for r in exact_quantiles(rows, "x", fractions, ["k"]).collect()}
    middle = {r.k: r.median for r in exact_median(rows, "x", ["k"]).collect()}
    for k, x in series.items():
        s = np.sort(x)
        assert [got[k][c] for c in fractions] == [s[max(0, int(np.ceil(q * len(s))) - 1)] for q in fractions.values()]
        assert middle[k] == pytest.approx(np.median(x))


@pytest.mark.parametrize("how", [dict(history=5), dict(history=6, step=4, ahead=3), dict(history=3, single_step=7), dict(history=1, ahead=2)])
def test_windows_against_slices(make_candles, how):
    rng = np.random.default_rng(5)
    series = {(e, "p"): [(300 * int(i), float(v)) for i, v in zip(np.sort(rng.choice(400, n, replace=False)), rng.random(n))] for e, n in (("a", 150), ("b", 4))}
    c = make_candles(series).withColumn("label", (F.col("close") > 0.5).cast("int")).repartition(5)
    blocks = ordered.window_blocks(c, ["close", "volume"], "label", 5, 1)
    assert blocks.count() == 2 and blocks.agg(F.sum(F.octet_length("values"))).first()[0] == (150 + 4) * 3 * 8
    got = {(r.exchange, r.timestamp): (r.x, r.y) for r in ordered.supervised_windows(c, ["close", "volume"], "label", **how).collect()}
    want, history, step = {}, how["history"], how.get("step", 1)
    reach = how.get("single_step", how.get("ahead", 1))
    for (e, _), points in series.items():
        for i in range(history, len(points) - reach):
            ahead = [points[i + reach]] if "single_step" in how else points[i : i + reach]
            want[e, points[i][0]] = ([[v, 1.0] for _, v in points[i - history : i : step]], [int(v > 0.5) for _, v in ahead])
    assert got == want


def test_scorecard_classes(spark):
    d = spark.createDataFrame(
        [("m", -1, -1, 5), ("m", 0, -1, 5), ("m", 0, 0, 8), ("m", 1, 0, 2), ("z", 0, 0, 9), ("h", 1, 1, 3), ("h", 0, 0, 1)],
        "model_name string, actual int, predicted int, n long",
    )
    got = {r["model_name"]: r for r in evaluate.model_scorecard(d).collect()}
    m = got["m"]
    assert (m["correct_arb"], m["pct_wrong_neg1"], m["pct_wrong_0"], m["pct_wrong_1"]) == (5, 0.5, pytest.approx(0.2), None)
    assert [got["z"][c] for c in ("correct_arb", "pct_wrong_0", "pct_wrong_neg1", "correct_arb_0")] == [0, 0, 0, 0]
    assert (got["h"]["correct_arb_1"], got["h"]["pct_wrong_1"], got["h"]["pct_wrong_neg1"]) == (3, 0, None)


def test_embargo_split_uses_half_even_rounding(make_candles):
    day = 86_400
    c = make_candles({("a", "p"): [(day * i, 1) for i in range(15)]}, period=day)  # 0.7 * 15 = 10.5 -> 10
    got = splits.embargo_split(c, embargo=day)
    assert {r["split_ts"] for r in got.collect()} == {10 * day}
    assert rows(got.where("part = 'train'").agg(F.max("timestamp").alias("t")), "t") == [(8 * day,)]
    assert rows(got.where("part = 'test'").agg(F.min("timestamp").alias("t")), "t") == [(12 * day,)]


def test_cross_exchange_join_pairs_each_exchange_once(make_candles):
    c = make_candles({(e, "p"): [(0, i), (300, i)] for i, e in enumerate("abc")})
    got = joins.cross_exchange_join(c, ["close"])
    assert rows(got.where("timestamp = 0"), "exchange_1", "exchange_2") == [("a", "b"), ("a", "c"), ("b", "c")]
    assert got.columns[: len(PAIR)] == PAIR
