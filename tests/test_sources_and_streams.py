"""Payloads, files, writers and the stateful stream."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import compare, connect
from tidewick.plans import models
from tidewick.sinks import tables
from tidewick.sources import payloads, universe
from tidewick.streaming import jobs

PAYLOADS = {
    "cryptowatch": '{"result":{"300":[[1546300800,1,4,0.5,2,9,3]]}}',
    "coincap": '{"data":[{"open":"1","high":"4","low":"0.5","close":"2","volume":"9","period":1546300800123}]}',
    "hitbtc": '[{"timestamp":"2019-01-01T00:00:00.000Z","open":"1","max":"4","min":"0.5","close":"2","volume":"9"}]',
    "bitfinex": "[[1546300800000,1,2,4,0.5,9]]",
    "coinbase": "[[1546300800,0.5,4,1,2,9]]",
    "poloniex": '[{"date":1546300800,"open":1,"high":4,"low":0.5,"close":2,"volume":9}]',
}


@pytest.mark.parametrize("api", PAYLOADS)
def test_vendor_payload(spark, api):
    landed = spark.createDataFrame(
        [(api, "x", "eth_btc", 300, PAYLOADS[api])],
        "api string, exchange string, trading_pair string, period int, payload string",
    )
    ok, bad = payloads.normalize_candles(payloads.unwrap_payloads(landed))
    got = [tuple(r) for r in ok.select("timestamp", "open", "high", "low", "close", "volume").collect()]
    assert got == [(1546300800, 1.0, 4.0, 0.5, 2.0, 9.0)]
    assert bad.count() == 0


def test_broken_candles_are_rejected_not_lost(spark):
    landed = spark.createDataFrame(
        [("poloniex", "x", "eth_btc", 300, '[{"date":0,"open":1},{"date":"soon","open":1,"high":1,"low":1,"close":1,"volume":1}]')],
        "api string, exchange string, trading_pair string, period int, payload string",
    )
    ok, bad = payloads.normalize_candles(payloads.unwrap_payloads(landed))
    assert (ok.count(), bad.count()) == (0, 2)


def test_vendor_symbols(spark):
    config = universe.vendor_config(spark)
    pairs = universe.series_universe(config, include_disabled=True).select("api", "trading_pair").distinct()
    got = {(r["api"], r["trading_pair"]): r["symbol"] for r in universe.vendor_symbols(pairs, config).collect()}
    assert got["bitfinex", "bch_btc"] == "BABBTC"
    assert got["coinbase", "eth_btc"] == "ETH-BTC"
    assert got["poloniex", "eth_btc"] == "BTC_ETH"
    assert got["cryptowatch", "link_eth"] == "linketh"
    assert universe.series_universe(config).where("api = 'coinbase'").count() == 0


def test_insert_if_absent_is_idempotent(make_candles, spark, tmp_path):
    path = str(tmp_path / "candles")
    a = make_candles({("a", "p"): [(0, 1.0), (300, 2.0)]})
    b = make_candles({("a", "p"): [(300, 9.0), (600, 3.0), (600, 4.0)]})
    for batch in (a, b, b):
        tables.insert_if_absent(batch, path)
    got = sorted((r["timestamp"], r["close"]) for r in spark.read.parquet(path).collect())
    assert got == [(0, 1.0), (300, 2.0), (600, 3.0)]


def test_snapshot_versions_count_up(make_candles, spark, tmp_path):
    c = make_candles({("a", "p"): [(300 * i, i) for i in range(10)]})
    first, second = (tables.export_snapshot(c, str(tmp_path), 4) for _ in range(2))
    assert (os.path.basename(first), os.path.basename(second)) == ("V1", "V2")
    assert sorted(r["timestamp"] for r in spark.read.parquet(second).collect()) == [1800, 2100, 2400, 2700]


class FakeState:
    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def test_run_length_state_survives_batches():
    state, key = FakeState(), ("a", "b", "p", 300)
    states = [0, 0, 1, 1, 1, 0]
    frame = pd.DataFrame(
        {
            "exchange_1": "a",
            "exchange_2": "b",
            "trading_pair": "p",
            "period": 300,
            "timestamp": [300 * i for i in range(6)],
            "arbitrage_opportunity": states,
        }
    )
    out = [b for part in (frame[:3][::-1], frame[2:4], frame[4:]) for b in jobs._extend_runs(key, iter([part]), state)]
    got = pd.concat(out)
    assert got[got["late"]]["timestamp"].tolist() == [600]
    got = got[~got["late"]]
    assert got["timestamp"].tolist() == frame["timestamp"].tolist()
    assert got["window_length"].tolist() == [5, 10, 5, 10, 15, 5]


class TimedState(FakeState):
    watermark, timer = 0, None

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.watermark * 1000 - jobs.SLACK_MS

    def setTimeoutTimestamp(self, at):  # noqa: N802
        assert at > self.getCurrentWatermarkMs()
        self.timer = at


@pytest.mark.parametrize("seed", range(5))
def test_disordered_rows_leave_in_order(seed):
    """Rows shuffled within the delay give the lengths of ordered ones; a row behind those that left is late."""
    rng = random.Random(seed)
    key, start, delay = ("a", "b", "p", 300), 1_700_000_100, 3000
    rows = [(start + 300 * i, rng.choice([0, 1])) for i in range(60)]
    frame = lambda part: pd.DataFrame(
        [(*key, t, v) for t, v in part], columns=["exchange_1", "exchange_2", "trading_pair", "period", "timestamp", "arbitrage_opportunity"])
    want = pd.concat(jobs._extend_runs(key, iter([frame(rows)]), FakeState()))
    state, out, newest = TimedState(), [], 0
    mixed = sorted(rows, key=lambda r: r[0] + rng.randrange(delay))
    for at in range(0, 60, 7):
        state.watermark = newest  # as Spark has it: the newest row of the batches before
        out += jobs._reorder(key, iter([frame(mixed[at : at + 7])]), state, delay * 1000)
        newest = max([newest, *[t for t, _ in mixed[at : at + 7]]])
    assert state.timer is not None
    state.watermark = newest + delay
    out += jobs._reorder(key, iter([]), state, delay * 1000)  # a timer
    got = pd.concat(out)
    assert not got["late"].any() and got["timestamp"].tolist() == want["timestamp"].tolist()
    assert got["window_length"].tolist() == want["window_length"].tolist()
    late = pd.concat(jobs._reorder(key, iter([frame(rows[5:6])]), state, delay * 1000))
    assert late["late"].tolist() == [True] and late["window_length"].isna().all()


def test_parameter_tables():
    assert len(models.param_grid(models.ARB_GRID)) == 6 * 7 * 2
    draws = models.random_params(50, {"maxDepth": range(3, 9)})
    assert draws == models.random_params(50, {"maxDepth": range(3, 9)}) and len(draws) == 50


QUICK = [
    "candles_from_events", "resample_ohlcv", "gap_fill", "arb_info", "cross_exchange_join", "backfill_plan",
    "arb_window_length", "trade_triggers", "embargo_split", "signed_log_zscore", "classification_report", "stream_candles",
]


@pytest.mark.parametrize("key", QUICK)
def test_registered_query_equals_its_oracle(spark, key):
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test tables")
    assert compare(entry.queries()[key](spark, sf), connect(sf), entry.oracle_sql()[key]) == ""


def test_ui_stays_off(spark):
    assert spark.conf.get("spark.ui.enabled") == "false"
    assert spark.range(1).select(F.lit(1)).count() == 1
