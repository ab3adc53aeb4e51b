"""Mixed periods, damaged input, pruned inserts, versions, saved models and many-model scoring."""

import pandas as pd
from pyspark.sql import functions as F

from tidewick.operators import aggregate, evaluate, gaps, ordered
from tidewick.plans import features
from tidewick.schema import PREDICTION, PREDICTION_KEY, PREDICTION_LAYOUT
from tidewick.sinks import tables
from tidewick.sources import candles, payloads
from tidewick.streaming import jobs

HOUR = 3600
LANDED = "api string, exchange string, trading_pair string, period int, payload string"


def test_resample_takes_the_finest_period_only(make_candles):
    fine = make_candles({("a", "p"): [(300 * i, 1.0 + i) for i in range(12)]}, 300)
    whole = make_candles({("a", "p"): [(0, 50.0), (HOUR, 60.0)], ("b", "p"): [(0, 7.0)]}, HOUR)
    day = make_candles({("a", "p"): [(0, 99.0)]}, 86_400)
    got = aggregate.resample(fine.unionByName(whole).unionByName(day), HOUR).collect()
    values = {(r.exchange, r.timestamp): (r.open, r.close, r.volume) for r in got}
    assert values == {("a", 0): (1.0, 12.0, 12.0), ("a", HOUR): (60.0, 60.0, 1.0), ("b", 0): (7.0, 7.0, 1.0)}
    one = aggregate.resample(fine.unionByName(whole), 2 * HOUR, source=HOUR).collect()
    assert {(r.exchange, r.close, r.volume) for r in one} == {("a", 60.0, 2.0), ("b", 7.0, 1.0)}


def test_a_value_beats_a_null_among_copies(make_candles):
    c = make_candles({("a", "p"): [(0, 5.0), (300, 2.0)]})
    broken = c.withColumn("close", F.lit(None).cast("double"))
    got = {r.timestamp: r.close for r in gaps.dedupe_candles(broken.unionByName(c), ["close"]).collect()}
    assert got == {0: 5.0, 300: 2.0}


def test_scans_are_not_capped(spark, make_candles):
    c = make_candles({("a", "p"): [(300 * i, 1.0) for i in range(60_000)]})
    assert candles.scan_candles(c).count() == 60_000 and candles.chart_series(c).count() == 60_000
    assert [r.timestamp for r in candles.scan_candles(c, n=3).collect()] == [0, 300, 600]


def test_unreadable_and_unknown_responses_are_rejected(spark):
    good = '[{"date":1546300800,"open":1,"high":4,"low":0.5,"close":2,"volume":9}]'
    landed = spark.createDataFrame(
        [("poloniex", "x", "p", 300, good), ("poloniex", "x", "p", 300, "<html>"), ("nobody", "x", "p", 300, good),
         ("poloniex", "x", "p", 300, "[]"), ("poloniex", "x", "p", 300, None)],
        LANDED,
    )
    ok, bad = payloads.normalize_candles(payloads.unwrap_payloads(landed))
    assert (ok.count(), bad.count()) == (1, 3)


def test_the_newest_page_wins(spark):
    page = '[{"date":1546300800,"open":1,"high":4,"low":0.5,"close":%s,"volume":9}]'
    rows = [("poloniex", "x", "p", 300, page % v, at) for v, at in ((2, 1), (3, 3), (9, 2))]
    landed = spark.createDataFrame(rows, LANDED + ", landed_at int")
    assert [r.close for r in payloads.vendor_candles(landed, "landed_at").collect()] == [3.0]
    assert [r.close for r in payloads.vendor_candles(landed.drop("landed_at")).collect()] == [2.0]


def test_open_candles_return_and_rejects_are_kept(spark, tmp_path):
    path, landing = str(tmp_path / "table"), str(tmp_path / "landing")
    page = '[{"date":1546300800,"open":1,"high":4,"low":0.5,"close":2,"volume":9}]'
    for rows, now in (([("poloniex", "x", "p", 300, page), ("poloniex", "x", "p", 300, "?")], 1546300900),
                      ([("poloniex", "x", "q", 300, "?")], 1546301100)):
        df = spark.createDataFrame(rows, LANDED)
        df.write.mode("append").json(landing)
        jobs.ingest(spark, landing, df.schema, path, str(tmp_path / "checkpoint"), now)
    assert [(r.trading_pair, r.close) for r in spark.read.parquet(path).collect()] == [("p", 2.0)]
    schema = df.select("api", "exchange", "trading_pair").schema
    assert sorted(r.trading_pair for r in jobs.rejected_candles(spark, path, schema).collect()) == ["p", "q"]


def test_insert_reads_only_what_the_batch_touches(spark, make_candles, tmp_path):
    path = str(tmp_path / "candles")
    old = make_candles({("a", "p"): [(300 * i, 1.0) for i in range(20)], ("b", "p"): [(0, 1.0)]})
    tables.write_candles(old, path)
    new = make_candles({("a", "p"): [(300 * 18, 9.0), (300 * 25, 2.0)]})
    stored = spark.read.schema(old.schema).parquet(path)
    near = tables.touched(stored, new, tables.LAYOUT, "timestamp")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "exchange" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {(r.exchange, r.timestamp) for r in near.collect()} == {("a", 5400), ("a", 5700)}
    tables.insert_if_absent(new, path)
    got = {(r.exchange, r.timestamp): r.close for r in spark.read.schema(old.schema).parquet(path).collect()}
    assert len(got) == 22 and got["a", 5400] == 1.0 and got["a", 7500] == 2.0


def test_writers_spread_by_pair_and_sort(spark, make_candles, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    c = make_candles({("a", f"p{k}"): [(300 * i, 1.0) for i in range(50)] for k in range(4)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = tables._spread(c, tables.LAYOUT).withColumn("part", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert frame["part"].nunique() > 1
    for _, rows in frame.groupby("part"):
        assert rows[["trading_pair", "timestamp"]].apply(tuple, axis=1).is_monotonic_increasing


def test_prediction_table_and_snapshots(spark, make_candles, tmp_path):
    path = str(tmp_path / "predictions")
    assert tables.create_table(spark, path, PREDICTION, PREDICTION_LAYOUT).count() == 0
    p = spark.createDataFrame([("a", "trade", "p", 0, 300, "buy"), ("a", "arb", "p", 0, 300, "sell")], PREDICTION)
    for _ in range(2):
        tables.write_predictions(p, path, PREDICTION_KEY, PREDICTION_LAYOUT, "timestamp")
    assert spark.read.schema(PREDICTION).parquet(path).count() == 2
    base = str(tmp_path / "snapshots")
    tables.export_snapshot(make_candles({("a", "p"): [(0, 1.0), (300, 2.0)]}), base, 1)
    first = tables.current_history(spark, base)
    tables.export_snapshot(spark.read.parquet(first), base, 1)
    assert tables.current_history(spark, base) != first
    assert spark.read.parquet(tables.current_history(spark, base)).count() == 2


def test_long_windows_widen_the_chunk(make_candles):
    c = make_candles({("a", "p"): [(300 * i, float(i)) for i in range(9000)]})
    got = ordered.supervised_windows(c, ["close"], "close", history=8640, gap_free=True)
    assert got.count() == 9000 - 8640 - 1 or got.count() == 9000 - 8640


def test_alerts_are_cut_after_the_filter(spark):
    now = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    rows = [(f"e{i}", "f", "p", "arb" if i % 2 else "no_arbitrage") for i in range(1200)]
    p = spark.createDataFrame(rows, "exchange_1 string, exchange_2 string, trading_pair string, prediction string")
    p = p.withColumn("p_time", F.lit("2024-01-01 00:59:00").cast("timestamp_ntz"))
    assert jobs.recent_alerts(p, now).count() == 600 and jobs.recent_alerts(p, now, newest=10).count() == 10


def test_late_states_come_out_marked():
    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    key, state = ("a", "b", "p", 300), State()
    frame = pd.DataFrame({"exchange_1": "a", "exchange_2": "b", "trading_pair": "p", "period": 300,
                          "timestamp": [0, 300, 600, 300], "arbitrage_opportunity": [1, 1, 0, 1]})
    out = pd.concat([b for part in (frame[:3], frame[3:]) for b in jobs._extend_runs(key, iter([part]), state)])
    assert out["late"].tolist() == [False, False, False, True]
    assert out["window_length"].tolist()[:3] == [5, 10, 5] and pd.isna(out["window_length"].iloc[3])


def test_models_are_selected_by_thresholds(spark):
    rows = [("s", "m1", 0.1, 30, 0.5), ("s", "m2", 0.4, 90, 0.5), ("s", "m3", 0.1, 40, 0.3), ("t", "m4", 0.1, 20, 0.9)]
    df = spark.createDataFrame(rows, "ex_tp string, model_name string, pct_wrong_0 double, correct_arb long, pct_profit_mean double")
    assert [r.model_name for r in evaluate.select_models(df, ["model_name"]).collect()] == ["m3"]


def test_latest_data_begins_n_periods_before_now(monkeypatch):
    monkeypatch.setattr(features, "get_data", lambda *a, **k: (a, k))
    assert features.get_latest_data("candles", 300, 900_000, n=100) == (("candles", 300, 870_000), {"families": None})
