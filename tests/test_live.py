"""Live indicator state against the batch indicators, however rows are cut into micro-batches."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewick.functions import indicators
from tidewick.operators.gaps import gap_fill
from tidewick.operators.ordered import close_diff
from tidewick.plans.queries_technical import OTHER_WINDOWS
from tidewick.schema import OHLCV, PK
from tidewick.streaming import jobs, live

PERIOD, START = 300, 1_700_000_100
KEY = ("a", "p", PERIOD)
NAMES = [*indicators.ALL, "close_diff"]


class Store:
    """A group's state, as Spark would keep it between micro-batches."""

    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def market(rows, seed=1):
    """Candles with gaps, a flat stretch, candles without volume and repeated extremes."""
    rng = random.Random(seed)
    found, price, at = [], 100.0, START
    for i in range(rows):
        price = price if 60 < i < 110 else max(1.0, price + rng.choice([-1, -0.5, 0, 0.5, 1]))
        spread = 0.0 if 60 < i < 110 else rng.choice([0.0, 0.25, 0.5])
        volume = 0.0 if 80 < i < 130 else rng.choice([0.0, 1.0, 2.5])
        found.append((at, price, price + spread, price - spread, price + rng.choice([-1, 0, 1]) * spread, volume))
        at += PERIOD * (rng.choice([2, 5, 40]) if rng.random() < 0.05 else 1)
    return pd.DataFrame(found, columns=["timestamp", *OHLCV]).assign(exchange="a", trading_pair="p", period=PERIOD)


def fed(rows, cuts, windows=indicators.DEFAULT, filled=False, store=None):
    store = store or Store()
    edges = [0, *cuts, len(rows)]
    out = [x for a, b in zip(edges, edges[1:], strict=False) if a < b
           for x in live._advance(KEY, iter([rows[a:b].sample(frac=1, random_state=a)]), store, windows, filled)]
    return pd.concat(out, ignore_index=True)


def assert_same(got, want, names=NAMES, tolerance=1e-7):
    for name in names:
        a, b = got[name].to_numpy("float64"), want[name].to_numpy("float64")
        assert (np.isnan(a) == np.isnan(b)).all(), name
        np.testing.assert_allclose(a, b, rtol=tolerance, atol=tolerance, err_msg=name)


@pytest.mark.parametrize("windows", [indicators.DEFAULT, OTHER_WINDOWS], ids=["default", "other"])
def test_state_gives_the_batch_indicators(spark, windows):
    rows = market(400)
    batch = gap_fill(spark.createDataFrame(rows.astype({"period": "int32"})))
    want = close_diff(indicators.add_indicators(batch, windows=windows), gap_free=True).orderBy("timestamp").toPandas()
    got = fed(rows, [1, 2, 3, 40, 41, 100, 101, 150, 220, 221, 300, 399], windows)
    assert (got["status"] == "ok").all()
    for name in ("timestamp", "nan_ohlcv", *OHLCV):
        assert got[name].tolist() == want[name].tolist(), name
    assert_same(got, want)


@pytest.mark.parametrize("seed", range(3))
def test_cuts_do_not_matter(seed, monkeypatch):
    """One batch, one row a batch and stretches shorter than any window agree; the state stays as small."""
    rows = market(260, seed)
    whole, store = fed(rows, []), Store()
    assert_same(fed(rows, range(1, 260), store=store), whole, tolerance=1e-11)
    assert len(store.get[5]) == 5 * indicators.rolling_rows(indicators.DEFAULT)
    monkeypatch.setattr(live, "STRETCH", 7)
    assert_same(fed(rows, [100]), whole, tolerance=1e-11)


def test_outage_longer_than_a_stretch(monkeypatch):
    monkeypatch.setattr(live, "STRETCH", 16)
    rows = market(20)
    rows.loc[10:, "timestamp"] += 100 * PERIOD
    for cuts in ([], [10], [10, 11]):
        got = fed(rows, cuts)
        assert got["timestamp"].diff().dropna().eq(PERIOD).all()
        gap = got[got["nan_ohlcv"] == 1]
        assert len(gap) >= 100 and (gap["volume"] == 0).all() and (gap["open"] == gap["close"]).all()


def test_late_repeated_and_invalid_rows():
    rows = market(30)
    store = Store()
    first = fed(rows[:20], [], store=store)
    bad = rows[20:22].copy()
    bad["close"], bad["volume"] = [math.inf, 1.0], [1.0, None]
    late = pd.concat([rows[3:5], rows[20:], rows[25:26], bad, rows[22:23].assign(timestamp=None)])
    second = fed(late, [], store=store)
    aside = second[second["status"] != "ok"]
    assert aside["status"].value_counts().to_dict() == {"late": 3, "invalid": 3}
    assert aside[NAMES].isna().all(axis=None)
    assert_same(pd.concat([first, second[second["status"] == "ok"]]), fed(rows, []), tolerance=1e-11)
    before = store.get
    assert (fed(rows[:5], [], store=store)["status"] == "late").all() and store.get is before


def test_no_period(spark, tmp_path):
    """Rows without a period, or without any key, come out invalid and keep no state; an empty table gives no rows."""
    rows = spark.createDataFrame(market(3).astype({"period": "int32"}))
    odd = rows.withColumn("period", F.lit(None).cast("int")).unionByName(rows.withColumn("period", F.lit(0)))
    odd = odd.unionByName(rows.withColumn("period", F.lit(-5)).withColumns({c: F.lit(None).cast("string") for c in ("exchange", "trading_pair")}))
    for name, table, want in (("odd", odd.unionByName(rows), {"invalid": 9, "ok": 3}), ("empty", rows.limit(0), {})):
        source, out, checkpoint = (str(tmp_path / name / x) for x in ("source", "out", "checkpoint"))
        table.write.parquet(source)
        got = jobs.run_to_files(live.live_indicators(spark.readStream.schema(table.schema).parquet(source)), out, checkpoint)
        assert dict(got.groupBy("status").count().collect()).items() >= want.items()


def test_filled_takes_the_mean_so_far():
    rows = market(200)
    raw = fed(rows, [50, 120])
    got = fed(rows, [3, 50, 51, 120], filled=True)
    want = raw.copy()
    for name in indicators.ALL:
        x = raw[name].replace([np.inf, -np.inf], np.nan)
        usable = x.isna().expanding().mean() < 0.2
        want[name] = x.fillna(x.expanding().mean()).where(usable)
    assert_same(got, want, tolerance=1e-9)


def test_stream_resumes_and_ignores_more_columns(spark, tmp_path):
    """Ten files of two series, one a batch, the second half after a restart; the newest rows of each batch are handed on."""
    rows = pd.concat([market(120, 1), market(120, 2).assign(trading_pair="q")])
    source, out, checkpoint = (str(tmp_path / x) for x in ("source", "out", "checkpoint"))
    table = spark.createDataFrame(rows.astype({"period": "int32"})).withColumn("status", F.lit("x"))
    part = F.floor((F.col("timestamp") - START) / (30 * PERIOD))
    parts = sorted(r[0] for r in table.select(part).distinct().collect())
    assert len(parts) > 4
    for half in (parts[: len(parts) // 2], parts[len(parts) // 2 :]):
        for k in half:
            table.where(part == k).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
        live.score_stream(
            live.live_indicators(stream), lambda d, n: d.write.mode("overwrite").parquet(f"{out}/batch={n}"), checkpoint)
    got = spark.read.parquet(out).toPandas().sort_values([*PK])
    assert got["batch"].nunique() == len(parts)
    for pair, own in got.groupby("trading_pair"):
        whole = fed(rows[rows["trading_pair"] == pair], []).set_index("timestamp")
        assert_same(own, whole.loc[own["timestamp"]], tolerance=1e-9)
        assert own["timestamp"].max() == whole.index.max()
