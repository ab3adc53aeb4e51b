"""The chunked pieces against brute force, with chunks far smaller than the series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewick.functions import indicators
from tidewick.operators import chunks, ordered, scan
from tidewick.schema import SERIES

ROWS = 4


@pytest.fixture(scope="module")
def frame(spark):
    """Two irregular series, one of 60 rows over many chunks (some empty), one of a single row."""
    rng = np.random.default_rng(1)
    ts = np.sort(rng.choice(np.arange(1000, 1600), 60, replace=False)) * 300
    x = [None if rng.random() < 0.3 else float(v) for v in rng.integers(0, 50, 60)]
    rows = [("a", "p", 300, int(t), v) for t, v in zip(ts, x)] + [("b", "p", 300, 300_000, 7.0)]
    df = spark.createDataFrame(rows, "exchange string, trading_pair string, period int, timestamp long, x double")
    pdf = pd.DataFrame(rows, columns=[*SERIES, "timestamp", "x"]).sort_values(["exchange", "timestamp"])
    return df, pdf


def collected(df):
    return df.toPandas().sort_values(["exchange", "timestamp"]).reset_index(drop=True)


def same(got, want):
    np.testing.assert_allclose(
        got.astype(float).to_numpy(), want.astype(float).reset_index(drop=True).to_numpy(), equal_nan=True
    )


@pytest.mark.parametrize("offset", [-1, 1])
def test_neighbour(frame, offset):
    df, pdf = frame
    got = collected(chunks.neighbour(df, {"y": "x", "t": "timestamp"}, offset, rows=ROWS))
    groups = pdf.groupby("exchange")
    same(got["y"], groups["x"].shift(-offset))
    same(got["t"], groups["timestamp"].shift(-offset))


@pytest.mark.parametrize("reverse", [False, True])
def test_running(frame, reverse):
    df, pdf = frame
    got = collected(
        chunks.running(
            df,
            {"s": ("sum", "x"), "l": ("last", "x"), "f": ("first", "x"), "m": ("max", "x")},
            reverse=reverse,
            rows=ROWS,
        )
    )
    d = pdf[::-1] if reverse else pdf
    g = d.groupby("exchange")["x"]
    seen = g.transform(lambda s: s.notna().cumsum()) > 0
    want = pd.DataFrame(
        {
            "s": g.transform(lambda s: s.fillna(0).cumsum()).where(seen),
            "l": g.ffill(),
            "m": g.transform(lambda s: s.cummax().ffill()),
            "f": g.transform(lambda s: s[s.first_valid_index()]).where(seen),
        }
    ).sort_index()
    order = pdf.index
    for c in ("s", "l", "m", "f"):
        same(got[c], want.loc[order, c])


def test_row_positions_and_edges(frame):
    df, pdf = frame
    got = collected(chunks.row_positions(df, rows=ROWS))
    same(got["pos"], pdf.groupby("exchange").cumcount())
    same(got["n_rows"], pdf.groupby("exchange")["x"].transform("size"))
    for newest in (True, False):
        kept = collected(chunks.edge_rows(df, 7, newest=newest, rows=ROWS).drop("rank"))
        want = pdf.groupby("exchange").tail(7) if newest else pdf.groupby("exchange").head(7)
        same(kept["timestamp"], want["timestamp"])


def test_halo_frames(frame):
    df, pdf = frame
    d = chunks.with_halo(chunks.row_positions(df, rows=ROWS), 3, 2, F.col("pos"), rows=ROWS)
    w = chunks.halo_window()
    d = d.withColumns({"s": F.sum("x").over(w.rowsBetween(-3, 2)), "lag3": F.lag("x", 3).over(w)})
    got = collected(chunks.drop_halo(d))
    g = pdf.groupby("exchange")["x"]
    want = sum(g.shift(k).fillna(0) for k in range(-2, 4))
    same(got["s"].fillna(0), want)
    same(got["lag3"], g.shift(3))


def test_frames_longer_than_a_chunk_widen_it(frame):
    df, pdf = frame
    d = chunks.with_halo(chunks.row_positions(df), back=5, pos=F.col("pos"), rows=ROWS)
    total = F.sum("x").over(chunks.halo_window().rowsBetween(-5, 0))
    got = collected(chunks.drop_halo(d.withColumn("s", total)))
    want = pdf.sort_values([*SERIES, "timestamp"]).groupby(SERIES)["x"].rolling(6, min_periods=1).sum()
    np.testing.assert_allclose(got["s"].to_numpy(float), want.to_numpy(float))


def test_attach_keeps_every_row(frame):
    df, pdf = frame
    means = df.groupBy(*SERIES).agg(F.avg("x").alias("m"))
    got = collected(chunks.attach(df, means))
    same(got["m"], pdf.groupby("exchange")["x"].transform("mean"))


@pytest.fixture(scope="module")
def long_series(spark):
    rng = np.random.default_rng(2)
    x = 100 + np.cumsum(rng.normal(size=5000))
    rows = [("a", "p", 300, 300 * (1000 + i), float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "exchange string, trading_pair string, period int, timestamp long, x double"), x


@pytest.mark.parametrize("alpha", [2 / 13, 2 / 27, 1 / 14, 2 / 3])
def test_ema_equals_the_recurrence(long_series, alpha):
    df, x = long_series
    d = chunks.with_halo(df, back=1024, rows=1024).withColumn("_first", scan.is_first())
    got = collected(chunks.drop_halo(scan.ema(d, {"y": ("x", alpha)})))["y"]
    want = pd.Series(x).ewm(alpha=alpha, adjust=False).mean()
    assert np.abs(got - want).max() < 1e-9


def test_nested_ema(long_series):
    df, x = long_series
    d = chunks.with_halo(df, back=1024, rows=1024).withColumn("_first", scan.is_first())
    for src, new in (("x", "a"), ("a", "b"), ("b", "c")):
        d = scan.ema(d, {new: (src, scan.span(15))})
    got = collected(chunks.drop_halo(d))["c"]
    want = pd.Series(x)
    for _ in range(3):
        want = want.ewm(span=15, adjust=False).mean()
    assert np.abs(got - want).max() < 1e-9


def test_denoise_equals_the_loop(long_series, monkeypatch):
    df, x = long_series
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 1024)
    got = collected(ordered.denoise(df, "x", 3))["denoised"]
    y = x.copy()
    for _ in range(3):
        for i in range(1, len(y) - 1):
            y[i] = (y[i - 1] + y[i + 1]) / 2
    assert np.abs(got - y).max() < 1e-9


def test_indicators_do_not_depend_on_the_chunk_length(spark, monkeypatch):
    rng = np.random.default_rng(3)
    close = 100 + np.cumsum(rng.normal(size=2600))
    rows = [
        ("a", "p", 300, 300 * (500 + i), c - 0.1, c + rng.random(), c - rng.random(), c, float(rng.integers(0, 9)))
        for i, c in enumerate(close.tolist())
    ]
    df = spark.createDataFrame(
        [tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows],
        "exchange string, trading_pair string, period int, timestamp long, "
        "open double, high double, low double, close double, volume double",
    )
    whole = collected(indicators.add_indicators(df))
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 1024)
    split = collected(indicators.add_indicators(df))
    assert list(whole.columns[9:]) == indicators.ALL and len(indicators.ALL) == 58
    np.testing.assert_allclose(
        split[indicators.ALL].to_numpy(float), whole[indicators.ALL].to_numpy(float), rtol=1e-7, atol=1e-7
    )
