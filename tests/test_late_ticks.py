import random

import pytest
from pyspark.sql import functions as F

from tidewick.schema import OHLCV, PK
from tidewick.sinks.tables import names_in
from tidewick.sources.ticks import tick_candles
from tidewick.streaming import partials

TICKS = "exchange string, trading_pair string, micros long, seq long, price double, qty double"


@pytest.fixture
def ticks(spark):
    rng = random.Random(9)
    rows = [("a" if i % 3 else "b", "p", rng.randrange(20) * 150_000_000, i, float(rng.randrange(100)), 1.0) for i in range(600)]
    return spark.createDataFrame(rows, TICKS)


def rows(df):
    return sorted(tuple(r) for r in df.select(*PK, *OHLCV).collect())


def test_partials_merge_in_any_order(spark, ticks):
    want = rows(tick_candles(ticks, 300))
    parts = [partials.partial_candles(ticks.where(F.col("seq") % 5 == k), 300) for k in (3, 0, 4, 1, 2)]
    some = partials.merged(parts[0].unionByName(parts[1]))
    rest = partials.merged(partials.merged(parts[2].unionByName(parts[3])).unionByName(parts[4]))
    both = partials.merged(rest.unionByName(some))
    assert rows(both) == want and both.agg(F.sum("n")).first()[0] == 600
    assert rows(partials.merged(both)) == want


def test_late_ticks_correct_their_candles(spark, ticks, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "deltas", "checkpoint"))

    def land(part):
        part.coalesce(1).write.mode("append").parquet(landing)

    def run(source=landing):
        stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(source)
        partials.write_deltas(stream, 300, path, checkpoint)

    assert partials.stored(spark, path).count() == 0
    new, old = F.col("micros") >= 1_500_000_000, F.col("micros") < 1_500_000_000
    for k in range(4):
        land(ticks.where(new & (F.col("seq") % 4 == k)))
    run()
    before = rows(partials.candles(spark, path))
    assert before == rows(tick_candles(ticks.where(new), 300))
    for k in range(3):
        land(ticks.where(old & (F.col("seq") % 3 == k)))  # long behind every watermark
    run()
    want = rows(tick_candles(ticks, 300))
    assert rows(partials.candles(spark, path)) == want
    assert len(names_in(spark, path)) == 7
    assert partials.compact(spark, path, 3) == 2  # 7 deltas: twice three of one batch
    assert rows(partials.candles(spark, path)) == want
    assert rows(partials.candles(spark, path, since=1500)) == [r for r in want if r[3] >= 1500]
    assert partials.clean(spark, path) == 6 and rows(partials.candles(spark, path)) == want
    # a batch that is run again replaces its delta, one that broke is not read
    partials.partial_candles(ticks.where("false"), 300).write.parquet(f"{path}/000000007-000000007")
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/000000007-000000007/_SUCCESS")
    fs.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs, False)
    assert rows(partials.candles(spark, path)) == want
    run()  # nothing new
    assert rows(partials.candles(spark, path)) == want
