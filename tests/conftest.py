import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def make_candles(spark):
    """Candles of one or more series: {(exchange, pair): [(timestamp, close[, volume])]}, high = low = open = close."""

    def make(series, period=300):
        rows = [
            ("api", ex, tp, period, ts, float(c), float(c), float(c), float(c), float(v[0]) if v else 1.0)
            for (ex, tp), points in series.items()
            for ts, c, *v in points
        ]
        return spark.createDataFrame(
            rows,
            "api string, exchange string, trading_pair string, period int, timestamp long, "
            "open double, high double, low double, close double, volume double",
        )

    return make
