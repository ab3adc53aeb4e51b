"""Aggregations over candles."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewick.schema import OHLCV, SERIES
from tidewick.session import join_small, materialise


def resample(df: DataFrame, period: int, source: int | None = None) -> DataFrame:
    """Candles of a longer (or the same) period, left-closed and left-labelled.

    A table may hold several periods side by side; each bucket is made of the finest one that it has and
    that divides ``period`` (or of ``source`` only), never of several.
    Buckets without candles yield no row; :func:`tidewick.operators.gaps.gap_fill` adds them.
    """
    fits = F.col("period") == source if source else F.lit(period) % F.col("period") == 0
    d = df.where(fits).select(
        "exchange",
        "trading_pair",
        F.col("period").alias("_source"),
        F.expr(f"(timestamp div {period}) * {period}L").alias("_bucket"),
        "timestamp",
        "open",
        "high",
        "low",
        "close",
        "volume",
    )
    bucket = ["exchange", "trading_pair", "_bucket"]
    out = d.groupBy(*bucket, "_source").agg(
        F.min_by("open", "timestamp").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "timestamp").alias("close"),
        F.sum("volume").alias("volume"),
    )
    if not source:
        # fixed-width buffers, so that this stays a hash aggregation over few rows
        out = out.groupBy(*bucket).agg(*[F.min_by(c, "_source").alias(c) for c in OHLCV])
    return out.select(
        "exchange", "trading_pair", F.lit(period).alias("period"), F.col("_bucket").alias("timestamp"), *OHLCV
    )


def series_bounds(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))


def coverage_check(df: DataFrame, minimum: int = 100) -> DataFrame:
    counts = df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("covered", F.col("n") > minimum)


def pearson(df: DataFrame, a: str, b: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.corr(a, b).alias("r"))


# cut points of a rank sketch, and its accuracy: a cut's rank is off by at most n / SKETCH_ACCURACY
CUTS, SKETCH_ACCURACY = 1024, 4096


def ranked_values(df: DataFrame, value: str, ranks: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Exact order statistics per key: ``{name: 0-based rank, as an expression of n}``.

    Sorting a group or gathering its values in one buffer does not scale to a hot key.  A mergeable rank sketch
    (Greenwald and Khanna's, as in ``percentile_approx``) gives ``CUTS`` cut points per key, each within a proven distance
    of its rank.  The cuts two steps to both sides of a rank bracket it whatever the distribution: a step is four
    times the error.  One more pass counts what lies below a bracket and the distinct values in it, at
    most about 5 / ``CUTS`` of a key's rows, which alone are sorted.
    """
    keys = list(keys)
    target = [*keys, "name"]
    d = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    d = materialise(d, "ranked")
    shares = [i / CUTS for i in range(CUTS + 1)]
    sketch = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", shares, SKETCH_ACCURACY).alias("_cuts"),
    )
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), r.cast("long").alias("rank")) for k, r in ranks.items()])
    step = F.floor(F.col("_t.rank") * CUTS / F.col("n")).cast("int")
    goal = sketch.withColumn("_t", F.explode(wanted)).select(
        *keys, "_t.name", F.col("_t.rank").alias("_rank"),
        F.when(step > 2, F.get("_cuts", step - 2)).otherwise(F.col("_min")).alias("_lo"),
        F.when(step < CUTS - 2, F.get("_cuts", step + 2)).otherwise(F.col("_max")).alias("_hi"),
    )
    # what lies below the bracket is one row, null
    met = join_small(d, goal, keys, salt_by="_v").where(F.col("_v") <= F.col("_hi"))
    inside = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    counts = met.groupBy(*target, "_rank", inside.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    hit = _holding(counts, target, "_v")
    return hit.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == k, F.col("_v"))).alias(k) for k in ranks])


def _holding(counts: DataFrame, target: Sequence[str], order: str) -> DataFrame:
    """The row of each target whose running count reaches its rank."""
    before = Window.partitionBy(*target).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return d.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))


def exact_median(df: DataFrame, value: str, keys: Sequence[str], alias: str = "median") -> DataFrame:
    n = F.col("n")
    middle = ranked_values(df, value, {"_a": F.floor((n - 1) / 2), "_b": F.floor(n / 2)}, keys)
    return middle.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(alias))


def exact_quantiles(df: DataFrame, value: str, fractions: Mapping[str, float], keys: Sequence[str]) -> DataFrame:
    """The smallest value whose cumulative share reaches each fraction."""
    n = F.col("n")
    ranks = {name: F.greatest(F.ceil(n * q) - 1, F.lit(0)) for name, q in fractions.items()}
    return ranked_values(df, value, ranks, keys)
