"""Structured Streaming forms of ingest, candles, duplicate suppression, scoring and alerts.

Every job runs until the available input is used up (``availableNow``) and keeps its progress in
a checkpoint folder, so the next run resumes from there: the checkpoint is the high-water mark.
"""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewick.operators.clean import closed_candles
from tidewick.schema import PAIR, TICK
from tidewick.session import materialise
from tidewick.sinks.tables import insert_if_absent, is_directory, versions
from tidewick.sources.payloads import normalize_candles, unwrap_payloads
from tidewick.sources.ticks import ticks_from_events

DELAY = "10 minutes"


def tick_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Ticks of landed event files (a folder, or one file) with their event time ``at``."""
    reader = spark.readStream.schema(TICK)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if not is_directory(spark, path):
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    return ticks_from_events(reader.parquet(path)).withColumn("at", F.timestamp_micros("micros"))


def candle_stream(ticks: DataFrame, period: int, delay: str = DELAY) -> DataFrame:
    """Candles of closed buckets only; ticks later than ``delay`` are left to batch repair."""
    order = F.expr("cast(micros as decimal(38,0)) * 10000000000000000000BD + cast(seq as decimal(19,0))").cast(
        "decimal(38,0)"
    )
    d = ticks.withWatermark("at", delay).withColumn("_order", order)
    out = d.groupBy("exchange", "trading_pair", F.window("at", f"{period} seconds").alias("_w")).agg(
        F.min_by("price", "_order").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "_order").alias("close"),
        F.sum("qty").alias("volume"),
    )
    return out.select(
        "exchange",
        "trading_pair",
        F.lit(period).alias("period"),
        F.unix_seconds("_w.start").alias("timestamp"),
        "open",
        "high",
        "low",
        "close",
        "volume",
    )


def dedupe_stream(rows: DataFrame, keys: Sequence[str], time: str = "at", delay: str = DELAY) -> DataFrame:
    """First arrival of every key; keys are remembered until the watermark has passed them."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run on what is available, append to Parquet, and return all that was ever written."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest(
    spark: SparkSession, landed: str, schema: T.StructType, table: str, checkpoint: str, now: int, side: str | None = None
) -> None:
    """New response files -> valid, closed candles -> the table, each key once.

    Nothing is lost: candles that cannot be read go to ``side``/rejected, and candles that are still open wait in
    ``side``/open until a later batch finds them closed (``side`` is by default beside the table).  Both are
    written per batch, so a batch that is repeated after a failure inserts nothing twice.
    """
    side = side or f"{table.rstrip('/')}-side"

    def insert(batch: DataFrame, number: int) -> None:
        batch = materialise(unwrap_payloads(batch), "ingest")
        valid, rejected = normalize_candles(batch)
        rejected.write.mode("overwrite").parquet(f"{side}/rejected/batch={number}")
        before = [n for n in versions(spark, f"{side}/open", "batch=") if n < number]
        if before:
            valid = valid.unionByName(spark.read.schema(valid.schema).parquet(f"{side}/open/batch={max(before)}"))
        valid = materialise(valid, "ingest")
        insert_if_absent(closed_candles(valid, now), table)
        valid.where(F.col("timestamp") + F.col("period") > now).write.mode("overwrite").parquet(f"{side}/open/batch={number}")

    run_batches(spark.readStream.schema(schema).json(landed), insert, checkpoint)


def rejected_candles(spark: SparkSession, table: str, schema: T.StructType, side: str | None = None) -> DataFrame:
    """What :func:`ingest` could not read, with the number of its batch."""
    side = side or f"{table.rstrip('/')}-side"
    return spark.read.schema(schema).parquet(f"{side}/rejected")


# --- run length with state -------------------------------------------------------------------

RUN_STATE = T.StructType(
    [T.StructField("state", T.IntegerType()), T.StructField("since", T.LongType()), T.StructField("seen", T.LongType())]
)
RUN_OUTPUT = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in PAIR[:3]],
        T.StructField("period", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("arbitrage_opportunity", T.IntegerType()),
        T.StructField("window_length", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)


def _extend_runs(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches)).sort_values("timestamp", kind="stable")
    value, since, seen = state.get if state.exists else (None, None, None)
    if seen is not None:
        old = rows[rows["timestamp"] <= seen]
        if len(old):
            yield old.assign(window_length=pd.array([None] * len(old), "Int64"), late=True)[RUN_OUTPUT.fieldNames()]
        rows = rows[rows["timestamp"] > seen]
    if rows.empty:
        return
    out, value, since = _lengths(rows, key[3], value, since)
    state.update((value, since, int(rows["timestamp"].iloc[-1])))
    yield out[RUN_OUTPUT.fieldNames()]


def _lengths(rows: pd.DataFrame, period: int, value: int | None, since: int | None) -> tuple[pd.DataFrame, int, int]:
    """Rows in order of time with the minutes their state has lasted, the last state, and since when."""
    current, at = rows["arbitrage_opportunity"], rows["timestamp"]
    starts = at.where(current != current.shift(1, fill_value=current.iloc[0] + 1 if value is None else value))
    starts.iloc[0] = starts.iloc[0] if pd.notna(starts.iloc[0]) else since
    starts = starts.ffill().astype("int64")
    minutes = ((at - starts + period) // 60).astype("Int64")
    return rows.assign(window_length=minutes, late=False), int(current.iloc[-1]), int(starts.iloc[-1])


REORDER_STATE = T.StructType(
    [*RUN_STATE.fields, T.StructField("times", T.ArrayType(T.LongType())), T.StructField("states", T.ArrayType(T.IntegerType()))]
)
# Spark filters rows behind a stream's watermark; its watermark lies this far behind ours, so that late rows reach the buffer
SLACK_MS = 365 * 86_400_000


def _reorder(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, delay_ms: int) -> Iterator[pd.DataFrame]:
    """Rows wait until the watermark has passed them and leave in order."""
    value, since, seen, times, states = state.get if state.exists else (None, None, None, [], [])
    passed = (state.getCurrentWatermarkMs() + SLACK_MS - delay_ms) // 1000
    names = dict(zip(PAIR, key, strict=True))
    waiting = pd.DataFrame({**names, "timestamp": pd.Series(list(times), dtype="int64"), "arbitrage_opportunity": pd.Series(list(states), dtype="int32")})
    rows = pd.concat([waiting, *batches])[[*PAIR, "timestamp", "arbitrage_opportunity"]]
    if seen is not None:
        behind = rows["timestamp"] <= seen
        if behind.any():
            old = rows[behind]
            yield old.assign(window_length=pd.array([None] * len(old), "Int64"), late=True)[RUN_OUTPUT.fieldNames()]
        rows = rows[~behind]
    rows = rows.sort_values("timestamp", kind="stable")
    ready = rows[rows["timestamp"] <= passed]
    rest = rows[rows["timestamp"] > passed]
    if len(ready):
        out, value, since = _lengths(ready, key[3], value, since)
        seen = int(ready["timestamp"].iloc[-1])
        yield out[RUN_OUTPUT.fieldNames()]
    state.update((value, since, seen, rest["timestamp"].tolist(), rest["arbitrage_opportunity"].tolist()))
    if len(rest):
        state.setTimeoutTimestamp(int(rest["timestamp"].iloc[0]) * 1000 + delay_ms - SLACK_MS)


def reordered_length_stream(states: DataFrame, delay: int) -> DataFrame:
    """:func:`window_length_stream` for rows that arrive out of order by up to ``delay`` seconds.

    Rows wait in a buffer per pair, bounded by the rows of ``delay`` seconds, until the newest row of the stream is so
    much newer; timers let them go when no row of their own pair arrives.  Only rows that come behind one that has left are late.
    """
    timed = states.withColumn("at", F.timestamp_seconds("timestamp")).withWatermark("at", f"{SLACK_MS // 1000} seconds")
    return timed.groupBy(*PAIR).applyInPandasWithState(
        lambda key, batches, state: _reorder(key, batches, state, delay * 1000), RUN_OUTPUT, REORDER_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def window_length_stream(states: DataFrame) -> DataFrame:
    """Minutes the arbitrage state of each pair has lasted, on a live stream.

    One batch holds a bounded stretch of new rows per pair (limit the files per trigger); the state keeps the
    run's start.  Rows no newer than the last one seen come out as ``late``, without a length, for batch repair.
    """
    return states.groupBy(*PAIR).applyInPandasWithState(
        _extend_runs, RUN_OUTPUT, RUN_STATE, "append", GroupStateTimeout.NoTimeout
    )


# --- alerts ----------------------------------------------------------------------------------


def recent_alerts(predictions: DataFrame, now, within: int = 900, newest: int | None = None) -> DataFrame:
    """Predictions of the last ``within`` seconds that see an arbitrage; with ``newest`` the newest so many of them."""
    recent = F.col("p_time") > F.lit(now) - F.make_dt_interval(secs=F.lit(within))
    d = predictions.where(recent & (F.col("prediction") != "no_arbitrage"))
    if newest is None:
        return d
    return d.orderBy(F.col("p_time").desc(), "exchange_1", "exchange_2", "trading_pair").limit(newest)


def alert_stream(predictions: DataFrame, alert: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every new prediction that sees an arbitrage to ``alert``."""
    run_batches(predictions.where(F.col("prediction") != "no_arbitrage"), alert, checkpoint)
