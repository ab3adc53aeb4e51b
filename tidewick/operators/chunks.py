"""Ordered analytics over long series without one task per series.

A plain ``Window.partitionBy(series).orderBy(timestamp)`` sends a whole series to one task, and
one series may hold a third of the table.  Everything ordered in this package is therefore
built from the pieces below, which partition by ``(series, chunk)`` where a chunk is a bounded
stretch of time or rows:

* :func:`neighbour`      lag / lead by one row,
* :func:`running`        running sum / last non-null / first / max,
* :func:`row_positions`  row number within the series and series length,
* :func:`with_halo`      any bounded frame or lag: each chunk also receives the rows next to it,
* :func:`edge_rows`      newest / oldest k rows of every series,
* :func:`attach`         join of a one-row-per-series table to all its rows.

What crosses chunks is one summary row per chunk.  A candle is unique per second, so a
series of period p has at most (valid time range) / (p * CHUNK_ROWS) chunks; with the
validity bounds used here (about 9.5e8 seconds) that is at most 116k summary rows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewick.schema import SERIES
from tidewick.session import join_small

CHUNK_ROWS = 8192
BLOCK_ROWS = 256


def time_chunk(rows: int | None = None) -> Column:
    """Id of the time span holding at most ``rows`` candles of one series."""
    return F.expr(f"timestamp div (period * {rows or CHUNK_ROWS}L)")


def _chunked(df: DataFrame, rows: int | None) -> tuple[DataFrame, list[str]]:
    """``df`` with ``_chunk``, and the columns to drop at the end.

    Chunks that are there already (kept by :func:`drop_halo`) are used again: the rows are
    partitioned by them, and no further shuffle is needed.
    """
    if "_chunk" in df.columns:
        return df, []
    return df.withColumn("_chunk", time_chunk(rows)), ["_chunk"]


def _chunk_window(keys: Sequence[str], reverse: bool = False) -> WindowSpec:
    order = F.col("_chunk").desc() if reverse else F.col("_chunk").asc()
    return Window.partitionBy(*keys).orderBy(order)


def _row_window(keys: Sequence[str], reverse: bool = False) -> WindowSpec:
    order = F.col("timestamp").desc() if reverse else F.col("timestamp").asc()
    return Window.partitionBy(*keys, "_chunk").orderBy(order)


def neighbour(
    df: DataFrame,
    columns: Mapping[str, str],
    offset: int = -1,
    keys: Sequence[str] = SERIES,
    rows: int | None = None,
) -> DataFrame:
    """Add ``{new: source}`` taken from the previous (-1) or next (+1) row of the series."""
    reverse = offset > 0
    pick = F.min_by if reverse else F.max_by
    d, extra = _chunked(df, rows)
    edges = d.groupBy(*keys, "_chunk").agg(
        *[pick(F.col(src), F.col("timestamp")).alias(f"_edge_{new}") for new, src in columns.items()]
    )
    over_chunks = _chunk_window(keys, reverse)
    edges = edges.select(
        *keys, "_chunk", *[F.lag(f"_edge_{new}").over(over_chunks).alias(f"_edge_{new}") for new in columns]
    )
    w = _row_window(keys, reverse)
    first = F.row_number().over(w) == 1
    d = d.join(edges, [*keys, "_chunk"], "left")
    return d.withColumns(
        {new: F.when(first, F.col(f"_edge_{new}")).otherwise(F.lag(src).over(w)) for new, src in columns.items()}
    ).drop(*extra, *[f"_edge_{new}" for new in columns])


def running(
    df: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    keys: Sequence[str] = SERIES,
    reverse: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Add running values ``{new: (kind, source)}``, kind in sum, last, first, max.

    ``last`` and ``first`` skip nulls; with ``reverse`` rows are taken newest first, so a
    reversed ``last`` is a backward fill.
    """
    d, extra = _chunked(df, rows)
    ts = F.col("timestamp")
    summary, carry, merged = [], [], {}
    before = _chunk_window(keys, reverse).rowsBetween(Window.unboundedPreceding, -1)
    upto = _row_window(keys, reverse).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for new, (kind, src) in columns.items():
        c, own, prior = F.col(src), f"_own_{new}", f"_prior_{new}"
        if kind == "sum":
            summary.append(F.sum(c).alias(own))
            carry.append(F.sum(own).over(before).alias(prior))
            merged[new] = F.when(
                F.col(prior).isNull(), F.sum(c).over(upto)
            ).otherwise(F.col(prior) + F.coalesce(F.sum(c).over(upto), F.lit(0)))
        elif kind == "max":
            summary.append(F.max(c).alias(own))
            carry.append(F.max(own).over(before).alias(prior))
            merged[new] = F.greatest(F.col(prior), F.max(c).over(upto))
        elif kind in ("last", "first"):
            newest = (kind == "last") != reverse
            pick = F.max_by if newest else F.min_by
            summary.append(pick(c, F.when(c.isNotNull(), ts)).alias(own))
            fold = F.last if kind == "last" else F.first
            carry.append(fold(own, ignorenulls=True).over(before).alias(prior))
            local = fold(src, ignorenulls=True).over(upto)
            pair = (local, F.col(prior)) if kind == "last" else (F.col(prior), local)
            merged[new] = F.coalesce(*pair)
        else:
            raise ValueError(f"unknown running kind {kind!r}")
    totals = d.groupBy(*keys, "_chunk").agg(*summary).select(*keys, "_chunk", *carry)
    out = d.join(totals, [*keys, "_chunk"], "left").withColumns(merged)
    return out.drop(*extra, *[f"_prior_{new}" for new in columns])


def row_positions(df: DataFrame, keys: Sequence[str] = SERIES, rows: int | None = None) -> DataFrame:
    """Add ``pos`` (0-based row number in the series) and ``n_rows`` (series length)."""
    d, extra = _chunked(df, rows)
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = _chunk_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *keys,
        "_chunk",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("n_rows"),
    )
    out = d.join(counts, [*keys, "_chunk"])
    pos = F.col("_before") + F.row_number().over(_row_window(keys)) - 1
    return out.withColumn("pos", pos).drop(*extra, "_before")


def with_halo(
    df: DataFrame,
    back: int = 0,
    ahead: int = 0,
    pos: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Spread rows over chunks of ``rows`` positions, each with its neighbours' edge rows.

    ``pos`` must grow by one per row: by default ``timestamp div period``, which holds on gap-free
    series; else pass ``pos`` of :func:`row_positions`.  The copies are ``back`` rows before
    and ``ahead`` rows after each chunk, so every frame within these bounds over
    :func:`halo_window` is exact for the chunk's own rows; :func:`drop_halo` removes the copies.
    """
    rows = max(rows or CHUNK_ROWS, back, ahead)
    d = df.withColumn("_pos", F.expr("timestamp div period") if pos is None else pos)
    own, offset = F.expr(f"_pos div {rows}L"), F.expr(f"_pos % {rows}L")
    homes = [own]
    if back:
        homes.append(F.when(offset >= rows - back, own + 1))
    if ahead:
        homes.append(F.when(offset < ahead, own - 1))
    d = d.withColumn("_chunk", F.explode(F.array_compact(F.array(*homes))))
    return d.withColumns(
        {
            "_core": F.col("_chunk") == own,
            "_block": F.expr(f"_pos div {BLOCK_ROWS}L"),
            "_head": F.col("_pos") > F.col("_chunk") * rows - back,
        }
    )


def halo_window(keys: Sequence[str] = SERIES) -> WindowSpec:
    """Rows of one chunk in order; shares one sort with the blocks of :mod:`scan`."""
    return Window.partitionBy(*keys, "_chunk").orderBy("_block", "_pos")


def drop_halo(df: DataFrame, keep_chunk: bool = False) -> DataFrame:
    """The chunks' own rows; ``keep_chunk`` when a running value over the same rows follows."""
    return df.where("_core").drop(*([] if keep_chunk else ["_chunk"]), "_core", "_block", "_head", "_pos")


def edge_rows(
    df: DataFrame, k: int, newest: bool = True, keys: Sequence[str] = SERIES, rows: int | None = None
) -> DataFrame:
    """Newest (or oldest) ``k`` rows of every series, ranked in ``rank`` from 1.

    Chunk counts tell which chunks can hold these rows; only those are kept and ranked, so the
    final window sees at most ``k`` rows plus one chunk per series.
    """
    d, _ = _chunked(df, rows)
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    nearer = _chunk_window(keys, reverse=newest).rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        counts.withColumn("_nearer", F.coalesce(F.sum("_n").over(nearer), F.lit(0)))
        .where(F.col("_nearer") < k)
        .select(*keys, "_chunk")
    )
    order = F.col("timestamp").desc() if newest else F.col("timestamp").asc()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    near = join_small(d, wanted, [*keys, "_chunk"], "left_semi").drop("_chunk")
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def attach(df: DataFrame, per_series: DataFrame, keys: Sequence[str] = SERIES, how: str = "inner") -> DataFrame:
    """Join a one-row-per-series table to the rows of each series (see :func:`join_small`)."""
    return join_small(df, per_series, keys, how, salt_by="timestamp")
