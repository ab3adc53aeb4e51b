"""Exact duplicates by a heavy-hitter split (DataFrame functions only).

Misra-Gries counters (``freqItems``) name every digest that may hold more than ``SUPPORT`` of the rows; an exact count
verifies them, and the verified winners, at most ``1 / SUPPORT`` rows, are broadcast: rows of a heavy digest are
decided where they are read.  All other digests, each a small share, take an ordinary shuffle.

Texts are equal if identical after lower-casing A-Z only; null counts as empty.  The row with the largest key stays
(null keys last); of rows that repeat key and text, one.  An empty table gives an empty result.  Only the key and text
columns are read, so other columns may have any names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewick.session import materialise

# a digest above this share of all rows is surely among the candidates; bounds the broadcast to 1 / SUPPORT rows
SUPPORT = 0.001

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; ``lower`` does it for pure ASCII text, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, lowercase hex."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def heavy_winners(rows: DataFrame, order: list[str], support: float = SUPPORT) -> DataFrame:
    """``(_digest, _n, _win)`` of every digest with over ``support`` of the rows; ``_win`` is the largest ``order``."""
    found = rows.freqItems(["_digest"], support).select(F.explode("_digest_freqItems").alias("_digest"))
    least = max(2, int(rows.count() * support))
    counted = (
        rows.join(F.broadcast(found), "_digest")
        .groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*order)).alias("_win"))
    )
    return materialise(counted.where(F.col("_n") > least), "heavy")


def decisions(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256."""
    rows = materialise(
        docs.select(F.col(key).alias("_key"), text_digest(F.col(text)).alias("_digest"))
        .withColumn("_tag", F.monotonically_increasing_id()),
        "digests",
    )
    winners = heavy_winners(rows, ["_key", "_tag"], support)
    joined = rows.join(F.broadcast(winners), "_digest", "left")
    heavy = joined.where(F.col("_n").isNotNull()).select(
        "_key", "_digest", "_n", F.col("_win._key").alias("_keep"), (F.col("_tag") == F.col("_win._tag")).alias("_kept")
    )
    group = Window.partitionBy("_digest")
    light = joined.where(F.col("_n").isNull()).select(
        "_key",
        "_digest",
        F.count(F.lit(1)).over(group).alias("_n"),
        F.max("_key").over(group).alias("_keep"),
        (F.row_number().over(group.orderBy(F.col("_key").desc_nulls_last(), F.col("_tag").desc())) == 1).alias("_kept"),
    )
    return heavy.unionByName(light).select(
        F.col("_key").alias(key),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Losers of heavy digests are dropped where they are read; the rest is ranked per digest, and a partial limit
    drops what a task's own rows already decide before the shuffle.
    """
    names = docs.columns
    digest, rank = (next(f"{x}{i}" for i in range(len(names) + 1) if f"{x}{i}" not in names) for x in ("_dg", "_rk"))
    rows = materialise(docs.select(F.col(key).alias("_key"), text_digest(F.col(text)).alias("_digest")), "digests")
    winners = heavy_winners(rows, ["_key"], support).select(
        F.col("_digest").alias(digest), F.struct(F.col("_win._key").alias("best")).alias(rank)
    )
    tagged = docs.withColumn(digest, text_digest(F.col(text)))
    left = tagged.join(F.broadcast(winners), digest, "left").where(
        F.col(rank).isNull() | F.col(key).eqNullSafe(F.col(f"{rank}.best"))
    )
    order = Window.partitionBy(digest).orderBy(F.col(key).desc_nulls_last())
    return left.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*names)
