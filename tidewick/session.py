"""Session helpers: shared scratch space and lineage cuts that survive executor loss."""

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a table up to this size is broadcast
BROADCAST_BYTES = 64 << 20
SALTS = 32


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one.  Only on a single machine (tests) a folder of our own is created where none is
    named, remembered in the session so that all callers agree on it, and removed when the process ends.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tidewick-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidewick/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Used where one expensive plan feeds several branches: the branches then scan columnar
    files instead of recomputing (or caching on executors that may be lost).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: Sequence[str], name: str = "store") -> DataFrame:
    """Write ``df`` under the shared folder as a table bucketed and sorted by ``keys``, one file per bucket.

    Grouping by ``keys`` and joins on exactly ``keys`` then read it without a shuffle, whenever they come.  There are as many
    buckets as shuffle partitions, so that the other side of a join is shuffled to them.  The table stays in the session's
    catalog under a name of its own; its files go with the shared folder.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = f"tidewick_{name}_{path[-32:]}"
    writer = df.repartition(n, *keys).write.format("parquet").option("path", path)
    writer.bucketBy(n, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def _bytes(stored: DataFrame) -> int | None:
    """The size of a stored table in memory: 16 bytes per number, texts as they are; None if it has other columns."""
    texts = [f.name for f in stored.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    plain = [f.name for f in stored.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    if len(texts) + len(plain) < len(stored.columns):
        return None
    sizes = [F.sum(F.coalesce(F.octet_length(c), F.lit(0))) for c in texts]
    found = stored.agg(F.count(F.lit(1)).alias("_rows"), *[s.alias(f"_{i}") for i, s in enumerate(sizes)]).first()
    return found[0] * (32 + 16 * len(plain) + 32 * len(texts)) + sum(x or 0 for x in found[1:])


def join_small(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", salt_by: str | None = None
) -> DataFrame:
    """Join a table that is expected to be tiny, without shuffling the big one where that holds.

    The small side is computed once, stored and measured.  Within ``BROADCAST_BYTES`` it is
    broadcast.  Beyond (or with columns of other types), both sides shuffle; with ``salt_by`` a key's rows are spread over salts of that
    column, and the small side is repeated per salt, so that a hot key fills many tasks.
    """
    stored = materialise(small, "small")
    size = _bytes(stored)
    if size is not None and size <= BROADCAST_BYTES:
        return big.join(F.broadcast(stored), list(on), how)
    if salt_by is None:
        return big.join(stored, list(on), how)
    salted = stored.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    return spread.join(salted, [*on, "_salt"], how).drop("_salt")
