"""Quality by importance resampling: hashed n-gram models of good and of all text, sampled by Gumbel top-k.

Texts become bags of byte 4-grams hashed into ``BUCKETS``.  The raw model counts every document, the target model the
documents labelled good (smoothed towards raw by ``PRIOR`` grams); a document's log weight is its log-likelihood
under target minus that under raw.  Documents are drawn without replacement by Gumbel top-k: key = log weight /
``TEMPERATURE`` + Gumbel noise seeded by the document's key, and the ``k`` largest keys stay, found exactly by histograms.
``k`` is the number of documents with a log weight at or above a cut, which is fitted on labelled documents that the
models have not seen so that losing a good document costs ``CLEAN`` times what keeping a bad one does.

Bounds: of the labels the ``LABELLED`` rows with the smallest hashes are used and broadcast; the driver gets two counts per
bucket and the weights of the held-out labelled rows.  All other counts and scores cover all documents.

Defined results: null and empty texts, and texts under four bytes, have log weight 0; rows that repeat share their noise
and are kept or rejected together; null keys take the noise of the hash of null; without labels of both kinds
everything is kept.  Labels that are null are not used; of several labels for a document the lowest is.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewick.llm import texts
from tidewick.session import materialise

BUCKETS = 1 << 16
WIDTH = 4
PRIOR = 1e5
TEMPERATURE = 0.1
CLEAN = 20.0
LABELLED = 100_000
SEED = 11


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, row)`` of all byte 4-grams that lie within a row."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        code |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:n] == row[WIDTH - 1 :]
    return (texts.mix(code[inside]) % np.uint64(BUCKETS)).astype(np.int64), row[:n][inside]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for i, n, data, offsets in texts.slices(batch.column(0)):
            bucket, row = grams(data, offsets)
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket[target[i : i + n][row]], minlength=BUCKETS)
    used = np.flatnonzero(total.ravel())
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.ravel()[used])], names=["cell", "n"])


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((target + PRIOR * p_raw) / (target.sum() + PRIOR)) - np.log(p_raw)


def weights(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """The log weights of a column of texts."""
    out = [np.zeros(0)]
    for _, n, data, offsets in texts.slices(column):
        bucket, row = grams(data, offsets)
        out.append(np.bincount(row, weights=ratio[bucket], minlength=n))
    return np.concatenate(out)


def labelled(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """At most ``LABELLED`` rows ``(_id, _good, _held)``, the same on every run."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    rows = rows.groupBy(F.col(key).alias("_id")).agg((F.min(label) == 1).alias("_good"))
    rows = rows.orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(LABELLED)
    return materialise(rows.withColumn("_held", F.pmod(F.xxhash64(F.lit(SEED + 1), "_id"), F.lit(5)) == 0), "labels")


def train(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """The log ratio of every bucket."""
    good = known.where(F.col("_good") & ~F.col("_held")).select("_id", F.lit(True).alias("_target"))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    rows = rows.join(F.broadcast(good), "_id", "left").select("_text", F.coalesce("_target", F.lit(False)).alias("_target"))
    summed = rows.mapInArrow(_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * BUCKETS)
    total[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    raw, target = total.reshape(2, BUCKETS)
    return log_ratio(raw, target) if target.sum() else np.zeros(BUCKETS)


def with_weight(docs: DataFrame, ratio: np.ndarray, text: str, out: str) -> DataFrame:
    """``docs`` and the column ``out``; the model is broadcast, its size is fixed."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    at = docs.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(weights(batch.column(at), shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, out])

    return docs.mapInArrow(score, docs.withColumn(out, F.lit(0.0)).schema)


def gumbel_key(weight: Column, key: Column, seed: int = SEED) -> Column:
    """log weight / TEMPERATURE + Gumbel noise; the noise depends on ``key`` and ``seed`` only."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed + 2), key), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return weight / TEMPERATURE - F.log(-F.log(uniform))


def cut_of(scores: np.ndarray, good: np.ndarray) -> float:
    """The cut with the least CLEAN * (share of good below) + (share of bad at or above)."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    ranked, is_good = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(is_good)]) / is_good.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(~is_good)]) / (~is_good).sum()
    borders = np.concatenate([[-np.inf], (ranked[1:] + ranked[:-1]) / 2, [np.inf]])
    return float(borders[np.argmin(CLEAN * lost + passed)])


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The exact k-th largest value: histograms of ``bins`` cells narrow its range until one value is left."""
    if k <= 0:
        return float("inf")
    low, high = rows.agg(F.min(column), F.max(column)).first()
    rest = k
    while low < high:
        step = high / bins - low / bins
        cell = F.least(F.floor((F.col(column) - low) / step).cast("int"), F.lit(bins - 1)) if step > 0 else F.lit(0)
        found = (
            rows.where(F.col(column).between(low, high)).groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("cell")).collect()
        )
        for at in found:
            if rest <= at["n"]:
                break
            rest -= at["n"]
        if (low, high) == (at["low"], at["high"]) and step <= 0:
            break
        low, high = at["low"], at["high"]
    return low


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, DataFrame, float]:
    """``(log ratio, scored, least)``: scored has _key, log_weight, gumbel; ``least`` is the smallest key that stays."""
    known = labelled(labels)
    ratio = train(docs, known, key, text)
    rows = with_weight(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), ratio, "_text", "log_weight")
    rows = rows.select("_key", "log_weight", gumbel_key(F.col("log_weight"), F.col("_key")).alias("gumbel"))
    scored = materialise(rows, "weights")
    held = known.where("_held").select(F.col("_id").alias("_key"), "_good")
    seen = scored.join(F.broadcast(held), "_key").groupBy("_key", "_good").agg(F.min("log_weight").alias("w")).toArrow()
    cut = cut_of(seen.column("w").to_numpy(), seen.column("_good").to_numpy(zero_copy_only=False).astype(bool))
    k = scored.where(F.col("log_weight") >= F.lit(cut)).count()
    return ratio, scored, kth_largest(scored, "gumbel", k)


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, log_weight, gumbel (its perturbed key), kept."""
    _, scored, least = fit(docs, labels, key, text)
    return scored.select(F.col("_key").alias(key), "log_weight", "gumbel", (F.col("gumbel") >= F.lit(least)).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; they are weighed again where they are read, not joined."""
    ratio, _, least = fit(docs, labels, key, text)
    out = next(f"_w{i}" for i in range(len(docs.columns) + 1) if f"_w{i}" not in docs.columns)
    scored = with_weight(docs, ratio, text, out)
    return scored.where(gumbel_key(F.col(out), F.col(key)) >= F.lit(least)).select(*docs.columns)
