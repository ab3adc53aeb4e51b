"""Token ids on disk as directly addressable codes: any token can be read without decoding a block.

An id is split into chunks of ``WIDTH`` bits, lowest first.  Level k holds the k-th chunk of every id that has one, and a
bitmap that says for each whether the id goes on; a rank directory (ones before each 64-bit word) turns a place
in level k into one in level k + 1.  A segment is one self-contained byte string::

    magic "DAC1", width u8, levels u8, 2 bytes 0, then per level: n u64, chunk bytes (n, padded to 8),
    bitmap (u64 words), directory (u32 per word, padded to 8)

all little-endian.  Segments hold whole documents and are rows of a Parquet table, so Spark's committer makes writing
safe against lost executors and repeated tasks, on any store: (shard, segment, start, n_tokens, keys, lengths, codes);
``start`` counts the ids of the shard before the segment.  Shards are ranges of keys in ascending order.

Defined results: a null or empty text is its end id alone; null keys come first; repeated rows are written once each;
an empty table gives an empty result.  Only the key and text columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewick.llm import token_units

WIDTH = 8
SEGMENT_TOKENS = 1 << 17


def _padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8)


def encode(ids: np.ndarray) -> bytes:
    rest = ids.astype(np.uint32)
    parts, levels = [], 0
    while levels == 0 or len(rest):
        more = rest >= (1 << WIDTH)
        words = np.packbits(np.pad(more, (0, -len(more) % 64)), bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.uint32)
        parts += [
            np.uint64(len(rest)).tobytes(),
            _padded((rest & ((1 << WIDTH) - 1)).astype(np.uint8).tobytes()),
            words.tobytes(),
            _padded((np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4").tobytes()),
        ]
        rest = rest[more] >> WIDTH
        levels += 1
    return b"".join([b"DAC1", bytes([WIDTH, levels, 0, 0]), *parts])


class Codes:
    """A segment's codes, read in place."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"DAC1":
            raise ValueError("not a segment of token codes")
        self.width, levels, at = raw[4], raw[5], 8
        self.levels = []
        for _ in range(levels):
            n = int(np.frombuffer(raw, "<u8", 1, at)[0])
            words = -(-n // 64)
            at += 8
            chunks = np.frombuffer(raw, np.uint8, n, at)
            at += n + -n % 8
            bitmap = np.frombuffer(raw, "<u8", words, at)
            at += 8 * words
            directory = np.frombuffer(raw, "<u4", words, at)
            at += 4 * words + (-4 * words) % 8
            self.levels.append((chunks, bitmap, directory))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def take(self, places: np.ndarray) -> np.ndarray:
        """The ids at ``places``, in a step per level and without touching other ids."""
        out = np.zeros(len(places), np.uint32)
        at, who = places.astype(np.int64), np.arange(len(places))
        for level, (chunks, bitmap, directory) in enumerate(self.levels):
            out[who] |= chunks[at].astype(np.uint32) << np.uint32(level * self.width)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            bits = bitmap[word]
            more = (bits >> bit) & np.uint64(1) == 1
            below = bits & ((np.uint64(1) << bit) - np.uint64(1))
            at = (directory[word].astype(np.int64) + np.bitwise_count(below))[more]
            who = who[more]
            if not len(who):
                break
        return out


def write(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", fold: bool = True
) -> None:
    """Encode all texts, each with ``end_id`` after it, in ascending order of ``key``, into segments below ``path``."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).repartitionByRange("_key")
    rows = rows.sortWithinPartitions("_key")
    kind = rows.schema["_key"].dataType.simpleString()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_units.encoder(vocabulary, fold)
        shard = TaskContext.get().partitionId()
        keys, lengths, ids, held, start, segment = [], [], [], 0, 0, 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard]), pa.array([segment]), pa.array([start]), pa.array([held]),
                    pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(keys[0].type)),
                    pa.array([np.concatenate(lengths)]), pa.array([encode(np.concatenate(ids))], pa.binary()),
                ],
                names=["shard", "segment", "start", "n_tokens", "keys", "lengths", "codes"],
            )

        for batch in batches:
            for i, out, bounds in encoder.documents(batch.column(1), end_id):
                a = 0
                while a < len(bounds) - 1:
                    b = int(np.searchsorted(bounds, bounds[a] + SEGMENT_TOKENS - held, "left"))
                    b = max(a + 1, min(b, len(bounds) - 1))
                    keys.append(batch.column(0).slice(i + a, b - a))
                    lengths.append(np.diff(bounds[a : b + 1]))
                    ids.append(out[bounds[a] : bounds[b]])
                    held += int(bounds[b] - bounds[a])
                    a = b
                    if held >= SEGMENT_TOKENS:
                        yield flush()
                        start, segment, held = start + held, segment + 1, 0
                        keys, lengths, ids = [], [], []
        if held:
            yield flush()

    rows.mapInArrow(
        segments,
        f"shard long, segment long, start long, n_tokens long, keys array<{kind}>, lengths array<long>, codes binary",
    ).write.parquet(path)


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """One row per document from the files: key, start (ids of all documents before), n_tokens, ids (binary u32)."""
    files = spark.read.parquet(path)
    # one row per shard; a running sum over shards, of which there are as many as write tasks
    per_shard = files.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = per_shard.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    element = files.schema["keys"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys = batch.column(2).slice(row, 1).flatten()
                lengths = batch.column(3).slice(row, 1).flatten().to_numpy()
                codes = Codes(batch.column(4)[row].as_py())
                ids = codes.take(np.arange(len(codes))).astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                first = batch.column(0)[row].as_py()
                body = pa.Array.from_buffers(
                    pa.large_binary(), len(lengths), [None, pa.py_buffer((bounds * 4).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), batch.column(1)[row].as_py())), keys, pa.array(first + bounds[:-1]),
                     pa.array(lengths), body.cast(pa.binary())],
                    names=["shard", "_key", "_start", "n_tokens", "ids"],
                )

    found = files.select("start", "shard", "keys", "lengths", "codes").mapInArrow(
        documents, f"shard long, _key {element}, _start long, n_tokens long, ids binary"
    )
    return found.join(F.broadcast(base), "shard").select(
        F.col("_key").alias(key), (F.col("_start") + F.col("_base")).alias("start"), "n_tokens", "ids"
    )
