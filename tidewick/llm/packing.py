"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities, in randomised groups.

Each document's ids (with its end id) are cut every ``SEQUENCE`` ids; full pieces are sequences of their own, and what is
left of each document is packed.  The remainders are dealt at random into groups of about ``GROUP`` pieces; a group is
one task's work, of bounded size whatever the input, and thousands of pieces leave first-fit decreasing little room.
The tournament tree keeps the largest free capacity below each node, so the first bin that fits is found in log2 steps.
A sequence is padded to ``SEQUENCE``, except where its length is a power of two.

Defined results: a null or empty text is its end id alone; a text of any length is cut like the others; rows that
repeat are packed once each; an empty table gives an empty result.  Only the key and text columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.llm import token_units
from tidewick.session import materialise

SEQUENCE = 1024
GROUP = 4096
OUT_ROWS = 20_000

PIECES = "start long, length long, doc_tokens long, ids binary"


def first_fit_decreasing(lengths: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, int]:
    """``(bin, offset, bins)``: each piece, longest first, goes into the first bin with room for it."""
    n = len(lengths)
    leaves = 1 << max(0, (max(n, 1) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets, used = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[k]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        at = node - leaves
        bins[k], offsets[k] = at, capacity - tree[node]
        used = max(used, at + 1)
        tree[node] -= need
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets, used


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE
) -> DataFrame:
    """The documents' pieces: ``_key``, start, length, doc_tokens, ids (little-endian unsigned 32-bit integers)."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_units.encoder(vocabulary)
        for batch in batches:
            keys = batch.column(0)
            for i, ids, bounds in encoder.documents(batch.column(1), end_id):
                total = np.diff(bounds)
                count = -(-total // sequence)
                row = np.repeat(np.arange(len(total)), count)
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = place * sequence
                length = np.minimum(total[row] - start, sequence)
                at = np.concatenate([[0], np.cumsum(length)]) * 4
                body = pa.Array.from_buffers(
                    pa.large_binary(), len(row),
                    [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row + i)), pa.array(start), pa.array(length), pa.array(total[row]), body.cast(pa.binary())],
                    names=["_key", "start", "length", "doc_tokens", "ids"],
                )

    return rows.mapInArrow(cut, f"_key {kind}, {PIECES}")


def assign(cut: DataFrame, sequence: int = SEQUENCE, group: int = GROUP, seed: int = 7) -> DataFrame:
    """``cut`` (a stored table with the column ``length``) with sequence_id and offset.

    Full pieces are placed where they are read; remainders are dealt into groups, each packed by one call.
    """
    short = cut.where(F.col("length") < sequence)
    groups = max(1, -(-short.count() // group))
    tagged = cut.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    full = tagged.where(F.col("length") >= sequence)
    names = cut.columns
    dealt = short.withColumn("_group", F.floor(F.rand(seed) * groups).cast("long"))
    schema = full.schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups arrive sorted, one after another; at most one group is held."""
        held: list[pa.Table] = []
        at = names.index("length")

        def flush():
            whole = pa.concat_tables(held).combine_chunks()
            bins, offsets, _ = first_fit_decreasing(whole.column(at).to_numpy(), sequence)
            ids = (whole.column("_group").to_numpy() << 33) + bins * 2
            out = whole.select(names).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))
            yield from out.to_batches(OUT_ROWS)

        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("_group")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and held[0].column("_group")[0].as_py() != ids[a]:
                    yield from flush()
                    held = []
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield from flush()

    ordered = dealt.repartition("_group").sortWithinPartitions("_group")
    return full.unionByName(ordered.mapInArrow(pack, schema))


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE
) -> DataFrame:
    """Every piece with its ids and its place: key, start, length, doc_tokens, ids, sequence_id, offset."""
    stored = materialise(pieces(docs, vocabulary, end_id, key, text, sequence), "pieces")
    return assign(stored, sequence).withColumnRenamed("_key", key)


def digests(docs: DataFrame, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``pack``, with a CRC-32 of each piece's ids in place of the ids; the ids are not stored."""
    cut = pieces(docs, vocabulary, end_id, key, text).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign(materialise(cut, "pieces")).withColumnRenamed("_key", key)
