"""Ranked lexical search: accumulators of short lists as one bounded iterator beside the long lists.

Items are taken in blocks of about ``BLOCK_PAIRS`` (item, term) pairs.  For a block the documents are read once and
indexed: a segment of about ``SEGMENT_BYTES`` of text is one row with its documents' ids and lengths and, for every
term of the block, the places and counts of the documents that hold it.  Document frequencies, the number of documents and
all their terms are sums over the segments.  Each task then answers the block's items on its segments:

* term at a time: an item's shortest lists, up to ``SHORT_SHARE`` of the segment's documents in all, are summed into
  accumulators, which from there on are one iterator, bounded by their largest sum;
* document at a time: iterators are ordered by bound; those whose bounds together stay below the item's k-th score
  cannot bring in a document alone, so only the others name candidates, in windows of ``WINDOW`` documents in order.  A
  candidate is looked up in the remaining lists from the highest bound down and skipped as soon as its sum and what is left
  stay below the k-th score, which rises from window to window and segment to segment.

A document is skipped only below the k-th score, never at it, so ties are whole.  A task gives at most k rows an item;
these meet in two steps, by (item, salt) and by item.  Scores are 64-bit integers; 32-bit counts.  Words are known by
64-bit hashes.

Defined results: null and empty texts have no terms and are found by nothing; items without a term in the documents
have no rows; items of any length; a repeated item is answered as often as it occurs, with its own ranks; equal scores
go by ascending key, null last; rows that repeat a key are documents of their own; an empty table gives an empty
result.  Only the key and text columns of both tables are read.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.llm import texts
from tidewick.session import materialise, scratch_path

BLOCK_PAIRS = 1 << 18
SEGMENT_BYTES = 16 << 20
SHORT_SHARE = 0.5
WINDOW = 1024
SALTS = 16
# fixed values: the words of a text, and the score's whole numbers
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, TF_SCALE, SATURATION, FLAT, SLOPE = 1_000_000_000, 1000, 12, 75, 25

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

INDEX = "keys array<{kind}>, lengths binary, terms array<int>, holding array<int>, places binary, counts binary, n_docs long, n_terms long"


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Each item's distinct terms and how often it has them: tag (one per row of ``items``), item, term, times."""
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))
    rows = items.select(F.col(key).alias("item"), words.alias("words"))
    tagged = materialise(rows.select(F.monotonically_increasing_id().alias("tag"), "item", "words"), "items")
    return materialise(
        tagged.select("tag", "item", F.explode("words").alias("term")).groupBy("tag", "item", "term")
        .agg(F.count(F.lit(1)).alias("times")), "item_terms",
    )


class Block:
    """A block of items: the hashes of its terms in order, and each item's term numbers and counts."""

    def __init__(self, rows: list):
        names = sorted({r.term for r in rows})
        raw = [w.encode() for w in names]
        ends = np.cumsum([len(w) for w in raw])
        hashes = texts.hash_spans(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64))
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {names[k]: i for i, k in enumerate(order)}
        by_tag: dict[int, list] = {}
        for r in rows:
            by_tag.setdefault(r.tag, []).append(r)
        self.items = [
            (tag, np.array([number[r.term] for r in mine]), np.array([r.times for r in mine])) for tag, mine in sorted(by_tag.items())
        ]


def build(docs: DataFrame, hashes: np.ndarray, key: str, text: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per segment: the postings of the terms with these hashes."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lengths, terms, places, counts, size, n = [], [], [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            term, place, count = (np.concatenate(x) for x in (terms, places, counts))
            order = np.argsort(term, kind="stable")  # places stay ascending within a term
            found, holding = np.unique(term, return_counts=True)
            length = np.concatenate(lengths)
            values = [
                pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(keys)), pa.array([length.astype(np.int32).tobytes()], pa.binary()),
                pa.array([found.astype(np.int32)], pa.list_(pa.int32())), pa.array([holding.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([place[order].astype(np.int32).tobytes()], pa.binary()), pa.array([count[order].astype(np.int32).tobytes()], pa.binary()),
                pa.array([int((length > 0).sum())]), pa.array([int(length.sum())]),
            ]
            for x in (keys, lengths, terms, places, counts):
                x.clear()
            return pa.RecordBatch.from_arrays(values, names=["keys", "lengths", "terms", "holding", "places", "counts", "n_docs", "n_terms"])

        for batch in batches:
            for i, rows_in, data, offsets in texts.slices(batch.column(1)):
                starts, ends, row = texts.runs(_TERM[data], offsets)
                words = texts.hash_spans(texts.lower_ascii(data), starts, ends)
                at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
                known = hashes[at] == words
                pair, count = np.unique(row[known] * len(hashes) + at[known], return_counts=True)
                keys.append(batch.column(0).slice(i, rows_in))
                lengths.append(np.bincount(row, minlength=rows_in))
                terms.append(pair % len(hashes))
                places.append(pair // len(hashes) + n)
                counts.append(count)
                n, size = n + rows_in, size + len(data)
                if size >= segment_bytes:
                    yield flush()
                    size = n = 0
        if n:
            yield flush()

    return rows.mapInArrow(segments, INDEX.format(kind=kind.simpleString()))


class Statistics:
    """Documents with a term, all terms, and the weight of every term of a block: sums over all segments."""

    def __init__(self, index: DataFrame, n_terms: int):
        self.docs, self.terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        posted = index.select(F.explode(F.arrays_zip("terms", "holding")).alias("p"))
        self.weights = np.zeros(n_terms, np.int64)
        for term, df in posted.groupBy("p.terms").agg(F.sum("p.holding")).collect():
            self.weights[term] = math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))


class Segment:
    """Lists of one segment: for every posting its document and impact, for every term its list and highest impact."""

    def __init__(self, row: dict, stats: Statistics):
        n = np.frombuffer(row["lengths"], np.int32)
        if len(n) and int(n.max()) * SLOPE * stats.docs >= 1 << 62:
            n = n.astype(object)
        spread = (FLAT + SLOPE * n.astype(n.dtype if n.dtype == object else np.int64) * stats.docs // stats.terms).astype(np.int64)
        self.size = len(n)
        self.docs = np.frombuffer(row["places"], np.int32).astype(np.int64)
        tf = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        self.impacts = SCALE * tf // (TF_SCALE * tf + SATURATION * spread[self.docs])
        self.lengths = np.array(row["holding"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.highest = np.maximum.reduceat(self.impacts, self.starts) if len(self.starts) else np.zeros(0, np.int64)
        self.list_of = np.full(len(stats.weights), -1)
        self.list_of[np.array(row["terms"], np.int64)] = np.arange(len(self.lengths))

    def best(
        self, terms: np.ndarray, weights: np.ndarray, k: int, threshold: int, short_share: float = SHORT_SHARE, window: int = WINDOW
    ) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that may be among the k best, given k scores of ``threshold`` or more elsewhere."""
        lists = self.list_of[terms]
        here = (lists >= 0) & (weights > 0)
        lists, weights = lists[here], weights[here]
        order = np.argsort(self.lengths[lists], kind="stable")
        lists, weights = lists[order], weights[order]
        n_short = int(np.searchsorted(np.cumsum(self.lengths[lists]), short_share * self.size, "right"))

        # term at a time: the short lists become one iterator of summed accumulators
        sums = np.zeros(self.size, np.int64)
        at = texts.ragged(self.starts[lists[:n_short]], self.lengths[lists[:n_short]])
        np.add.at(sums, self.docs[at], self.impacts[at] * np.repeat(weights[:n_short], self.lengths[lists[:n_short]]))
        iterators = [(int(sums.max(initial=0)), np.flatnonzero(sums), None, 1)]
        for x, weight in zip(lists[n_short:].tolist(), weights[n_short:].tolist(), strict=True):
            mine = slice(self.starts[x], self.starts[x] + self.lengths[x])
            iterators.append((int(self.highest[x]) * weight, self.docs[mine], self.impacts[mine], weight))
        iterators.sort(key=lambda it: it[0])
        bounds = np.cumsum([it[0] for it in iterators])

        # document at a time, in windows
        top = np.full(k, threshold, np.int64)
        out_docs, out_scores = [], []
        for low in range(0, self.size, window):
            threshold = int(top[0])
            optional = int(np.searchsorted(bounds, threshold, "left"))
            if optional == len(iterators):
                break
            score = np.zeros(min(window, self.size - low), np.int64)
            for _, docs, impacts, weight in iterators[optional:]:
                a, b = np.searchsorted(docs, (low, low + len(score)))
                score[docs[a:b] - low] += sums[docs[a:b]] if impacts is None else impacts[a:b] * weight
            found = np.flatnonzero(score)
            score = score[found]
            for i in range(optional - 1, -1, -1):
                may = score + bounds[i] >= threshold
                found, score = found[may], score[may]
                if not len(found):
                    break
                _, docs, impacts, weight = iterators[i]
                place = found + low
                if impacts is None:
                    score = score + sums[place]
                elif len(docs):
                    at = np.minimum(np.searchsorted(docs, place), len(docs) - 1)
                    score = score + np.where(docs[at] == place, impacts[at] * weight, 0)
            keep = score >= max(threshold, 1)
            if keep.any():
                out_docs.append(found[keep] + low)
                out_scores.append(score[keep])
                top = np.sort(np.concatenate([top, score[keep]]))[-k:]
        none = np.zeros(0, np.int64)
        docs, scores = np.concatenate([none, *out_docs]), np.concatenate([none, *out_scores])
        last = scores >= top[0]
        return docs[last], scores[last]


def _order(hit: tuple) -> tuple:
    score, key = hit
    return -score, key is None, 0 if key is None else key


def answers(index: DataFrame, block: Block, stats: Statistics, k: int, **how) -> DataFrame:
    """``_tag``, ``_key``, score: at most k rows an item from every task."""
    # what every task gets of a block: 16 bytes a pair, within BLOCK_PAIRS
    questions = [(tag, terms, times * stats.weights[terms]) for tag, terms, times in block.items]
    kind = index.schema["keys"].dataType.elementType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in questions]
        arrow = None
        for batch in batches:
            arrow = batch.column("keys").type.value_type
            for row in range(batch.num_rows):
                part = Segment({n: batch.column(n)[row].as_py() for n in ("lengths", "terms", "holding", "places", "counts")}, stats)
                keys = batch.column("keys")[row].values
                for mine, (_, terms, weights) in zip(best, questions, strict=True):
                    docs, scores = part.best(terms, weights, k, mine[-1][0] if len(mine) == k else 0, **how)
                    if len(docs):
                        mine += zip(scores.tolist(), keys.take(pa.array(docs)).to_pylist(), strict=True)
                        mine.sort(key=_order)
                        del mine[k:]
        if arrow is not None:
            tags = [tag for (tag, _, _), mine in zip(questions, best, strict=True) for _ in mine]
            found = [hit for mine in best for hit in mine]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tags, pa.int64()), pa.array([key for _, key in found], arrow), pa.array([score for score, _ in found], pa.int64())],
                names=["_tag", "_key", "score"],
            )

    wanted = index.select("keys", "lengths", "terms", "holding", "places", "counts")
    return wanted.mapInArrow(search, f"_tag long, _key {kind.simpleString()}, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", block_pairs: int = BLOCK_PAIRS, segment_bytes: int = SEGMENT_BYTES, **how,
) -> DataFrame:
    """``item_key``, rank, ``key``, score: every item's k best documents, highest score first; ``how`` goes to ``Segment.best``."""
    spark = docs.sparkSession
    asked = item_terms(items, item_key, item_text)
    schema = T.StructType([T.StructField("_tag", T.LongType()), T.StructField("_key", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    path = scratch_path(spark, "ranked")
    spark.createDataFrame([], schema).write.parquet(path)
    blocks = -(-asked.count() // block_pairs)
    for number in range(blocks):
        block = Block(asked.where(F.pmod(F.xxhash64("tag"), F.lit(blocks)) == number).collect())
        if block.items:
            index = materialise(build(docs, block.hashes, key, text, segment_bytes), "postings")
            stats = Statistics(index, len(block.hashes))
            if stats.docs:
                answers(index, block, stats, k, **how).write.mode("append").parquet(path)
    order = [F.desc("score"), F.asc_nulls_last("_key")]
    found = spark.read.schema(schema).parquet(path).withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)))
    for by in (["_tag", "_salt"], ["_tag"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    names = asked.select(F.col("tag").alias("_tag"), F.col("item").alias("_item")).distinct()
    return found.join(names, "_tag").select(F.col("_item").alias(item_key), "rank", F.col("_key").alias(key), "score")
