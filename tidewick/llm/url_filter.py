"""URL verdicts: host and path rules, and a character language-model ratio for every URL without a rule.

Two variable-order Markov models over bytes, one of the URLs that a rule allows and one of those it blocks, give each
URL a log-likelihood difference per character.  Orders 0 to ``ORDERS - 1`` are smoothed into each other (each order
backs off to the one below with weight ``ALPHA``).  Contexts and characters are counted exactly, each by a number of its
own, so the counts are a stored table that grows with the URLs; neither the driver nor a task holds it whole.  Pages are
scored in chunks of ``CHUNK`` rows, which ask for the counts of their own contexts, each once, so that a context that
all URLs share is asked for once a chunk.  The threshold is fitted on a fifth of the labelled URLs that the models have not seen.

Defined results: a null URL or one without ``://`` has empty host and path, and the model judges its whole text (null:
empty, difference 0).  Differences at the threshold are allowed.  Without labelled URLs of both kinds all differences
are 0 and the verdict is ``allow``.  Repeated rows give repeated results; only the key and URL columns are read.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewick.llm import texts
from tidewick.session import materialise

ORDERS = 6
CHUNK = 2048
SLICE = 1 << 18  # bytes counted at a time
ALPHA = 2.0
BINS = 2048
SPAN = 8.0  # differences per character beyond +-SPAN count as SPAN for the threshold

# (verdict, host, path)
Rule = tuple[str, str, str]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    out = None
    for verdict, name, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        value = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(context, context and character)`` as numbers per order and position, of shape (ORDERS, bytes).

    A context is the up to ``order`` bytes before a position in its own URL; order 0 has one.
    """
    n = len(data)
    row_start = np.repeat(offsets[:-1], np.diff(offsets))
    place = np.arange(n)
    context = np.zeros(n, np.int64)
    ctx, chars = np.zeros((ORDERS, n), np.int64), np.zeros((ORDERS, n), np.int64)
    for order in range(ORDERS):
        if order:
            at = place - order
            context = context * 257 + np.where(at >= row_start, data[np.maximum(at, 0)].astype(np.int64) + 1, 0)
        ctx[order] = context
        chars[order] = context * 256 + data
    return ctx, chars


def keys_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One number per kind (context, context and character), order and position, of shape (2, ORDERS, bytes)."""
    return (np.stack(cells(data, offsets)) * ORDERS + np.arange(ORDERS)[None, :, None]) * 2 + np.arange(2)[:, None, None]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each slice of URLs: ``(key, allowed, blocked)``."""
    for batch in batches:
        blocked = np.asarray(batch.column(1).to_pylist(), bool)
        for i, n, data, offsets in texts.slices(batch.column(0), SLICE):
            label = np.repeat(blocked[i : i + n], np.diff(offsets))
            key, at = np.unique(keys_of(data, offsets), return_inverse=True)
            at = at.reshape(2 * ORDERS, -1)
            both = [np.bincount(at[:, label == c].ravel(), minlength=len(key)) for c in (False, True)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, *both)], names=["key", "allowed", "blocked"])


class Model:
    """The counts (key, allowed, blocked) as a stored table."""

    def __init__(self, counts: DataFrame):
        self.counts = counts

    @cached_property
    def _held(self) -> dict[tuple[int, int, int], Counter]:
        out = defaultdict(Counter)
        for key, *both in self.counts.collect():
            for c in (0, 1):
                out[c, key % 2, key // 2 % ORDERS][key // 2 // ORDERS] = both[c]
        return out

    def __getitem__(self, place: tuple[int, int, int]) -> Counter:
        """Counts by cell of (class, kind, order); reads the whole table, for small models only."""
        return self._held[place]


def difference(data: np.ndarray, offsets: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per URL, log p(accepted) - log p(rejected) over its characters, divided by their number (0 without any).

    ``known`` are sorted keys, ``counts`` their counts per class; other keys have none.
    """
    keys = keys_of(data, offsets)
    p = np.full((2, len(data)), 1 / 256)
    for order in range(ORDERS):
        n = []
        for kind in (0, 1):
            at = np.minimum(np.searchsorted(known, keys[kind, order]), max(len(known) - 1, 0))
            n.append(np.where(known[at] == keys[kind, order], counts[:, at], 0) if len(known) else np.zeros(p.shape))
        p = (n[1] + ALPHA * p) / (n[0] + ALPHA)
    logs = np.log(p)
    sums = np.concatenate([[0.0], np.cumsum(logs[0] - logs[1])])
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def train(labelled: DataFrame) -> Model:
    """Counts from ``labelled`` (url, blocked); without URLs of both kinds there are none."""
    partial = labelled.select("url", "blocked").mapInArrow(_counts, "key long, allowed long, blocked long")
    counts = materialise(partial.groupBy("key").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")), "counts")
    # key 0 is the empty context, whose counts are all characters
    whole = counts.where(F.col("key") == 0).first()
    if whole is None or not whole.allowed or not whole.blocked:
        counts = counts.limit(0)
    return Model(counts)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``(_chunk, url)``, rows of a chunk together: the keys of each chunk, once for each slice."""
    for batch in batches:
        chunk = batch.column(0).to_numpy()
        for i, n, data, offsets in texts.slices(batch.column(1), SLICE):
            mine = chunk[i : i + n]
            cuts = [0, *(np.flatnonzero(mine[1:] != mine[:-1]) + 1).tolist(), n]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = np.unique(keys_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), mine[a])), pa.array(key)], names=["_chunk", "key"])


def with_difference(rows: DataFrame, url: str, out: str, model: Model) -> DataFrame:
    """``rows`` and the column ``out``."""
    names = rows.columns
    stored = materialise(rows.withColumn("_chunk", F.floor(F.monotonically_increasing_id() / CHUNK)), "chunks")
    schema = rows.select("*", F.lit(0.0).alias(out)).schema
    wanted = stored.select("_chunk", url).mapInArrow(_wanted, "_chunk long, key long")
    # Spark takes the keys for as small as the URLs they are made of, and would gather them in the driver to broadcast them
    wanted = wanted.join(model.counts.hint("merge"), "key")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        known, one = np.unique(right.column("key").to_numpy(), return_index=True)
        counts = np.stack([right.column(c).to_numpy()[one] for c in ("allowed", "blocked")])
        parts = [difference(data, offsets, known, counts) for _, _, data, offsets in texts.slices(left.column(url), SLICE)]
        return left.select(names).append_column(out, pa.array(np.concatenate(parts) if parts else np.zeros(0)))

    return stored.groupBy("_chunk").cogroup(wanted.groupBy("_chunk")).applyInArrow(score, schema)


def threshold(scored: DataFrame) -> float:
    """The bin border with the fewest errors on ``scored`` (difference, blocked), both classes weighing the same."""
    place = F.floor((F.greatest(F.least("difference", F.lit(SPAN)), F.lit(-SPAN)) + SPAN) / (2 * SPAN) * (BINS - 1)).cast("int")
    hist = np.zeros((2, BINS))
    for blocked, at, n in scored.groupBy("blocked", place.alias("at")).count().collect():
        hist[int(blocked), at] = n
    if not hist[0].sum() or not hist[1].sum():
        return 0.0
    lost = np.concatenate([[0], np.cumsum(hist[0])]) / hist[0].sum()
    passed = 1 - np.concatenate([[0], np.cumsum(hist[1])]) / hist[1].sum()
    wrong = lost + passed
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float((best[0] + best[-1]) / 2) / (BINS - 1) * 2 * SPAN - SPAN


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: key, host, path, rule, verdict, difference, threshold."""
    clean = F.coalesce(F.col(url), F.lit(""))
    host, path = host_and_path(clean)
    rows = pages.select(F.col(key).alias("_key"), clean.alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.select("_key", "url", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("_given"))
    labelled = rows.where(F.col("rule").isNotNull()).select("url", (F.col("_given") == "block").alias("blocked"))
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    scored = materialise(with_difference(rows, "url", "difference", train(labelled.where(~held))), "scored")
    fitted_on = scored.where(F.col("rule").isNotNull() & held)
    least = threshold(fitted_on.select("difference", (F.col("_given") == "block").alias("blocked")))
    chosen = F.when(F.col("difference") >= least, "allow").otherwise("block")
    return scored.select(
        F.col("_key").alias(key), "host", "path", "rule", F.coalesce("_given", chosen).alias("verdict"), "difference",
        F.lit(least).alias("threshold"),
    )
