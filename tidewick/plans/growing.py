"""Random forests of all series grown at once: no loop over series, forests or trees on the driver.

Features are binned once per series (``BINS`` bins between approximate quantiles) and stored as blocks of bytes.  Every
random choice is a hash: how often a tree draws a row, of the seed, tree and row; which features a node may split on, of the
seed, tree and node.  Counts in histograms are whole numbers.  A tree is therefore the same wherever and in whatever pieces
it is grown, and

* a forest of fewer trees is a prefix of a larger one, a shallower forest is a deeper one cut at that depth, so that all
  candidates of a search that share a number of features share one forest;
* a series of up to ``local_rows`` rows grows its trees in tasks of ``TREES`` trees each;
* a longer series is grown level by level: every task sums histograms by (series, forest, tree, node) over its blocks,
  they are added up, the best split of each node is decided, and the next level routes the rows through all splits so
  far.  Nodes of up to ``local_rows`` rows leave the levels; their rows meet in one task per node, which
  grows the rest below.  The loop has at most as many rounds as the trees have levels.

Splits lower Gini's impurity, ties go to the lowest feature, then the lowest bin; a node without gain, of one class or at
the greatest depth is a leaf.  Every node keeps the class counts of its rows.
"""

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.session import join_small, materialise, scratch_path

BINS = 32
BLOCK_ROWS = 65_536
LOCAL_ROWS = 65_536
TREES = 25
CELLS = 1 << 21  # histogram cells handled at once


class Growth(NamedTuple):
    """What the trees of a forest have in common."""

    n_features: int
    classes: int
    depth: int
    seed: int = 42


class Nodes(NamedTuple):
    """Nodes of trees: ``feature`` -1 is a leaf; rows whose bin is at most ``bin`` go to 2 * node, others to 2 * node + 1."""

    tree: np.ndarray
    node: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    votes: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _hashed(seed: int, *parts: np.ndarray) -> np.ndarray:
    out = np.uint64(seed)
    with np.errstate(over="ignore"):
        for part in parts:
            out = _mixed(out * np.uint64(31) + part.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return out


# how often a bootstrap draws a row: Poisson's distribution of mean 1
_DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def bootstrap(seed: int, trees: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How often each tree draws each row, rows named by numbers."""
    share = (_hashed(seed, trees[:, None], rows[None, :]) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.searchsorted(_DRAWS, share, "right").astype(np.uint8)


def sampled(seed: int, tree: np.ndarray, node: np.ndarray, n_features: int, k: int) -> np.ndarray:
    """The ``k`` features that each node may split on, ascending."""
    if k >= n_features:
        return np.broadcast_to(np.arange(n_features), (len(node), n_features))
    order = _hashed(seed + 1, tree[:, None], node[:, None], np.arange(n_features)[None, :])
    return np.sort(np.argpartition(order, k - 1, axis=1)[:, :k], axis=1)


def histograms(bins: np.ndarray, labels: np.ndarray, rows: np.ndarray, weight: np.ndarray, slot: np.ndarray, features: np.ndarray, classes: int) -> np.ndarray:
    """Drawn rows by (class, node, feature, bin); ``slot`` is the node of each drawn row, ``features`` those of each node."""
    n, k = features.shape
    cell = (slot[:, None] * k + np.arange(k)) * BINS + bins[rows[:, None], features[slot]]
    cell += (labels[rows].astype(np.int64) * (n * k * BINS))[:, None]
    return np.bincount(cell.ravel(), np.repeat(weight, k), classes * n * k * BINS).reshape(classes, n, k, BINS)


def decide(counts: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best (feature, bin) of each node by its histograms; feature -1 where no split lowers the impurity."""
    classes, n, k, _ = counts.shape
    left = counts.cumsum(axis=3)
    total = left[:, :, :1, -1:]
    right = total - left
    n_left, n_right = left.sum(axis=0), right.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        worth = (left * left).sum(axis=0) / n_left + (right * right).sum(axis=0) / n_right
    worth[(n_left == 0) | (n_right == 0)] = -1
    worth = worth.reshape(n, -1)
    best = worth.argmax(axis=1)
    whole = total.sum(axis=0)[:, 0, 0]
    before = (total * total).sum(axis=0)[:, 0, 0] / np.maximum(whole, 1)
    gain = worth[np.arange(n), best] > before * (1 + 1e-12)
    return np.where(gain, features[np.arange(n), best // BINS], -1), best % BINS


def grow(bins: np.ndarray, labels: np.ndarray, weight: np.ndarray, tree: np.ndarray, node: np.ndarray, k: int, how: Growth) -> Nodes:
    """The trees below the given nodes (one per row of ``weight``, all at one depth), level by level."""
    slot, rows = np.nonzero(weight)
    drawn = weight[slot, rows].astype(float)
    level = int(node[0]).bit_length() - 1
    out = []
    while len(tree):
        n = len(tree)
        votes = np.bincount(slot * how.classes + labels[rows], drawn, n * how.classes).reshape(n, how.classes)
        feature, cut = np.full(n, -1), np.zeros(n, np.int64)
        total = votes.sum(axis=1)
        splittable = np.flatnonzero((votes.max(axis=1) < total) & (level < how.depth))
        size = np.bincount(slot, minlength=n)[splittable]
        most = max(1, CELLS // (k * BINS * how.classes))
        at = 0
        while at < len(splittable):
            # as many nodes as their histograms and rows allow
            to = min(at + most, at + max(1, int(np.searchsorted(np.cumsum(size[at : at + most]), CELLS // k, "right"))))
            mine = splittable[at:to]
            a, b = np.searchsorted(slot, (mine[0], mine[-1] + 1))
            place = np.searchsorted(mine, slot[a:b])
            here = mine[np.minimum(place, len(mine) - 1)] == slot[a:b]
            features = sampled(how.seed, tree[mine], node[mine], how.n_features, k)
            counts = histograms(bins, labels, rows[a:b][here], drawn[a:b][here], place[here], features, how.classes)
            feature[mine], cut[mine] = decide(counts, features)
            at = to
        out.append(Nodes(tree, node, feature, cut, votes))
        split = feature >= 0
        keep = split[slot]
        slot, rows, drawn = slot[keep], rows[keep], drawn[keep]
        right = bins[rows, feature[slot]] > cut[slot]
        slot = 2 * (np.cumsum(split) - 1)[slot] + right
        order = np.argsort(slot, kind="stable")
        slot, rows, drawn = slot[order], rows[order], drawn[order]
        tree = np.repeat(tree[split], 2)
        node = np.repeat(2 * node[split], 2) + np.tile([0, 1], int(split.sum()))
        level += 1
    return Nodes(*(np.concatenate(x) for x in zip(*out, strict=True)))


# --- the same on DataFrames ------------------------------------------------------------------

PIECE = ["node", "left", "right", "feature", "cut", "votes"]
_PIECE_TYPES = {
    "subset": "int", "tree": "int", "node": "array<long>", "left": "array<long>", "right": "array<long>",
    "feature": "array<int>", "cut": "array<double>", "votes": "array<double>",
}
_PIECE_ARROW = [pa.int32(), pa.int32(), *[pa.list_(t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64())]]


def _schema(rows: DataFrame, keys: Sequence[str], others: Mapping[str, str]) -> T.StructType:
    fields = T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in others.items())).fields
    return T.StructType([*[rows.schema[k] for k in keys], *fields])


def packed_schema(rows: DataFrame, keys: Sequence[str], others: Mapping[str, str]) -> T.StructType:
    """The columns of packed forests, and ``others``."""
    return _schema(rows, keys, {**_PIECE_TYPES, **others})


def _key_arrays(values: Sequence, types: Sequence[pa.DataType], n: int) -> list[pa.Array]:
    return [pa.array([v] * n, t) for v, t in zip(values, types, strict=True)]


def thresholds(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_cuts`` of every series: for each place in ``_x`` the values between its bins, by a mergeable quantile sketch."""
    shares = [i / BINS for i in range(1, BINS)]
    each = values.select(*keys, F.posexplode("_x").alias("_f", "_v")).groupBy(*keys, "_f").agg(F.percentile_approx("_v", shares, 5000).alias("_cut"))
    return each.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_f", "_cut"))).getField("_cut").alias("_cuts"))


def _binned(left: pa.Table, right: pa.Table, keys: Sequence[str]) -> pa.Table:
    """One block: row numbers, labels and bins as bytes, and the cuts (padded with infinity)."""
    n = left.num_rows
    found = right.column("_cuts")[0].as_py() if right.num_rows else []
    x = left.column("_x").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(n, -1)
    cuts = np.full((len(found), BINS - 1), np.inf)
    bins = np.zeros(x.shape, np.uint8)
    for f, mine in enumerate(found):
        mine = np.unique(mine or [])
        cuts[f, : len(mine)] = mine
        bins[:, f] = np.searchsorted(mine, x[:, f], "left")
    return pa.table({
        **{k: left.column(k).slice(0, 1) for k in [*keys, "_chunk"]}, "n": pa.array([n], pa.int64()),
        "rows": [left.column("_row").to_numpy().astype(np.int64).tobytes()], "labels": [left.column("_label").to_numpy().astype(np.uint8).tobytes()],
        "bins": [bins.tobytes()], "cuts": [cuts.tobytes()],
    })


def blocks(train: DataFrame, keys: Sequence[str], features: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The training rows (``timestamp``, ``period``, ``label`` 0, 1, ..) in blocks of bytes, stored."""
    keys = list(keys)
    d = train.select(
        *keys, F.expr(f"timestamp div (period * {block_rows}L)").alias("_chunk"), F.col("timestamp").alias("_row"), F.col("label").cast("int").alias("_label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("_x"),
    )
    # one row of cuts for each block
    by = [*keys, "_chunk"]
    cuts = d.select(*by).distinct().join(thresholds(d, keys), keys)
    cuts = cuts.select(*[F.col(c).alias(f"_own_{c}") for c in by], "_cuts")
    schema = _schema(train, keys, {"_chunk": "long", "n": "long", "rows": "binary", "labels": "binary", "bins": "binary", "cuts": "binary"})
    found = d.groupBy(*by).cogroup(cuts.groupBy(*[f"_own_{c}" for c in by])).applyInArrow(lambda a, b: _binned(a, b, keys), schema)
    return materialise(found, "blocks")


class _Rows(NamedTuple):
    """The rows of one or more blocks."""

    rows: np.ndarray
    labels: np.ndarray
    bins: np.ndarray
    cuts: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, at: Sequence[int], n_features: int) -> "_Rows":
        def read(name, kind):
            return np.concatenate([np.frombuffer(table.column(name)[i].as_py(), kind) for i in at])

        cuts = np.frombuffer(table.column("cuts")[at[0]].as_py(), float).reshape(n_features, BINS - 1)
        return cls(read("rows", np.int64), read("labels", np.uint8), read("bins", np.uint8).reshape(-1, n_features), cuts)


def _pieces(values: Sequence, types: Sequence[pa.DataType], names: Sequence[str], subset: int, grown: Nodes, cuts: np.ndarray) -> pa.Table:
    """Grown nodes as one row per tree."""
    order = np.argsort(grown.tree, kind="stable")
    grown = Nodes(*(x[order] for x in grown))
    trees, first = np.unique(grown.tree, return_index=True)
    ends = [*first[1:].tolist(), len(order)]
    inner = grown.feature >= 0
    columns = [
        grown.node, np.where(inner, 2 * grown.node, -1), np.where(inner, 2 * grown.node + 1, -1), grown.feature,
        np.where(inner, cuts[np.maximum(grown.feature, 0), np.minimum(grown.bin, BINS - 2)], 0.0), grown.votes,
    ]
    lists = [[c[a:b].ravel() for a, b in zip(first, ends, strict=True)] for c in columns]
    arrays = [*_key_arrays(values, types, len(trees)), pa.array([subset] * len(trees)), pa.array(trees), *map(pa.array, lists)]
    arrays = [a.cast(t) for a, t in zip(arrays, [*types, *_PIECE_ARROW], strict=True)]
    return pa.table(arrays, names=[*names, "subset", "tree", *PIECE])


def _grow_series(small: DataFrame, keys: list[str], subsets: Sequence[int], trees: int, how: Growth) -> DataFrame:
    """Whole trees of short series: one group per series, forest and ``TREES`` trees."""
    units = [F.struct(F.lit(k).alias("subset"), F.lit(first).alias("first")) for k in subsets for first in range(0, trees, TREES)]
    d = small.withColumn("_unit", F.explode(F.array(*units))).select("*", "_unit.subset", "_unit.first").drop("_unit")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        *values, subset, first = (v.as_py() for v in key)
        mine = _Rows.of(table, range(table.num_rows), how.n_features)
        numbers = np.arange(first, min(first + TREES, trees))
        grown = grow(mine.bins, mine.labels, bootstrap(how.seed, numbers, mine.rows), numbers, np.ones(len(numbers), np.int64), min(subset, how.n_features), how)
        return _pieces(values, [table.schema.field(k).type for k in keys], keys, subset, grown, mine.cuts)

    return d.groupBy(*keys, "subset", "first").applyInArrow(run, _schema(small, keys, _PIECE_TYPES))


class _Splits:
    """The splits of one forest so far, and where rows stand below them."""

    def __init__(self, found: Sequence[dict], how: Growth):
        self.how = how
        found = sorted(found, key=lambda s: (s["tree"], s["node"]))
        columns = ("tree", "node", "feature", "bin", "n_left", "n_right")
        self.tree, self.node, self.feature, self.bin, self.n_left, self.n_right = (np.array([s[c] for s in found], np.int64) for c in columns)
        self.names = self.tree << 32 | self.node

    def _at(self, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The split of each node, -1 where there is none."""
        if not len(self.names):
            return np.full(len(node), -1)
        name = tree << 32 | node
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where(self.names[at] == name, at, -1)

    def stand(self, mine: _Rows, trees: np.ndarray) -> tuple[np.ndarray, ...]:
        """(tree, row, draws, node, size) of every drawn row that has not reached a leaf; size is its node's, -1 at the root."""
        weight = bootstrap(self.how.seed, trees, mine.rows)
        which, rows = np.nonzero(weight)
        tree, drawn = trees[which], weight[which, rows]
        node, size, leaf = np.ones(len(rows), np.int64), np.full(len(rows), -1), np.zeros(len(rows), bool)
        moving = np.arange(len(rows))
        while len(moving):
            at = self._at(tree[moving], node[moving])
            moving, at = moving[at >= 0], at[at >= 0]
            inner = self.feature[at] >= 0
            leaf[moving[~inner]] = True
            moving, at = moving[inner], at[inner]
            right = mine.bins[rows[moving], self.feature[at]] > self.bin[at]
            node[moving] = 2 * node[moving] + right
            size[moving] = np.where(right, self.n_right[at], self.n_left[at])
        return tuple(x[~leaf] for x in (tree, rows, drawn, node, size))


_SPLIT_TYPES = {
    "subset": "int", "tree": "int", "node": "long", "feature": "int", "bin": "int", "n_left": "long", "n_right": "long", "votes": "array<double>",
}


def _with_splits(large: DataFrame, keys: list[str], splits: DataFrame | None) -> DataFrame:
    if splits is None:
        return large.withColumn("_splits", F.lit(None).cast("array<struct<subset:int,tree:int,node:long,feature:int,bin:int,n_left:long,n_right:long>>"))
    packed = splits.groupBy(*keys).agg(F.collect_list(F.struct(*[c for c in _SPLIT_TYPES if c != "votes"])).alias("_splits"))
    return join_small(large, packed, keys, "left", salt_by="_chunk")


def _frontier(batch: pa.RecordBatch, i: int, subsets: Sequence[int], trees: int, how: Growth) -> Iterator[tuple]:
    """For each forest and ``TREES`` trees, where the rows of a block stand."""
    mine = _Rows.of(batch, [i], how.n_features)
    found = batch.column("_splits")[i].as_py() or []
    for subset in subsets:
        splits = _Splits([s for s in found if s["subset"] == subset], how)
        for first in range(0, trees, TREES):
            yield mine, subset, splits.stand(mine, np.arange(first, min(first + TREES, trees)))


def _level(large: DataFrame, keys: list[str], splits: DataFrame | None, subsets: Sequence[int], trees: int, how: Growth, local_rows: int) -> DataFrame:
    """Decisions on all open nodes of long series: their histograms summed within tasks, then by node."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            names = list(zip(*sums, strict=True))
            arrays = [*[pa.array(list(v), t) for v, t in zip(names, types, strict=True)], pa.array([s.tobytes() for s in sums.values()], pa.binary())]
            sums.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*keys, "subset", "tree", "node", "counts"])

        for batch in batches:
            types = [*[batch.schema.field(k).type for k in keys], pa.int32(), pa.int32(), pa.int64()]
            for i in range(batch.num_rows):
                values = tuple(batch.column(k)[i].as_py() for k in keys)
                for mine, subset, (tree, rows, drawn, node, size) in _frontier(batch, i, subsets, trees, how):
                    is_open = (size < 0) | (size > local_rows)
                    names, slot = np.unique(tree[is_open] << 32 | node[is_open], return_inverse=True)
                    if not len(names):
                        continue
                    k = min(subset, how.n_features)
                    features = sampled(how.seed, names >> 32, names & 0xFFFFFFFF, how.n_features, k)
                    rows, drawn = rows[is_open], drawn[is_open].astype(float)
                    order = np.argsort(slot, kind="stable")
                    for one in np.split(order, np.flatnonzero(np.diff(slot[order])) + 1):
                        at = slot[one[0]]
                        counts = histograms(mine.bins, mine.labels, rows[one], drawn[one], np.zeros(len(one), np.int64), features[at : at + 1], how.classes)
                        name = (*values, subset, int(names[at] >> 32), int(names[at] & 0xFFFFFFFF))
                        sums[name] = sums[name] + counts if name in sums else counts
                    if len(sums) * how.classes * k * BINS > 16 * CELLS:
                        yield flush()
            if sums:
                yield flush()

    def decided(key: tuple, table: pa.Table) -> pa.Table:
        *values, subset, tree, node = (v.as_py() for v in key)
        k = min(subset, how.n_features)
        counts = sum(np.frombuffer(c.as_py(), float) for c in table.column("counts")).reshape(how.classes, 1, k, BINS)
        votes = counts[:, 0, 0].sum(axis=1)
        features = sampled(how.seed, np.array([tree]), np.array([node]), how.n_features, k)
        feature, cut = decide(counts, features) if int(node).bit_length() - 1 < how.depth else (np.array([-1]), np.array([0]))
        n_left = 0
        if feature[0] >= 0:
            n_left = int(counts[:, 0, int(np.searchsorted(features[0], feature[0])), : cut[0] + 1].sum())
        types = [table.schema.field(c).type for c in keys]
        others = [subset, tree, node, int(feature[0]), int(cut[0]), n_left, int(votes.sum()) - n_left]
        arrow = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array([v], t) for v, t in zip([*values, *others], [*types, *arrow], strict=True)]
        return pa.table([*arrays, pa.array([votes.tolist()], pa.list_(pa.float64()))], names=[*keys, *_SPLIT_TYPES])

    by = [*keys, "subset", "tree", "node"]
    summed = _with_splits(large, keys, splits).mapInArrow(partial, _schema(large, keys, {"subset": "int", "tree": "int", "node": "long", "counts": "binary"}))
    return summed.groupBy(*by).applyInArrow(decided, _schema(large, keys, _SPLIT_TYPES))


def _below(large: DataFrame, keys: list[str], splits: DataFrame, subsets: Sequence[int], trees: int, how: Growth) -> DataFrame:
    """Subtrees below the levels: the rows of a node meet in one task, at most ``local_rows`` of them."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            for i in range(batch.num_rows):
                values = [batch.column(k)[i].as_py() for k in keys]
                cuts = batch.column("cuts")[i].as_py()
                for mine, subset, (tree, rows, drawn, node, _) in _frontier(batch, i, subsets, trees, how):
                    name = tree << 32 | node
                    order = np.argsort(name, kind="stable")
                    for one in np.split(order, np.flatnonzero(np.diff(name[order])) + 1) if len(order) else []:
                        data = [drawn[one], mine.labels[rows[one]], mine.bins[rows[one]]]
                        yield pa.RecordBatch.from_arrays(
                            [*_key_arrays(values, types, 1), pa.array([subset], pa.int32()), pa.array([int(tree[one[0]])], pa.int32()), pa.array([int(node[one[0]])]),
                             *[pa.array([x.tobytes()], pa.binary()) for x in data], pa.array([cuts], pa.binary())],
                            names=[*keys, "subset", "tree", "node", "drawn", "labels", "bins", "cuts"],
                        )

    def run(key: tuple, table: pa.Table) -> pa.Table:
        *values, subset, tree, node = (v.as_py() for v in key)
        drawn, labels, bins = (np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column(c)]) for c in ("drawn", "labels", "bins"))
        cuts = np.frombuffer(table.column("cuts")[0].as_py(), float).reshape(how.n_features, BINS - 1)
        grown = grow(bins.reshape(-1, how.n_features), labels, drawn[None, :], np.array([tree]), np.array([node]), min(subset, how.n_features), how)
        return _pieces(values, [table.schema.field(k).type for k in keys], keys, subset, grown, cuts)

    kinds = {"subset": "int", "tree": "int", "node": "long", "drawn": "binary", "labels": "binary", "bins": "binary", "cuts": "binary"}
    rows = _with_splits(large, keys, splits).mapInArrow(spread, _schema(large, keys, kinds))
    return rows.groupBy(*keys, "subset", "tree", "node").applyInArrow(run, _schema(large, keys, _PIECE_TYPES))


def _grow_levels(large: DataFrame, keys: list[str], subsets: Sequence[int], trees: int, how: Growth, local_rows: int) -> DataFrame:
    """Trees of long series: levels of summed histograms, then the subtrees of small nodes."""
    spark, path, splits = large.sparkSession, scratch_path(large.sparkSession, "levels"), None
    schema = _schema(large, keys, _SPLIT_TYPES)
    for level in range(how.depth + 1):
        _level(large, keys, splits, subsets, trees, how, local_rows).write.parquet(f"{path}/level={level}")
        splits = spark.read.schema(schema).parquet(*[f"{path}/level={n}" for n in range(level + 1)])
        newest = spark.read.schema(schema).parquet(f"{path}/level={level}")
        if not newest.where((F.col("feature") >= 0) & (F.greatest("n_left", "n_right") > local_rows)).take(1):
            break
    # the cuts of a series as an array, to name the values of its splits
    one = large.select(*keys, "cuts").groupBy(*keys).agg(F.first("cuts").alias("cuts"))
    inner = F.col("feature") >= 0
    flat = splits.join(one, keys).mapInArrow(lambda b: _named_cuts(b, how), T.StructType([*schema.fields, T.StructField("cut", T.DoubleType())]))
    top = flat.select(
        *keys, "subset", "tree", F.array("node").alias("node"),
        *[F.array(F.when(inner, 2 * F.col("node") + side).otherwise(F.lit(-1))).cast("array<long>").alias(name) for side, name in ((0, "left"), (1, "right"))],
        F.array("feature").alias("feature"), F.array("cut").alias("cut"), "votes",
    )
    return top.unionByName(_below(large, keys, splits, subsets, trees, how))


def _named_cuts(batches: Iterator[pa.RecordBatch], how: Growth) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        feature, cut = batch.column("feature").to_numpy(), batch.column("bin").to_numpy()
        values = [
            float(np.frombuffer(c.as_py(), float).reshape(how.n_features, BINS - 1)[f, min(b, BINS - 2)]) if f >= 0 else 0.0
            for c, f, b in zip(batch.column("cuts"), feature.tolist(), cut.tolist(), strict=True)
        ]
        names = [n for n in batch.schema.names if n != "cuts"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(values, pa.float64())], names=[*names, "cut"])


def grow_forests(
    train: DataFrame, keys: Sequence[str], features: Sequence[str], classes: int, subsets: Sequence[int], trees: int, depth: int,
    seed: int = 42, block_rows: int = BLOCK_ROWS, local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """Forests of every series, one for each number of features a node may split on (``subsets``).

    ``train`` has ``timestamp``, ``period`` and ``label`` (0 to classes - 1) beside keys and features.  The result has one or more
    rows per tree: keys, subset, tree, and arrays node, left, right (-1: none), feature (-1: leaf), cut (rows up to it
    go left) and votes (class counts, ``classes`` a node).
    """
    keys, subsets = list(keys), sorted(set(subsets))
    how = Growth(len(features), classes, depth, seed)
    stored = blocks(train, keys, features, block_rows)
    sizes = stored.groupBy(*keys).agg(F.sum("n").alias("_size"))
    sized = join_small(stored, sizes, keys, salt_by="_chunk")
    short = F.col("_size") <= local_rows
    grown = _grow_series(sized.where(short).drop("_size"), keys, subsets, trees, how)
    if sizes.where(~short).take(1):
        grown = grown.unionByName(_grow_levels(sized.where(~short).drop("_size"), keys, subsets, trees, how, local_rows))
    return grown
