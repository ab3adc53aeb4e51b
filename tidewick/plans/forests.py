"""Scoring with many forests at once: rows meet the trees of their own series in one plan.

A packed forest is one or more rows of arrays per tree (see ``growing``): node, left, right, feature, cut, votes.  Rows
and forests are grouped by series and stretch of time, so a series of any length spreads over tasks, no plan has a branch
per model, and a forest is sent once per ``CHUNK_ROWS`` rows of its series.  Within a group the rows descend all trees
level by level, in numpy; a candidate that is a shallower or smaller forest stops at its depth and its number of trees.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 65_536
SLICE_ROWS = 1024
PACKED = ["subset", "tree", "node", "left", "right", "feature", "cut", "votes"]


class Candidate(NamedTuple):
    """A forest to score with: its number, its number of features a node, its depth and its trees (None: all there are)."""

    number: int = 0
    subset: int = 0
    depth: int | None = None
    trees: int | None = None


def forest_nodes(spark: SparkSession, paths: Mapping[tuple, str], keys: Sequence[str], key_types: Sequence[T.DataType]) -> DataFrame:
    """The saved pipelines (assembler, forest) of Spark ML as packed forests."""
    plain = lambda p: p.removeprefix("file:").replace("//", "/")
    schema = T.StructType([T.StructField("_model", T.StringType()), *map(T.StructField, keys, key_types)])
    names = spark.createDataFrame([(plain(p), *k) for k, p in paths.items()], schema)
    found = spark.read.parquet(*[f"{p}/stages/1_*/data" for p in paths.values()])
    model = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/stages/", 1), "^file:/+", "/")
    n = "nodeData"
    one = F.struct(
        F.col(f"{n}.id").cast("long").alias("node"),
        F.col(f"{n}.leftChild").cast("long").alias("left"),
        F.col(f"{n}.rightChild").cast("long").alias("right"),
        F.col(f"{n}.split.featureIndex").alias("feature"),
        F.coalesce(F.try_element_at(f"{n}.split.leftCategoriesOrThreshold", F.lit(1)), F.lit(0.0)).alias("cut"),
        F.col(f"{n}.impurityStats").alias("votes"),
    )
    trees = found.groupBy(model.alias("_model"), F.col("treeID").alias("tree")).agg(F.collect_list(one).alias("_nodes"))
    arrays = [F.col(f"_nodes.{c}").alias(c) for c in PACKED[2:-1]]
    packed = trees.select("_model", F.lit(0).alias("subset"), "tree", *arrays, F.flatten("_nodes.votes").alias("votes"))
    return packed.join(names, "_model").select(*keys, *PACKED)


class Forest:
    """The trees of one forest as flat arrays, children as places in them."""

    def __init__(self, packed: pa.Table):
        def flat(name):
            return packed.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)

        sizes = packed.column("node").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        tree, node = np.repeat(packed.column("tree").to_numpy(), sizes).astype(np.int64), flat("node")
        name = tree << 32 | node
        order = np.argsort(name, kind="stable")
        name, tree = name[order], tree[order]
        self.feature, self.cut = flat("feature")[order], flat("cut")[order]
        self.left, self.right = (np.searchsorted(name, tree << 32 | flat(side)[order]) for side in ("left", "right"))
        votes = flat("votes")
        votes = votes.reshape(len(order), -1)[order] if len(order) else votes.reshape(0, 1)
        self.shares = votes / np.maximum(votes.sum(axis=1, keepdims=True), 1e-300)
        self.roots = np.flatnonzero(np.diff(tree, prepend=-1))

    def votes(self, x: np.ndarray, depths: Sequence[int | None]) -> dict[int | None, np.ndarray]:
        """For each depth (None: whole trees) every tree's class shares for each row of ``x``: (trees, rows, classes)."""
        at = np.repeat(self.roots[:, None], len(x), axis=1)
        out, level = {}, 0
        while True:
            if level in depths:
                out[level] = self.shares[at]
            inner = self.feature[at] >= 0
            if not inner.any():
                break
            trees, rows = np.nonzero(inner)
            here = at[inner]
            at[inner] = np.where(x[rows, self.feature[here]] <= self.cut[here], self.left[here], self.right[here])
            level += 1
        whole = self.shares[at]
        return {d: out.get(d, whole) for d in depths}


def score(
    rows: DataFrame, forests: DataFrame, features: Sequence[str], keys: Sequence[str], keep: Sequence[str],
    candidates: Sequence[Candidate] = (Candidate(),),
) -> DataFrame:
    """``keys``, ``keep``, candidate, prediction and probability of every row and candidate whose series has the forest."""
    chunk = F.expr(f"timestamp div (period * {CHUNK_ROWS}L)")
    d = rows.select(*keys, *keep, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"), chunk.alias("_chunk"))
    by, own = [*keys, "_chunk"], [*[f"_own_{k}" for k in keys], "_own_chunk"]
    trees = forests.select(*[F.col(k).alias(f"_own_{k}") for k in keys], *PACKED)
    trees = d.select(*[F.col(a).alias(b) for a, b in zip(by, own, strict=True)]).distinct().join(trees, own[:-1])
    out = [*keys, *keep]
    schema = T.StructType([
        *[d.schema[c] for c in out],
        T.StructField("candidate", T.IntegerType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("probability", T.ArrayType(T.DoubleType())),
    ])
    candidates = list(candidates)
    subsets = sorted({c.subset for c in candidates})

    def group(mine: pa.Table, packed: pa.Table) -> pa.Table:
        found, parts = packed.column("subset").to_numpy(), []
        grown = {s: Forest(packed.filter(pa.array(found == s))) for s in subsets if (found == s).any()}
        for i in range(0, mine.num_rows if grown else 0, SLICE_ROWS):
            part = mine.slice(i, SLICE_ROWS)
            x = part.column("_x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            for subset, forest in grown.items():
                asked = [c for c in candidates if c.subset == subset]
                votes = forest.votes(x, list({c.depth for c in asked}))
                for c in asked:
                    raw = votes[c.depth][: c.trees].sum(axis=0)
                    share = raw / np.maximum(raw.sum(axis=1, keepdims=True), 1e-300)
                    ends = np.arange(0, share.size + 1, share.shape[1], dtype=np.int32)
                    parts.append(pa.table(
                        [*[part.column(k) for k in out], pa.array(np.full(len(x), c.number, np.int32)), pa.array(raw.argmax(axis=1).astype(float)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(share.ravel()))],
                        names=[*out, "candidate", "prediction", "probability"],
                    ))
        if not parts:
            types = [*[mine.schema.field(c).type for c in out], pa.int32(), pa.float64(), pa.list_(pa.float64())]
            return pa.table([pa.array([], t) for t in types], names=[*out, "candidate", "prediction", "probability"])
        return pa.concat_tables(parts)

    return d.groupBy(*by).cogroup(trees.groupBy(*own)).applyInArrow(group, schema)
