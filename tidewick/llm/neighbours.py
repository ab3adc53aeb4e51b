"""Approximate nearest neighbours by a few stable projections, a kd-tree, and a chi-square stopping test.

Vectors are projected on ``DIMS`` Gaussian directions.  For a neighbour at distance d the squared projected distance is d**2
times a chi-square variable of ``DIMS`` degrees, so once the next projected distance exceeds the ``CONFIDENCE`` quantile times
the squared k-th best distance so far, an unseen better neighbour has probability below 1 - ``CONFIDENCE``: stop.

The top of the kd-tree is built on a bounded sample of projections and cuts space into cells; every row is indexed,
cells above ``CELL_ROWS`` rows are dealt into chunks.  A query first visits its own cell; its k-th distance there bounds the
cells it must visit next, by the same test on the cells' boxes.  In a chunk, a kd-tree yields leaves in order of
projected distance until the test holds for a leaf's box; within a leaf the test is made row by row, and only rows that
it leaves open are verified with the true distance.

Of identical vectors the k + 1 smallest ids are enough for every answer, and only they are indexed; they are found in two
steps, by (vector, salt) and by vector.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers take no part; rows that repeat id and
vector count once; vectors of other lengths than the query's are no candidates; rows with a null id take no part.
A query gets min(k, candidates) rows.  Only the id and vector columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewick.session import materialise

DIMS = 24
CONFIDENCE = 0.93
CELL_ROWS = 8192
SAMPLE = 1 << 18  # rows that the driver reads: 50 MB, for up to 4,096 cells
LEAF = 32
QUERY_BLOCK = 1024
SALTS = 32
SEED = 5

FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, dims: int = DIMS) -> float:
    """Of an even number of degrees, by bisection of the closed form."""
    def cdf(x):
        term, total = 1.0, 0.0
        for i in range(dims // 2):
            term = term * (x / 2) / i if i else 1.0
            total += term
        return 1 - np.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def directions(length: int) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, DIMS))


class Tree:
    """A kd-tree over the rows of ``points``: leaves of at most ``leaf`` rows, and their boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        bounds, todo = [], [(0, len(points))] if len(points) else []
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                bounds.append((a, b))
                continue
            rows = self.order[a:b]
            mine = points[rows]
            dim = int(np.argmax(mine.max(axis=0) - mine.min(axis=0)))
            half = (b - a) // 2
            self.order[a:b] = rows[np.argpartition(mine[:, dim], half)]
            todo += [(a, a + half), (a + half, b)]
        bounds.sort()
        self.starts = np.array([a for a, _ in bounds], np.int64)
        self.ends = np.array([b for _, b in bounds], np.int64)
        self.points = points
        sorted_points = points[self.order]
        self.low = np.minimum.reduceat(sorted_points, self.starts) if len(bounds) else points[:0]
        self.high = np.maximum.reduceat(sorted_points, self.starts) if len(bounds) else points[:0]

    def leaves(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in order of their squared projected distance from ``at``, and the distances."""
        gap = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        square = (gap * gap).sum(axis=1)
        order = np.argsort(square, kind="stable")
        return order, square[order]


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, at: np.ndarray, query: np.ndarray, own: int, k: int, bound: float,
           quantile: float) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, distances)`` of at most k verified neighbours within ``bound``; ties to the smaller id."""
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    order, square = tree.leaves(at)
    step, i = 1, 0
    while i < len(order):
        limit = min(bound, best[k - 1] if len(best) >= k else np.inf)
        if square[i] > quantile * limit * limit:
            break
        chosen = order[i : i + step]
        rows = np.concatenate([tree.order[tree.starts[c] : tree.ends[c]] for c in chosen])
        gap = tree.points[rows] - at
        rows = rows[((gap * gap).sum(axis=1) <= quantile * limit * limit) & (ids[rows] != own)]
        apart = vectors[rows] - query
        distance = np.sqrt((apart * apart).sum(axis=1))
        fits = distance <= limit
        best_ids, best = np.concatenate([best_ids, ids[rows[fits]]]), np.concatenate([best, distance[fits]])
        nearest = np.lexsort((best_ids, best))[:k]
        best_ids, best = best_ids[nearest], best[nearest]
        i += step
        step = min(step * 2, 8)
    return best_ids, best


def valid_vectors(table: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``(id, dim, raw)`` of the vectors that take part; raw is little-endian doubles."""
    v = F.col("v")
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(
        F.col("id").isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    ).dropDuplicates(["id", "v"])
    query = F.pmod("id", F.lit(100)) == 0
    # a vector's k + 1 smallest ids: of each salt, then of those; the rest stays spread by salt
    salted = rows.withColumns({"salt": F.pmod(F.xxhash64("id"), F.lit(SALTS)), "same": F.sha2(F.array_join("v", ",").cast("binary"), 256)})
    near = F.row_number().over(Window.partitionBy("same", "salt").orderBy("id")) <= k + 1
    part = salted.withColumn("part", F.when(near, -1).otherwise(F.col("salt")))
    number = F.row_number().over(Window.partitionBy("same", "part").orderBy("id"))
    indexed = (F.col("part") < 0) & (number <= k + 1)
    return part.select("id", F.size("v").alias("dim"), "v", indexed.alias("indexed"), query.alias("asked"))


def projected(rows: DataFrame) -> DataFrame:
    """``rows`` (id, dim, v, indexed, asked) with p, the projections; v as bytes of doubles."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            raw, points = [None] * len(dims), np.zeros((len(dims), DIMS))
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                block = flat[(ends[mine] - dim)[:, None] + np.arange(dim)]
                points[mine] = block @ directions(int(dim))
                for r, x in zip(mine, block, strict=True):
                    raw[r] = x.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary()), *[pa.array(points[:, m]) for m in range(DIMS)],
                 batch.column(3), batch.column(4)],
                names=["id", "dim", "raw", *[f"p{m}" for m in range(DIMS)], "indexed", "asked"],
            )

    columns = ", ".join(f"p{m} double" for m in range(DIMS))
    return rows.select("id", "dim", "v", "indexed", "asked").mapInArrow(
        project, f"id long, dim int, raw binary, {columns}, indexed boolean, asked boolean"
    )


def top_cells(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimension and value per inner node of a complete binary tree with ``cells`` (a power of two) leaves."""
    dims, values = np.zeros(cells, np.int64), np.zeros(cells)
    parts = {1: np.arange(len(sample))}
    for node in range(1, cells):
        rows = parts.pop(node)
        mine = sample[rows]
        if len(rows):
            dims[node] = int(np.argmax(mine.max(axis=0) - mine.min(axis=0)))
            values[node] = float(np.median(mine[:, dims[node]]))
        right = mine[:, dims[node]] > values[node]
        parts[2 * node], parts[2 * node + 1] = rows[~right], rows[right]
    return dims, values


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(f"p{m}")).to_numpy() for m in range(DIMS)])


def nearest(table: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For every row whose id is divisible by 100, its k nearest others: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    stored = materialise(projected(valid_vectors(table, key, vector, k)), "vectors")
    points = stored.where("indexed")
    n = points.count()
    cells = 1
    while cells < min(SAMPLE // 64, -(-n // CELL_ROWS)):
        cells *= 2
    sample = points.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(SAMPLE).select(*[f"p{m}" for m in range(DIMS)]).toArrow()
    tops = spark.sparkContext.broadcast(top_cells(np.column_stack([sample.column(m).to_numpy() for m in range(DIMS)]), cells))

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, values = tops.value
        for batch in batches:
            at, node = _points(batch), np.ones(batch.num_rows, np.int64)
            while cells > 1 and len(node) and node[0] < cells:
                right = at[np.arange(len(at)), dims[node]] > values[node]
                node = 2 * node + right
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node % cells)], names=[*batch.schema.names, "cell"])

    schema = stored.select("*", F.lit(0).cast("long").alias("cell")).schema
    placed = materialise(stored.mapInArrow(to_cells, schema), "cells")
    indexed = placed.where("indexed")
    # at most SAMPLE / 64 cells: their sizes and boxes are small
    boxes = indexed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), *[f(f"p{m}").alias(f"{f.__name__}{m}") for f in (F.min, F.max) for m in range(DIMS)]
    ).toArrow()
    names = boxes.column("cell").to_numpy()
    low = np.column_stack([boxes.column(f"min{m}").to_numpy() for m in range(DIMS)])
    high = np.column_stack([boxes.column(f"max{m}").to_numpy() for m in range(DIMS)])
    chunks = np.ones(cells, np.int64)
    chunks[names] = -(-boxes.column("n").to_numpy() // CELL_ROWS)
    shape = spark.sparkContext.broadcast((names, low, high))
    quantile = chi_square_quantile(CONFIDENCE)
    columns = ["id", "dim", "raw", *[f"p{m}" for m in range(DIMS)]]
    per_cell = F.array(*[F.lit(int(c)) for c in chunks])
    size = F.element_at(per_cell, (F.col("cell") + 1).cast("int"))
    side = indexed.select(*columns, "cell", F.pmod(F.xxhash64("id", F.lit(SEED)), size).alias("chunk"))

    def visit(queries: DataFrame) -> DataFrame:
        """``queries``: the columns, bound, cell; each meets all chunks of its cell, in blocks of queries."""
        asked = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), size.cast("long") - 1)))
        counts = queries.groupBy("cell").count().collect()
        blocks = np.ones(cells, np.int64)
        for cell, count in counts:
            blocks[cell] = -(-count // QUERY_BLOCK)
        many = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), (F.col("cell") + 1).cast("int"))
        left = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(SEED + 1)), many))
        right = side.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), many.cast("long") - 1)))
        by = ["cell", "chunk", "block"]

        def meet(mine: pa.Table, there: pa.Table) -> pa.Table:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            if mine.num_rows and there.num_rows:
                dims = there.column("dim").to_numpy()
                for dim in np.unique(dims):
                    rows = there.filter(pa.array(dims == dim))
                    vectors = np.frombuffer(b"".join(rows.column("raw").to_pylist())).reshape(-1, dim)
                    ids, tree = rows.column("id").to_numpy(), Tree(_points(rows.combine_chunks().to_batches()[0]))
                    wanted = mine.filter(pa.array(mine.column("dim").to_numpy() == dim))
                    if not wanted.num_rows:
                        continue
                    at = _points(wanted.combine_chunks().to_batches()[0])
                    bound = wanted.column("bound").to_numpy()
                    for q, (own, raw) in enumerate(zip(wanted.column("id").to_pylist(), wanted.column("raw").to_pylist(), strict=True)):
                        found = search(tree, vectors, ids, at[q], np.frombuffer(raw), own, k, bound[q], quantile)
                        out.append((np.full(len(found[0]), own), *found))
            parts = [np.concatenate([np.zeros(0, t), *[x[c] for x in out]]) for c, t in enumerate((np.int64, np.int64, np.float64))]
            return pa.table({"query_id": parts[0].astype(np.int64), "vec_id": parts[1].astype(np.int64), "score": parts[2]})

        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, FOUND)

    asked = placed.where("asked").select(*columns, "cell")
    home = materialise(visit(asked.withColumn("bound", F.lit(float("inf")))), "home")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    bounds = ranked.select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    rest = asked.withColumnRenamed("cell", "home").join(bounds, "id", "left").withColumn(
        "bound", F.coalesce("bound", F.lit(float("inf")))
    )

    def other_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, low, high = shape.value
        for batch in batches:
            at = _points(batch)
            own = batch.column(batch.schema.get_field_index("home")).to_numpy()
            bound = batch.column(batch.schema.get_field_index("bound")).to_numpy()
            for q in range(batch.num_rows):
                gap = np.maximum(np.maximum(low - at[q], at[q] - high), 0)
                go = names[((gap * gap).sum(axis=1) <= quantile * bound[q] ** 2) & (names != own[q])]
                one = batch.take(pa.array(np.full(len(go), q)))
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array(go)], names=[*one.schema.names, "cell"])

    schema = rest.withColumn("cell", F.lit(0).cast("long")).schema
    visits = materialise(rest.mapInArrow(other_cells, schema), "visits").drop("home")
    found = home.unionByName(visit(visits))
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
