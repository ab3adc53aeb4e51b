"""Similarity groups of documents by the Jaccard similarity of their word n-gram sets, exactly, with signature trees.

Two documents link if 100 * intersection >= threshold * union of their sets of distinct shingles of ``width`` words; the
result is the connected components.  Both are arguments (``WIDTH`` and ``THRESHOLD`` unless given); a threshold must be
over 50.  Documents with equal sets are one class, known by a 64-bit fingerprint (shingles are known by 64-bit hashes).

Blocks.  All shingles have one global order (frequent ones last, then by hash).  Linked sets share one of their first
``n - ceil(threshold n) + 1`` shingles, so only classes that share such a shingle can link, and each shared one is a
block.  The frequent shingles are a bounded list from counts per task; which ones are on it changes the work, never the result.

Signature trees.  A class has a bitmap of its hashed shingles (at least 8 bits each); in a block, nodes hold the OR of
their children's bitmaps, the range of their sizes, and the most shingles that share bits.  A dual traversal
drops pairs of nodes whose largest possible overlap cannot reach the threshold, or whose sizes are too far apart, or that
are one component already; pairs of leaves that remain are compared as sets.

Two rounds keep large groups linear.  Round 1 takes the first ``EARLY`` shared blocks of each class and emits a spanning forest of
the pairs that the trees find likeliest; those that link become components.  Round 2 takes all blocks, cut into runs of
comparable sizes, that still hold two components, and all pairs between different components that cannot be ruled out.
A class carries its ``FIRSTS`` smallest shingles with such a block, and a pair that has a smaller one in common is left
to that block.  Runs of up to ``LEAF`` classes are single leaves, whose pairs meet their bitmaps once; larger ones
get trees.  Blocks of over ``BLOCK`` classes are split, in round 2 into pairs of parts, so that no task holds one
whole and no pair is lost.

Defined results: null, empty and white-space texts have an empty set and are their own component; a text with fewer than
``width`` words has its whole sequence as one shingle; texts may be of any length; repeated rows are classmates, one
row each; an empty table gives an empty result.  A component's id is its smallest key that is not null (null if there is none).
Only the key and text columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewick.llm import texts
from tidewick.llm.components import components
from tidewick.session import materialise

WIDTH, THRESHOLD = 4, 85
FREQUENT = 1 << 16  # shingles that come last in the order
SEEN = 4  # times in one task's share before a shingle is counted at all
COUNTED = 4_000_000  # shingles a task gathers before it counts
EARLY = 2
BLOCK = 2048
LEAF = 64
FIRSTS = 8
FANOUT = 8
FILTER_BITS = 1 << 23
PAIRS = 1 << 16  # compared at a time


def prefix_sizes(n: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    return n + (-threshold * n) // 100 + 1


def set_arrays(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one after another, and their numbers."""
    low = texts.lower_ascii(data)
    starts, ends, rows = texts.space_words(low, offsets)
    out, count = texts.shingles(texts.hash_spans(low, starts, ends), rows, len(offsets) - 1, width)
    bounds = np.concatenate([[0], np.cumsum(count)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][count > 0]] = True
    sizes = np.bincount(np.repeat(np.arange(len(count)), count)[fresh], minlength=len(count))
    return out[fresh], sizes


def fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit number per set, as signed; 0 sizes give 0."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    begin = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        if len(some):
            out[some] = np.add.reduceat(texts.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), begin[some])
        out[some] = texts.mix(out[some] + sizes[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out.view(np.int64)


def signature_bits(n: int) -> int:
    return max(64, 1 << (8 * n - 1).bit_length())


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    out, at = [], 0
    for n in sizes.tolist():
        if n == 0:
            out.append(b"")
            continue
        bits = np.zeros(signature_bits(n), np.uint8)
        bits[(hashes[at : at + n] & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
        out.append(np.packbits(bits, bitorder="little").tobytes())
        at += n
    return out


def repeated(parts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur ``least`` times at least in all ``parts``, ascending, and how often; empties ``parts``.

    They are sorted in place, so that there is one copy beside the parts, and none of the distinct numbers.
    """
    whole = np.concatenate([np.zeros(0, np.uint64), *parts])
    parts.clear()
    whole.sort()
    # the first of a run of equal numbers: its neighbour before differs, the one ``least - 1`` on does not
    n = max(len(whole) - least + 1, 0)
    long = whole[:n] == whole[len(whole) - n :]
    long[1:] &= whole[1:n] != whole[: max(n - 1, 0)]
    tokens = whole[:n][long]
    return tokens, np.searchsorted(whole, tokens, "right") - np.flatnonzero(long)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """From ``(_key, _text)``: a row per document (_key, n, fp, sig), and rows (seen, times) of repeated shingles."""
    names = ["_key", "n", "fp", "sig", "seen", "times"]
    held, known, total = [], set(), 0

    def counted(kind):
        tokens, times = repeated(held, SEEN)
        m = len(tokens)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
             pa.array(tokens.view(np.int64)), pa.array(times)], names=names,
        )

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for i, n, data, offsets in texts.slices(batch.column(1)):
            hashes, sizes = set_arrays(data, offsets, width)
            fp = fingerprints(hashes, sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, n), pa.array(sizes), pa.array(fp), pa.array(signatures(hashes, sizes), pa.binary()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names,
            )
            new = np.array([x not in known and not known.add(x) for x in fp.tolist()], bool)
            held.append(hashes[np.repeat(new, sizes)])
            total += len(held[-1])
            if total >= COUNTED:
                yield counted(kind)
                held, known, total = [], set(), 0
    if kind is not None:
        yield counted(kind)


def prefixes(
    hashes: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, screen: np.ndarray, threshold: int = THRESHOLD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(shingle, row, place)`` of each set's prefix; ``frequent`` is sorted, ``screen`` a bitmap of its top 24 bits."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    rare = ~screen[(hashes >> np.uint64(40)).astype(np.int64)]
    doubt = np.flatnonzero(~rare)
    if len(doubt):
        at = np.minimum(np.searchsorted(frequent, hashes[doubt]), len(frequent) - 1)
        rare[doubt] = frequent[at] != hashes[doubt]
    begin = np.cumsum(sizes) - sizes
    run = np.concatenate([[0], np.cumsum(rare)])
    rare_before = run[:-1] - run[begin[row]]
    rare_total = np.bincount(row[rare], minlength=len(sizes))
    place = np.where(rare, rare_before, rare_total[row] + np.arange(len(hashes)) - begin[row] - rare_before)
    chosen = place < prefix_sizes(sizes, threshold)[row]
    return hashes[chosen], row[chosen], place[chosen]


def _pair_ok(n_a: np.ndarray, n_b: np.ndarray, overlap: np.ndarray, threshold: int) -> np.ndarray:
    return 100 * overlap >= threshold * (n_a + n_b - overlap)


def _fold(bitmaps: np.ndarray) -> np.ndarray:
    half = bitmaps.shape[1] // 2
    return bitmaps[:, :half] | bitmaps[:, half:]


def _ones(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)


class SignatureTree:
    """Leaves are sets (bitmap, size); a node has its children's OR, range of sizes, most hidden shingles and components."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, roots: np.ndarray, rows: np.ndarray):
        order = np.lexsort(bitmaps.T[::-1])
        self.rows = rows[order]
        hidden = (sizes - _ones(bitmaps))[order]
        self.levels = [(bitmaps[order], sizes[order], sizes[order], hidden, roots[order], roots[order])]
        while len(self.levels[-1][0]) > FANOUT:
            bits, low, high, hidden, least, most = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.maximum.reduceat(hidden, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at),
            ))


def dual_traversal(
    one: SignatureTree, two: SignatureTree, threshold: int = THRESHOLD
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows (of ``one``, of ``two``) that may link and are of different components, and their largest possible
    similarity, some at a time.

    If both are the same tree each pair comes once.
    """
    same = one is two
    height = max(len(one.levels), len(two.levels))
    top = [min(height - 1, len(t.levels) - 1) for t in (one, two)]
    i, j = np.meshgrid(np.arange(len(one.levels[top[0]][0])), np.arange(len(two.levels[top[1]][0])), indexing="ij")
    todo = [(top[0], top[1], i.ravel(), j.ravel())]
    while todo:
        u, v, i, j = todo.pop()
        if len(i) > PAIRS:
            todo += [(u, v, i[PAIRS:], j[PAIRS:])]
            i, j = i[:PAIRS], j[:PAIRS]
        if same and u == v:
            ordered = (i < j) if u == 0 else (i <= j)
            i, j = i[ordered], j[ordered]
        a, b = one.levels[u], two.levels[v]
        near = (100 * a[2][i] >= threshold * b[1][j]) & (100 * b[2][j] >= threshold * a[1][i])
        near &= ~((a[4][i] == a[5][i]) & (b[4][j] == b[5][j]) & (a[4][i] == b[4][j]))
        i, j = i[near], j[near]
        if not len(i):
            continue
        common = _ones(a[0][i] & b[0][j])
        if u == 0 and v == 0:
            # a set's bits that the other lacks stand for that many shingles at least
            overlap = np.minimum(a[3][i], b[3][j]) + common
            keep = _pair_ok(a[1][i], b[1][j], overlap, threshold)
            if keep.any():
                most = overlap / (a[1][i] + b[1][j] - overlap)
                yield one.rows[i[keep]], two.rows[j[keep]], most[keep]
            continue
        most = np.minimum(a[3][i], b[3][j]) + common
        keep = most * (100 + threshold) >= threshold * (a[1][i] + b[1][j])
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if u >= v:
            many = np.minimum(FANOUT, len(one.levels[u - 1][0]) - i * FANOUT)
            i, j, u = texts.ragged(i * FANOUT, many), np.repeat(j, many), u - 1
        if v > u:
            many = np.minimum(FANOUT, len(two.levels[v - 1][0]) - j * FANOUT)
            i, j, v = np.repeat(i, many), texts.ragged(j * FANOUT, many), v - 1
        todo.append((u, v, i, j))


class _Forest:
    """Union-find over a block's components."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def met_before(one: np.ndarray, two: np.ndarray, token: np.ndarray | int) -> np.ndarray:
    """Whether rows of two tables of first shingles have one below ``token`` in common."""
    found = np.zeros(len(one), bool)
    for k in range(one.shape[1]):
        mine = one[:, k]
        found |= (mine < token) & (two == mine[:, None]).any(axis=1)
    return found


def block_pairs(
    fp: np.ndarray, n: np.ndarray, sig: list[bytes], root: np.ndarray, part: np.ndarray, spanning: bool,
    token: int = 0, firsts: np.ndarray | None = None, threshold: int = THRESHOLD,
) -> list[tuple[int, int]]:
    """Pairs of a block's classes to compare.  With two values in ``part``, only pairs between them."""
    bits = np.array([len(s) for s in sig])
    cross = bool((part != part[0]).any())
    out = []
    widths = np.unique(bits)
    bitmaps = {w: np.frombuffer(b"".join(sig[r] for r in np.flatnonzero(bits == w)), np.uint64).reshape(-1, w // 8) for w in widths}
    drawn = []
    for w in widths:
        rows = np.flatnonzero(bits == w)
        groups = [rows[part[rows] == p] for p in np.unique(part[rows])] if cross else [rows]
        trees = {int(part[g[0]]) if cross else 0: SignatureTree(bitmaps[w][np.searchsorted(rows, g)], n[g], root[g], g) for g in groups}
        found = [dual_traversal(trees[p], trees[q], threshold) for p in trees for q in trees if (p < q if cross else True)]
        if 2 * w in bitmaps:
            larger = np.flatnonzero(bits == 2 * w)
            folded = _fold(bitmaps[2 * w])
            wide = [larger[part[larger] == p] for p in np.unique(part[larger])] if cross else [larger]
            for g in wide:
                other = SignatureTree(folded[np.searchsorted(larger, g)], n[g], root[g], g)
                p = int(part[g[0]]) if cross else 0
                found += [dual_traversal(t, other, threshold) for q, t in trees.items() if not cross or p != q]
        for pairs in found:
            for x, y, most in pairs:
                keep = root[x] != root[y]
                if firsts is not None:
                    keep &= ~met_before(firsts[x], firsts[y], token)
                if spanning:
                    drawn.append((x[keep], y[keep], most[keep]))
                else:
                    out += zip(fp[x[keep]].tolist(), fp[y[keep]].tolist(), strict=True)
    if drawn:
        # a spanning forest of the likeliest links: pairs within a component follow from it
        x, y, most = (np.concatenate(c) for c in zip(*drawn, strict=True))
        order = np.argsort(-most, kind="stable")
        forest, open_roots = _Forest(), len(np.unique(root))
        for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
            if forest.join(int(root[a]), int(root[b])):
                out.append((int(fp[a]), int(fp[b])))
                open_roots -= 1
                if open_roots == 1:
                    break
    return out


def first_matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of up to FIRSTS shingles as rows, the largest number where there are fewer."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.full((len(sizes), FIRSTS), np.iinfo(np.int64).max, np.int64)
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[row]] = flat
    return out


def _leaves(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by run (token, run, fp, n, root, firsts), runs of a leaf at most: pairs (a, b), a < b."""

    def pairs_of(table: pa.Table):
        token, run, fp, n, root = (table.column(c).to_numpy() for c in ("token", "run", "fp", "n", "root"))
        firsts = first_matrix(table.column("firsts"))
        begin = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (run[1:] != run[:-1])]))
        sizes = np.diff(np.append(begin, len(token)))
        for size in np.unique(sizes).tolist():
            if size < 2:
                continue
            i, j = np.triu_indices(size, 1)
            for some in np.array_split(begin[sizes == size], max(1, int((sizes == size).sum()) * len(i) // (4 * PAIRS))):
                x, y = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
                keep = (root[x] != root[y]) & (100 * n[x] >= threshold * n[y]) & (100 * n[y] >= threshold * n[x])
                x, y = x[keep], y[keep]
                keep = ~met_before(firsts[x], firsts[y], token[x])
                a, b = fp[x[keep]], fp[y[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        token, run = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cut = np.flatnonzero((token != token[-1]) | (run != run[-1]))
        whole = int(cut[-1]) + 1 if len(cut) else 0
        # the last run may go on in the next batch
        held.append(batch.slice(0, whole))
        if whole:
            yield from pairs_of(pa.Table.from_batches(held).combine_chunks())
            held = []
        held.append(batch.slice(whole))
    if held:
        yield from pairs_of(pa.Table.from_batches(held).combine_chunks())


def may_link(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps cannot rule out."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for r, (x, y) in enumerate(zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                p, q = np.frombuffer(x, np.uint64)[None], np.frombuffer(y, np.uint64)[None]
                while p.shape[1] > q.shape[1]:
                    p = _fold(p)
                while q.shape[1] > p.shape[1]:
                    q = _fold(q)
                hidden = np.minimum(n_a[r] - _ones(p), n_b[r] - _ones(q))
                keep[r] = _pair_ok(n_a[r], n_b[r], hidden + _ones(p & q), threshold)[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    rows = pairs
    for side in ("a", "b"):
        rows = rows.join(classes.select(F.col("fp").alias(side), F.col("n").alias(f"n_{side}"), F.col("sig").alias(f"sig_{side}")), side)
    return rows.select("a", "b", "n_a", "sig_a", "n_b", "sig_b").mapInArrow(compare, "a long, b long")


def _blocks(spanning: bool, threshold: int):
    """From rows sorted by block (token, part_a, part_b, part, fp, n, sig, root[, firsts]): pairs (a, b), a < b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            fp, one = np.unique(table.column("fp").to_numpy(), return_index=True)
            if len(fp) < 2:
                return
            table = table.take(pa.array(one))
            column = lambda c: table.column(c).to_numpy()
            firsts = None if spanning else first_matrix(table.column("firsts"))
            pairs = block_pairs(
                fp, column("n"), table.column("sig").to_pylist(), column("root"), column("part"), spanning,
                table.column("token")[0].as_py(), firsts, threshold,
            )
            if pairs:
                both = np.sort(np.array(pairs, np.int64), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                mine = tuple(key[:, a].tolist())
                if held and mine != last:
                    yield from flush()
                    held = []
                held.append(batch.slice(a, b - a))
                last = mine
        if held:
            yield from flush()

    return run


def tree_pairs(entries: DataFrame, classes: DataFrame, spanning: bool, threshold: int) -> DataFrame:
    """Pairs (a, b) of classes from blocks ``entries`` (token, fp, root, parts[, run, firsts]) by their signature trees."""
    rows = entries.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    if spanning:
        rows = rows.withColumns({"part_a": F.col("part"), "part_b": F.lit(0).cast("long")})
    else:
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        # one number for the run and both parts
        rows = rows.withColumns(
            {"part_a": F.least("part", "other") * 1_000_000 + F.col("run"), "part_b": F.greatest("part", "other")}
        )
    more = [] if spanning else ["firsts"]
    rows = rows.join(classes, "fp").select("token", "part_a", "part_b", "part", "fp", "n", "sig", "root", *more)
    rows = rows.repartition("token", "part_a", "part_b").sortWithinPartitions("token", "part_a", "part_b")
    return rows.mapInArrow(_blocks(spanning, threshold), "a long, b long")


def parts_of(count: Column) -> Column:
    return F.ceil(count / BLOCK).cast("long")


def mixed_runs(labelled: DataFrame, threshold: int) -> DataFrame:
    """Of ``labelled`` (token, fp, n, root) the runs of comparable sizes with two components: and run, m (rows)."""
    order = Window.partitionBy("token").orderBy("n", "fp")
    gap = F.coalesce((100 * F.lag("n").over(order) < threshold * F.col("n")).cast("long"), F.lit(0))
    rows = labelled.withColumn("_gap", gap)
    rows = rows.withColumn("run", F.sum("_gap").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_gap")
    run = Window.partitionBy("token", "run")
    rows = rows.withColumns(
        {"m": F.count(F.lit(1)).over(run), "low": F.min("root").over(run), "high": F.max("root").over(run)}
    )
    return rows.where("low <> high").drop("low", "high")


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, key: str, text: str, width: int, threshold: int) -> DataFrame:
    """The stored pairs (a, b) of classes whose sets link.

    One document of each class is read again.  A Bloom filter of fixed size over their keys tells, where documents are read,
    which texts to turn into sets; a false positive costs a set that the join drops.
    """
    named = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    wanted = members.join(named, "fp").select(F.xxhash64("_key").alias("h"))
    spark = docs.sparkSession

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            for k in range(2):
                bits[(texts.mix(h + np.uint64(k)) % np.uint64(FILTER_BITS)).astype(np.int64)] = True
        packed = np.packbits(bits)
        used = np.flatnonzero(packed.reshape(-1, 1024).any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([packed[1024 * u : 1024 * u + 1024].tobytes() for u in used], pa.binary())], names=["at", "bits"]
        )

    packed = np.zeros(FILTER_BITS // 8, np.uint8)
    for at, bits in wanted.mapInArrow(marks, "at long, bits binary").toLocalIterator():
        packed[1024 * at : 1024 * at + 1024] |= np.frombuffer(bits, np.uint8)
    screen = spark.sparkContext.broadcast(packed)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(screen.value).astype(bool)
        known: set[int] = set()
        for batch in batches:
            h = batch.column(1).to_numpy().view(np.uint64)
            hit = np.ones(len(h), bool)
            for k in range(2):
                hit &= bits[(texts.mix(h + np.uint64(k)) % np.uint64(FILTER_BITS)).astype(np.int64)]
            for _, _, data, offsets in texts.slices(batch.column(0).filter(pa.array(hit))):
                hashes, sizes = set_arrays(data, offsets, width)
                fp = fingerprints(hashes, sizes)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                new = [r for r, x in enumerate(fp.tolist()) if x not in known and not known.add(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[new]), pa.array([hashes[bounds[r] : bounds[r + 1]].tobytes() for r in new], pa.binary())],
                    names=["fp", "set"],
                )

    found = docs.select(F.col(text).alias("_text"), F.xxhash64(key).alias("h")).mapInArrow(sets, "fp long, set binary")
    found = materialise(found.join(named, "fp", "left_semi").dropDuplicates(["fp"]), "sets")
    one = found.select(F.col("fp").alias("a"), F.col("set").alias("set_a"))
    two = found.select(F.col("fp").alias("b"), F.col("set").alias("set_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort()
                overlap = int((both[1:] == both[:-1]).sum())
                keep.append(100 * overlap >= threshold * (len(both) - overlap))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    return materialise(joined.mapInArrow(compare, "a long, b long"), "linked")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: key, n_shingles, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    first = materialise(
        rows.mapInArrow(lambda batches: _sets(batches, width), f"_key {kind}, n long, fp long, sig binary, seen long, times long"), "shingles"
    )
    sets = first.where(F.col("n").isNotNull())
    often = first.where(F.col("seen").isNotNull()).groupBy("seen").agg(F.sum("times").alias("times"))
    often = often.orderBy(F.desc("times"), "seen").limit(FREQUENT).select("seen").toArrow()
    frequent = np.sort(often.column("seen").to_numpy().view(np.uint64))
    screen = np.zeros(1 << 24, bool)
    screen[(frequent >> np.uint64(40)).astype(np.int64)] = True
    order = spark.sparkContext.broadcast((frequent, np.packbits(screen)))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, packed = order.value
        screen = np.unpackbits(packed).astype(bool)
        known: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in texts.slices(batch.column(0)):
                hashes, sizes = set_arrays(data, offsets, width)
                fp = fingerprints(hashes, sizes)
                new = np.array([x not in known and not known.add(x) for x in fp.tolist()], bool)
                token, row, place = prefixes(hashes[np.repeat(new, sizes)], np.where(new, sizes, 0), frequent, screen, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(fp[row]), pa.array(place.astype(np.int32))], names=["token", "fp", "place"]
                )

    same = Window.partitionBy("token")
    shared = rows.select("_text").mapInArrow(entries, "token long, fp long, place int")
    shared = shared.withColumn("low", F.min("fp").over(same)).withColumn("high", F.max("fp").over(same))
    shared = materialise(shared.where("low <> high").select("token", "fp", "place"), "blocks")
    classes = sets.join(shared.select("fp").distinct(), "fp", "left_semi")
    classes = materialise(classes.groupBy("fp").agg(F.min("n").alias("n"), F.first("sig").alias("sig")), "classes")
    members = sets.groupBy("fp").agg(F.min("_key").alias("_key"))

    own = Window.partitionBy("fp").orderBy("place")
    early = shared.select("token", "fp", "place").distinct().withColumn("at", F.row_number().over(own))
    early = early.where(F.col("at") <= EARLY).select("token", "fp", F.col("fp").alias("root"))
    early = early.withColumn("parts", parts_of(F.count(F.lit(1)).over(same)))
    pairs = materialise(tree_pairs(early, classes, True, threshold).distinct(), "pairs")
    roots = components(verified(pairs, docs, members, key, text, width, threshold)).withColumnRenamed("node", "fp")

    known = classes.select("fp", "n").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    live = materialise(mixed_runs(shared.select("token", "fp").distinct().join(known, "fp"), threshold), "mixed")
    least = Window.partitionBy("fp").orderBy("token")
    firsts = live.select("token", "fp").withColumn("at", F.row_number().over(least)).where(F.col("at") <= FIRSTS)
    firsts = firsts.groupBy("fp").agg(F.sort_array(F.collect_list("token")).alias("firsts"))
    live = live.join(firsts, "fp", "left").withColumn("firsts", F.coalesce("firsts", F.array().cast("array<long>")))
    leaves = live.where(F.col("m") <= LEAF).select("token", "run", "fp", "n", "root", "firsts")
    leaves = leaves.repartition("token", "run").sortWithinPartitions("token", "run")
    leaves = leaves.mapInArrow(lambda batches: _leaves(batches, threshold), "a long, b long")
    large = live.where(F.col("m") > LEAF).withColumn("parts", parts_of(F.col("m"))).drop("n", "m")
    found = may_link(materialise(leaves.distinct(), "leaves"), classes, threshold).unionByName(tree_pairs(large, classes, False, threshold))
    found = materialise(found.distinct(), "pairs").join(pairs, ["a", "b"], "left_anti")
    late = verified(materialise(found, "pairs"), docs, members, key, text, width, threshold)
    for side in ("a", "b"):
        late = (
            late.join(roots.select(F.col("fp").alias(side), F.col("root").alias("_r")), side, "left")
            .withColumn(side, F.coalesce("_r", F.col(side))).drop("_r")
        )
    upper = components(late).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return _labelled(sets, roots, upper, key)


def _labelled(sets: DataFrame, roots: DataFrame, upper: DataFrame, key: str) -> DataFrame:
    """Every document with its component's smallest key."""
    classes = sets.where("n > 0").groupBy("fp").agg(F.min("_key").alias("least"))
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = classes.join(upper, "root", "left").withColumn("top", F.coalesce("top", "root"))
    smallest = classes.groupBy("top").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "top").select("fp", "component_id")
    some = sets.where("n > 0").join(named, "fp").select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), "component_id")
    none = sets.where("n = 0").select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("_key").alias("component_id"))
    return some.unionByName(none)


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one, the row with its smallest key (nulls are largest).

    Rows are known by a number of their own, so that one key on several texts is several rows.
    """
    tag = next(f"_row{i}" for i in range(len(docs.columns) + 1) if f"_row{i}" not in docs.columns)
    tagged = materialise(docs.withColumn(tag, F.monotonically_increasing_id()), "tagged")
    found = groups(tagged, tag, text, width, threshold).select(tag, "component_id")
    found = materialise(found.join(tagged.select(tag, F.col(key).alias("_id")), tag), "grouped")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col(tag).alias("row")))
    stay = found.groupBy("component_id").agg(first.alias("_first")).select(F.col("_first.row").alias(tag))
    gone = found.select(tag).join(stay, tag, "left_anti")
    return tagged.join(gone, tag, "left_anti").drop(tag)
