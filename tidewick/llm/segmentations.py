"""SentencePiece encoding by sampling: distinct segmentations of every text without replacement, and decoding.

A text's lattice has a node per character border and an edge per piece; a path weighs the product of its pieces' weights,
by Zipf's law on the model's own order of pieces (a character without a piece is one edge of its byte pieces).  Where two
neighbouring bytes are side by side in no piece every path has a border; texts are cut there into words, backward
sums are built once per distinct word of a slice, and a document's lattice is the chain of its words'.

Gumbel top-k by a perturbed A-star search: the root's value is a Gumbel variable.  Going down, the sampled edge keeps
its node's value, and its siblings together get a Gumbel of their mass, truncated at it; the best open sibling group is
the next sample's exact value, so the k first leaves reached are the k largest perturbed paths: distinct, and
drawn in proportion to their probability without replacement.  No group is passed over that could matter, however little
its mass.  ``inclusion`` is a path's probability of exceeding the (k+1)-th largest value (1 if there are no further paths).  All noise is a hash of the row key, the sample and the place,
so a row's samples do not depend on partitions or repeated tasks.

Spaces become the marker and one is put before each text, as the model's identity normaliser does; decoding gives the text
back exactly (only the marker character itself, U+2581, comes back as a space).

Defined results: null and empty texts have one segmentation, without pieces, of log probability 0 and inclusion 1; texts
with fewer than k segmentations give all they have; repeated rows give repeated results; an empty table gives an empty
result.  Only the key and text columns are read.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.llm import texts

SAMPLES = 2
SEED = 23
SLICE_BYTES = 1 << 19  # a slice's distinct words share their lattices
SAMPLED = 1 << 18  # bytes whose paths are sampled at a time
DECODED = 1 << 16  # ids that are decoded at a time
NEAR = -64.0  # log mass of a path's beginning; what lies behind is looked at where it can matter
NOISE = 37.5  # the largest Gumbel variable that ``uniform`` gives: -log(-log(1 - 2**-54)) and rounding
_TABLE = 1 << 20
_models: dict[str, "Pieces"] = {}


def model(path: str) -> "Pieces":
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


class Pieces:
    """A model's pieces by the hash of their bytes, the marker being a space."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_id = np.full(256, -1, np.int64)
        normal = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:-1], 16)])
                self.byte_id[self.bytes[i][0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes[i] = piece.replace("▁", " ").encode()
                normal.append(i)
        score = np.array([sp.get_score(i) for i in normal])
        rank = np.empty(len(normal), np.int64)
        rank[np.argsort(-score, kind="stable")] = np.arange(len(normal))
        self.weight = np.full(size, -np.inf)
        self.weight[normal] = -np.log(rank + 2.0)
        self.byte_weight = -np.log(size + 2.0)
        # every beginning of a piece by its hash: the piece that it is, if any, and whether longer ones begin so
        begun = {b[:k]: [-1, True] for i in normal for b in (self.bytes[i],) for k in range(1, len(b))}
        for i in normal:
            begun.setdefault(self.bytes[i], [-1, False])[0] = i
        lengths = np.array([len(b) for b in begun])
        ends = np.cumsum(lengths)
        hashes = texts.hash_spans(np.frombuffer(b"".join(begun), np.uint8), ends - lengths, ends)
        self.slot_hash, self.slot_used = np.zeros(_TABLE, np.uint64), np.zeros(_TABLE, bool)
        self.slot_piece, self.slot_more = np.full(_TABLE, -1, np.int32), np.zeros(_TABLE, bool)
        for h, (piece, more) in zip(hashes.tolist(), begun.values(), strict=True):
            at = h % _TABLE
            while self.slot_used[at]:
                at = (at + 1) % _TABLE
            self.slot_hash[at], self.slot_used[at], self.slot_piece[at], self.slot_more[at] = h, True, piece, more
        self.inside = np.zeros((256, 256), bool)  # bytes side by side at a character border within a piece
        for i in normal:
            b = self.bytes[i]
            for k in range(1, len(b)):
                if b[k] & 0xC0 != 0x80:
                    self.inside[b[k - 1], b[k]] = True
        sizes = np.array([len(b) for b in self.bytes])
        self.flat, self.flat_size = np.frombuffer(b"".join(self.bytes), np.uint8), sizes
        self.flat_start = np.cumsum(sizes) - sizes

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces with these hashes, or -1, and whether longer pieces begin so."""
        at = (hashes % np.uint64(_TABLE)).astype(np.int64)
        out, more = np.full(len(hashes), -1, np.int32), np.zeros(len(hashes), bool)
        todo = np.arange(len(hashes))
        while len(todo):
            same = self.slot_hash[at] == hashes[todo]
            out[todo[same]], more[todo[same]] = self.slot_piece[at[same]], self.slot_more[at[same]]
            on = ~same & self.slot_used[at]
            todo, at = todo[on], (at[on] + 1) % _TABLE
        return out, more

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts (UTF-8) of runs of ids: ``bounds`` has their borders."""
        sizes = self.flat_size[ids]
        raw = self.flat[texts.ragged(self.flat_start[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        return [raw[a + 1 : b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class Lattice(NamedTuple):
    """The lattices of some words: edges by node, longest first; a word's nodes are its bytes and its end."""

    data: np.ndarray
    start: np.ndarray  # first node of each word
    first: np.ndarray  # first edge of each node
    count: np.ndarray
    target: np.ndarray  # node that an edge leads to; an end node has no edges
    piece: np.ndarray  # or -1: the bytes of a character
    at: np.ndarray  # byte where an edge begins
    size: np.ndarray
    logp: np.ndarray  # given its node
    rest: np.ndarray  # log mass of the node's other edges, exact however little it is
    cumulative: np.ndarray


def lattice(pieces: Pieces, data: np.ndarray, offsets: np.ndarray) -> Lattice:
    n, words = len(data), len(offsets) - 1
    # a slice is small: 32 bits hold any place in it
    word = np.repeat(np.arange(words, dtype=np.int32), np.diff(offsets))
    left = offsets[1:].astype(np.int32)[word] - np.arange(n, dtype=np.int32)  # bytes to the word's end
    begins = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
    char = np.append(begins[1:], np.int32(n)) - begins  # bytes of the character
    char = np.minimum(char, left[begins])
    src, size, piece = [], [], []
    single = np.zeros(len(begins), bool)
    spans = texts.Spans(data)
    some = np.arange(len(begins), dtype=np.int32)
    length = 1
    while len(some):
        found, more = pieces.find(spans.hash(begins[some], begins[some] + length))
        hit = np.flatnonzero(found >= 0)
        src.append(begins[some[hit]])
        piece.append(found[hit])
        size.append(np.full(len(hit), length, np.int32))
        single[some[hit]] |= char[some[hit]] == length
        length += 1
        some = some[more]
        some = some[left[begins[some]] >= length]
    lone = np.flatnonzero(~single)
    src = np.concatenate([*src, begins[lone]])
    piece = np.concatenate([*piece, np.full(len(lone), -1, np.int32)])
    size = np.concatenate([*size, char[lone]])
    # edges of a node together, longest first: an order that does not depend on what else is in the slice
    order = np.argsort((src + word[src]).astype(np.int64) * 64 + (63 - size))
    src, piece, size = src[order], piece[order], size[order]
    logw = np.where(piece >= 0, pieces.weight[piece], pieces.byte_weight * size)
    node = src + word[src]
    target = node + size
    count = np.bincount(node, minlength=n + words)
    first = np.cumsum(count) - count
    # backward sums, nearest to a word's end first
    beta = np.zeros(n + words)
    near = left[begins]
    by_end = begins[np.argsort(near.astype(np.uint16) if near.max(initial=0) < 1 << 16 else near, kind="stable")]
    steps = np.flatnonzero(np.diff(left[by_end], prepend=-1))
    for a, b in zip(steps.tolist(), [*steps[1:].tolist(), len(by_end)], strict=True):
        mine = by_end[a:b] + word[by_end[a:b]]
        many = count[mine]
        edge = texts.ragged(first[mine], many)
        beta[mine] = np.logaddexp.reduceat(logw[edge] + beta[target[edge]], np.cumsum(many) - many)
    logp = logw + beta[target] - beta[node]
    p = np.exp(logp)
    main = p > 0.5  # one of a node at most: what is beside it is summed, not subtracted from one
    others = np.add.reduceat(np.where(main, 0.0, p), first[count > 0]) if len(p) else p
    with np.errstate(divide="ignore"):
        rest = np.log(np.where(main, np.repeat(others, count[count > 0]), 1.0 - p))
    running = np.cumsum(p)
    inside = running - np.repeat(np.concatenate([[0], running])[first[count > 0]], count[count > 0])
    inside[first[count > 0] + count[count > 0] - 1] = 2.0
    return Lattice(data, offsets[:-1] + np.arange(words), first, count, target, piece, src, size, logp, rest, inside)


def uniform(seed: np.ndarray, *parts: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the arguments only."""
    h = seed.astype(np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            h = texts.mix(h * np.uint64(0x9E3779B97F4A7C15) + np.asarray(part).astype(np.uint64) + np.uint64(1))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _walk(lat: Lattice, node: np.ndarray, seed: np.ndarray, place: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Sample from each node to its word's end: ``(edges, edges per node)``, those of a node in order."""
    who, at, step = np.arange(len(node)), node, 0
    steps, owners = [], []
    taken = np.zeros(len(node), np.int64)
    key = texts.mix(seed.astype(np.uint64) ^ texts.mix(place.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(sample)))
    while True:
        going = lat.count[at] > 0
        who, at = who[going], at[going]
        if not len(who):
            break
        u = uniform(key[who], step)
        edge = lat.first[at]
        behind = np.flatnonzero(lat.cumulative[edge] < u)
        while len(behind):
            edge[behind] += 1
            behind = behind[lat.cumulative[edge[behind]] < u[behind]]
        steps.append(edge)
        owners.append(who)
        taken[who] += 1
        at = lat.target[edge]
        step += 1
    begin = np.cumsum(taken) - taken
    out = np.zeros(int(taken.sum()), np.int64)
    for k, (edge, owner) in enumerate(zip(steps, owners, strict=True)):
        out[begin[owner] + k] = edge
    return out, taken


def _truncated(log_mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of these log masses, given that they are below ``top``."""
    return -np.logaddexp(-top, np.log(-np.log(u)) - log_mass)


def _largest(rows: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Which of the entries, sorted by row, are the ``k`` largest of their row."""
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
    left, keep = values.copy(), np.zeros(len(rows), bool)
    for _ in range(k if len(first) else 0):
        top = np.maximum.reduceat(left, first)
        at = np.flatnonzero((left == top[group]) & (left > -np.inf))
        at = at[np.flatnonzero(np.diff(group[at], prepend=-1))]
        keep[at], left[at] = True, -np.inf
    return keep


class Sample(NamedTuple):
    edges: np.ndarray
    bounds: np.ndarray  # per row; rows without this sample have none
    has: np.ndarray
    log_prob: np.ndarray
    value: np.ndarray


def sample(lat: Lattice, words: np.ndarray, rows: np.ndarray, seed: np.ndarray, k: int) -> tuple[list[Sample], np.ndarray]:
    """``k`` samples of every row, and the (k+1)-th largest value (-inf if none).

    ``words``: the lattice word of each word of the slice, ``rows`` its row, ``seed`` one number per row.
    """
    n = len(seed)
    per_row = np.bincount(rows, minlength=n)
    first_word = np.cumsum(per_row) - per_row
    place = np.arange(len(words)) - first_word[rows]
    start = lat.start[words]
    out: list[Sample] = []
    # open sibling groups: row, sample they left, step, node, log mass, value, edges already taken
    open_rows = {c: np.zeros(0, t) for c, t in (("row", np.int64), ("path", np.int64), ("step", np.int64), ("node", np.int64), ("mass", float), ("value", float))}
    gone = np.zeros((0, k), np.int64)
    value = -np.log(-np.log(uniform(seed, 1 << 40)))
    has = np.ones(n, bool)
    edges, taken = _walk(lat, start, seed[rows], place, 0)
    length = np.bincount(rows, weights=taken, minlength=n).astype(np.int64)
    since = np.zeros(n, np.int64)  # first step of the path that is its own
    for s in range(k):
        bounds = np.concatenate([[0], np.cumsum(length)])
        logp = lat.logp[edges]
        total = np.zeros(n)
        filled = np.flatnonzero(length)
        total[filled] = np.add.reduceat(logp, bounds[filled]) if len(filled) else 0.0
        out.append(Sample(edges, bounds, has, total, np.where(has, value, -np.inf)))
        fallen = np.concatenate([[0.0], -np.cumsum(logp)])
        own = np.minimum(bounds[:-1] + since, bounds[1:])

        def siblings(begin, end, edges=edges, bounds=bounds, value=value, fallen=fallen, s=s):
            """The best groups beside these steps; the others of a row are not reached in the samples left."""
            many = np.maximum(end - begin, 0)
            new, r = texts.ragged(begin, many), np.repeat(np.arange(n), many)
            some = lat.count[_node(lat, edges[new])] > 1
            new, r = new[some], r[some]
            mass = fallen[bounds[r]] - fallen[new] + lat.rest[edges[new]]
            step = new - bounds[r]
            values = _truncated(mass, value[r], uniform(seed[r], 1 << 41, s, step))
            add = {"row": r, "path": np.full(len(r), s), "step": step, "node": _node(lat, edges[new]), "mass": mass, "value": values}
            keep = _largest(r, values, k - s)
            return {c: x[keep] for c, x in add.items()}, edges[new[keep]]

        # masses only fall along a path, and a value is above its group's log mass by NOISE at most: what lies behind
        # ``near`` is looked at in rows that have no k - s groups above all that it can give
        near = np.clip(np.searchsorted(fallen, fallen[bounds[:-1]] - NEAR, "left"), own, bounds[1:])
        add, left_by = siblings(own, near)
        enough = np.bincount(add["row"][add["value"] > NEAR + NOISE], minlength=n) >= k - s
        more, more_by = siblings(near, np.where(enough, near, bounds[1:]))
        if len(more_by):
            order = np.argsort(np.concatenate([add["row"], more["row"]]), kind="stable")
            add, left_by = {c: np.concatenate([add[c], more[c]])[order] for c in add}, np.concatenate([left_by, more_by])[order]
            keep = _largest(add["row"], add["value"], k - s)
            add, left_by = {c: x[keep] for c, x in add.items()}, left_by[keep]
        fresh = np.full((len(left_by), k), -1, np.int64)
        fresh[:, 0] = left_by
        open_rows = {c: np.concatenate([open_rows[c], add[c]]) for c in open_rows}
        gone = np.concatenate([gone, fresh])
        order = np.lexsort((-open_rows["value"], open_rows["row"]))
        open_rows = {c: x[order] for c, x in open_rows.items()}
        gone = gone[order]
        best = np.flatnonzero(np.diff(open_rows["row"], prepend=-1))
        top = np.full(n, -np.inf)
        top[open_rows["row"][best]] = open_rows["value"][best]
        if s + 1 == k:
            return out, top
        # the best group of each row gives the next sample
        r, at = open_rows["row"][best], open_rows["node"][best]
        count = lat.count[at]
        options = texts.ragged(lat.first[at], count)
        owner = np.repeat(np.arange(len(best)), count)
        p = np.exp(lat.logp[options])
        p[(gone[best][owner] == options[:, None]).any(axis=1)] = 0.0
        lead = np.cumsum(count) - count
        total = np.add.reduceat(p, lead) if len(p) else np.zeros(0)
        # shares of the group, so that a group of little mass is drawn from as exactly as any other
        running = np.cumsum(p / total[owner])
        want = np.concatenate([[0.0], running])[lead] + uniform(seed[r], 1 << 42, s)
        pick = np.clip(np.searchsorted(running, want, "left"), lead, lead + count - 1)
        for x in np.flatnonzero(p[pick] <= 0).tolist():  # rounding beside an edge that is gone
            pick[x] = lead[x] + np.argmax(p[lead[x] : lead[x] + count[x]])
        chosen = options[pick]
        # what is left of the group
        p[pick] = 0.0
        left = np.add.reduceat(p, lead) if len(p) else total
        still = left > 0
        prefix = open_rows["mass"][best] - np.log(total)
        mass = prefix + np.log(np.where(still, left, 1.0))
        u = uniform(seed[r], 1 << 43, s)
        old_path, old_step, g = open_rows["path"][best], open_rows["step"][best], open_rows["value"][best]
        open_rows["mass"][best], open_rows["value"][best] = mass, _truncated(mass, g, u)
        slot = (gone[best] >= 0).sum(axis=1)
        spot = np.minimum(slot, k - 1)
        gone[best, spot] = chosen
        keep = np.ones(len(open_rows["row"]), bool)
        keep[best[~still]] = False
        open_rows = {c: x[keep] for c, x in open_rows.items()}
        gone = gone[keep]
        # its path: the old one up to the step, the chosen edge, the rest of that word, and fresh words
        has = np.zeros(n, bool)
        has[r] = True
        value = np.full(n, -np.inf)
        value[r] = g
        since = np.zeros(n, np.int64)
        since[r] = old_step + 1
        heads = [
            out[j].edges[a : a + m]
            for j, a, m in zip(old_path.tolist(), [out[j].bounds[x] for j, x in zip(old_path, r, strict=True)], old_step.tolist(), strict=True)
        ]
        # words finished before the step: edges that lead to an end node
        at_word = np.array([int((lat.count[lat.target[h]] == 0).sum()) for h in heads], np.int64)
        later = per_row[r] - at_word - 1
        tail_words = texts.ragged(first_word[r] + at_word + 1, later)
        nodes = np.concatenate([lat.target[chosen], start[tail_words]])
        places = np.concatenate([at_word, place[tail_words]])
        walked, taken = _walk(lat, nodes, np.concatenate([seed[r], seed[rows[tail_words]]]), places, s + 1)
        ends = np.cumsum(taken)[: len(r)]
        tails = np.bincount(np.repeat(np.arange(len(r)), later), weights=taken[len(r) :], minlength=len(r)).astype(np.int64)
        tail_ends = (ends[-1] if len(r) else 0) + np.cumsum(tails)
        length = np.zeros(n, np.int64)
        length[r] = old_step + 1 + taken[: len(r)] + tails
        parts = [np.zeros(0, np.int64)]
        for head, own, size, end, tail, last in zip(heads, chosen, taken.tolist(), ends.tolist(), tails.tolist(), tail_ends.tolist(), strict=False):
            parts += [head, [own], walked[end - size : end], walked[last - tail : last]]
        edges = np.concatenate(parts).astype(np.int64)
    return out, np.full(n, -np.inf)


def _node(lat: Lattice, edges: np.ndarray) -> np.ndarray:
    """The nodes that edges leave."""
    return lat.target[edges] - lat.size[edges]


def ids_of(pieces: Pieces, lat: Lattice, edges: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of paths, byte pieces for characters without a piece: ``(ids, bounds)``."""
    piece = lat.piece[edges].astype(np.int64)
    lone = piece < 0
    if not lone.any():
        return piece, bounds
    width = np.where(lone, lat.size[edges], 1)
    begin = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.int64)
    out[begin[~lone]] = piece[~lone]
    out[texts.ragged(begin[lone], width[lone])] = pieces.byte_id[lat.data[texts.ragged(lat.at[edges[lone]], width[lone])]]
    return out, np.concatenate([[0], np.cumsum(width)])[bounds]


def prepared(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before each that is not empty, and the marker character as a space."""
    raw = data.tobytes()
    if b"\xe2\x96\x81" in raw:
        rows = [raw[a:b].replace(b"\xe2\x96\x81", b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        data = np.frombuffer(b"".join(rows), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    sizes = np.diff(offsets)
    grown = sizes + (sizes > 0)
    bounds = np.concatenate([[0], np.cumsum(grown)])
    out = np.full(int(grown.sum()), 0x20, np.uint8)
    body = np.ones(len(out), bool)
    body[bounds[:-1][sizes > 0]] = False
    out[body] = data
    return out, bounds


def slice_words(pieces: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[Lattice, np.ndarray, np.ndarray]:
    """``(lattice, words, rows)`` of the texts of a slice: the lattice's word of each word, and its row."""
    data, offsets = prepared(data, offsets)
    # a border that no piece can span: the same bytes are side by side in no piece
    begins = np.zeros(len(data), bool)
    begins[1:] = ((data[1:] & 0xC0) != 0x80) & ~pieces.inside[data[:-1], data[1:]]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    rows = np.searchsorted(offsets, starts, "right") - 1
    _, one, words = np.unique(texts.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    sizes = ends[one] - starts[one]
    flat = data[texts.ragged(starts[one], sizes)]
    return lattice(pieces, flat, np.concatenate([[0], np.cumsum(sizes)])), words, rows


def slice_samples(pieces: Pieces, data: np.ndarray, offsets: np.ndarray, seed: np.ndarray, k: int):
    """``(lattice, samples, next values)`` of the texts of a slice."""
    lat, words, rows = slice_words(pieces, data, offsets)
    return lat, *sample(lat, words, rows, seed, k)


def _parts(pieces: Pieces, column: pa.Array, seeds: np.ndarray, k: int):
    """``(first row, lattice, samples, next values)``: a slice shares its lattice, paths are sampled some rows at a time."""
    for i, n, data, offsets in texts.slices(column, SLICE_BYTES):
        lat, words, rows = slice_words(pieces, data, offsets)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SAMPLED, "right")) - 1)
            x, y = np.searchsorted(rows, [a, b])
            yield i + a, lat, *sample(lat, words[x:y], rows[x:y] - a, seeds[i + a : i + b], k)
            a = b


def encode(
    docs: DataFrame, path: str, k: int = SAMPLES, key: str = "doc_id", text: str = "text", digests: bool = False
) -> DataFrame:
    """Up to ``k`` rows per document: key, sample (from 1), n_pieces, log_prob, value, inclusion, ids ``array<int>``.

    ``digests``: in place of ids their CRC-32 (little-endian unsigned 32-bit) and that of the text that ``decode`` makes of them.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.lit(SEED), F.col(key)).alias("_seed"))
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            seeds = batch.column(2).to_numpy().astype(np.uint64)
            for i, lat, samples, after in _parts(pieces, batch.column(1), seeds, k):
                for s, found in enumerate(samples):
                    mine = np.flatnonzero(found.has)
                    ids, bounds = ids_of(pieces, lat, found.edges, found.bounds)
                    with np.errstate(over="ignore"):
                        inclusion = -np.expm1(-np.exp(found.log_prob[mine] - after[mine]))
                    sizes = np.diff(bounds)[mine]
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    if digests:  # as bytes, which Spark copies and sums as they are
                        listed = pa.Array.from_buffers(
                            pa.binary(), len(mine), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids.astype("<u4").tobytes())]
                        )
                    else:
                        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(mine + i)), pa.array(np.full(len(mine), s + 1, np.int32)),
                            pa.array(sizes), pa.array(found.log_prob[mine]), pa.array(found.value[mine]), pa.array(inclusion), listed,
                        ],
                        names=names,
                    )

    ids = "binary" if digests else "array<int>"
    schema = f"_key {kind}, sample int, n_pieces long, log_prob double, value double, inclusion double, ids {ids}"
    names = [c.split()[0] for c in schema.split(", ")]
    encoded = rows.mapInArrow(run, schema)
    if digests:
        sums = [F.crc32(c).alias(f"{n}_crc32") for n, c in (("ids", F.col("ids")), ("text", F.col("_text").cast("binary")))]
        encoded = decode(encoded, path, out="_text").select(*names[:-1], *sums)
    return encoded.withColumnRenamed("_key", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of ``ids`` in the column ``out`` (null ids: null).

    ``ids``: ``array<int>``, or binary of little-endian unsigned 32-bit integers.
    """
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            packed = not pa.types.is_list(batch.column(at).type)
            length = pc.binary_length if packed else pc.list_value_length
            sizes = pc.fill_null(length(batch.column(at)), 0).to_numpy().astype(np.int64) // (4 if packed else 1)
            ends = np.cumsum(sizes)
            a = 0
            while a < batch.num_rows:
                # rows of at most DECODED ids, or one row
                b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + DECODED, "right")))
                part = batch.slice(a, b - a)
                column = part.column(at)
                if packed:
                    flat = np.frombuffer(b"".join(x.as_buffer() for x in column if x.is_valid), "<u4")
                else:
                    flat = column.flatten().to_numpy(zero_copy_only=False)
                found = pieces.decode(flat.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[a:b])]))
                values = [x.decode("utf-8", "replace") if ok else None for x, ok in zip(found, column.is_valid().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.string())], names=[*batch.schema.names, out])
                a = b

    return encoded.mapInArrow(run, encoded.withColumn(out, F.lit(None).cast("string")).schema)
