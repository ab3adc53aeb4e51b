"""Whole texts as byte arrays inside tasks: words, their 64-bit hashes, and ragged gathers, all in numpy.

Texts are handled in slices of half a megabyte, so a task's memory does not depend on the rows of an Arrow batch.
A word's hash is a polynomial modulo 2**64 over its bytes (differences of one running sum), mixed afterwards.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # numpy holds some tens of bytes for each
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the worker's life up to a few slices."""
    if len(_powers[kind]) < n:
        base = _BASE if kind == "up" else _INVERSE
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            out = np.multiply.accumulate(steps)
        if size > 4 * SLICE_BYTES:
            return out
        _powers[kind] = out
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, bytes, offsets)`` for runs of rows of at most ``most`` bytes (or one row); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j - i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte stays."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


class Spans:
    """Hashes of any spans of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        with np.errstate(over="ignore"):
            terms = (data.astype(np.uint64) + np.uint64(1)) * _power("up", self.size)
            self.sums = np.zeros(self.size + 1, np.uint64)
            np.cumsum(terms, out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self.sums[ends] - self.sums[starts]) * _power("down", self.size + 1)[starts]
            return mix(value ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``data[start:end]``."""
    return Spans(data).hash(starts, ends)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, row)`` of the maximal runs of true bytes, none crossing a row's end."""
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def space_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between the six ASCII white-space characters."""
    return runs(~_SPACE[data], offsets)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start .. start + length - 1`` of every pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, row by row, and their number per row.

    A row with fewer words gives its whole sequence as one, a row without words none.
    """
    words = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(words) - words
    count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    begin = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)

    def rolled(start: np.ndarray, size: int) -> np.ndarray:
        h = np.full(len(start), size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[start + k])
        return h

    full = np.flatnonzero(words >= width)
    out[ragged(begin[full], count[full])] = rolled(ragged(first[full], count[full]), width)
    for size in range(1, width):
        short = np.flatnonzero(words == size)
        out[begin[short]] = rolled(first[short], size)
    return out, count
