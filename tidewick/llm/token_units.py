"""Token ids of whole texts by the ``tokenizers`` library, each distinct unit of text encoded once per worker.

A unit is a run of white space and the run of other characters after it, also cut between an ASCII letter and ASCII
punctuation.  Pre-tokenisers that split by the word patterns of byte-level vocabularies always cut there, so a text's ids
are its units' ids one after another.  Texts for which this may not hold (white space beyond ASCII, and ``<|``, which
may begin a special token) are encoded whole.  A unit is known by a 64-bit hash of its bytes; a worker keeps the ids of
about ``KEPT`` units (some 30 MB): beyond, only those met again since the last time stay, as most units come once.
"""

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidewick.llm import texts

KEPT = 1_000_000
# white space beyond the six ASCII characters, in UTF-8, and what may begin a special token
_ODD_BYTES = re.compile(
    rb"<\||[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf"
)
_PUNCT, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_encoders: dict[tuple[str, bool], "UnitEncoder"] = {}


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, fold: bool = False) -> "UnitEncoder":
    """The worker's encoder of a vocabulary; ``fold``: it lowers case and drops white space, so units may too."""
    if (path, fold) not in _encoders:
        _encoders[path, fold] = UnitEncoder(path, fold)
    return _encoders[path, fold]


class UnitEncoder:
    def __init__(self, path: str, fold: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fold = fold
        self.narrow = np.min_scalar_type(max(self.tokenizer.get_vocab().values(), default=0))
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.at = np.zeros(0, np.uint32)
        self.count = np.zeros(0, np.uint32)
        self.again = np.zeros(0, bool)  # met since it was learned or last kept
        self.ids = np.zeros(1 << 16, self.narrow)
        self.used = 0

    def forget(self) -> None:
        """Units that were met once go; all go if these would still be too many."""
        stay = self.again
        if stay.sum() > KEPT // 2:
            return self.clear()
        count = self.count[stay].astype(np.int64)
        ids = self.ids[texts.ragged(self.at[stay].astype(np.int64), count)]
        self.at = (np.cumsum(count) - count).astype(np.uint32)
        self.hashes, self.count, self.again = self.hashes[stay], count.astype(np.uint32), np.zeros(len(count), bool)
        self.ids, self.used = np.append(ids, np.zeros(1 << 16, self.narrow)), len(ids)

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch(units, add_special_tokens=False)]
        count = np.fromiter(map(len, encoded), np.int64, len(encoded))
        total = int(count.sum())
        if self.used + total > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(total, len(self.ids) // 4), self.narrow))
        self.ids[self.used : self.used + total] = np.fromiter((i for e in encoded for i in e), self.narrow, total)
        at = self.used + np.cumsum(count) - count
        self.used += total
        where = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, where, hashes)
        self.at, self.count = np.insert(self.at, where, at), np.insert(self.count, where, count)
        self.again = np.insert(self.again, where, False)

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.fold:
            starts, ends, rows = texts.space_words(data, offsets)
            if not len(starts):
                return starts, ends, rows
            begins, stops = np.zeros(len(data), bool), np.zeros(len(data) + 1, bool)
            begins[starts], stops[ends] = True, True
            cut = np.flatnonzero(_LETTER[data[:-1]] & _PUNCT[data[1:]] & ~begins[1:]) + 1
            begins[cut], stops[cut] = True, True
            starts = np.flatnonzero(begins)
            return starts, np.flatnonzero(stops), np.searchsorted(offsets, starts, "right") - 1
        space = texts.is_space(data)
        begins = np.zeros(len(data), bool)
        begins[1:] = (space[1:] & ~space[:-1]) | (_LETTER[data[:-1]] & _PUNCT[data[1:]])
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return starts, ends, np.searchsorted(offsets, starts, "right") - 1

    def slice_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the texts of a slice."""
        n = len(offsets) - 1
        raw = data.tobytes()
        odd = np.zeros(n, bool)
        for found in _ODD_BYTES.finditer(raw):
            odd[np.searchsorted(offsets, found.start(), "right") - 1] = True
        if self.fold:
            data = texts.lower_ascii(data)
            folded = data.tobytes()
        else:
            folded = raw
        starts, ends, rows = self._units(data, offsets)
        if odd.any():
            keep = ~odd[rows]
            starts, ends, rows = starts[keep], ends[keep], rows[keep]
        hashes, first, inverse = np.unique(texts.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > KEPT:
            self.forget()
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = self.hashes[place] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        self.again[place[~new]] = True
        if new.any():
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._learn(hashes[new], [folded[a:b].decode() for a, b in spans])
            place = np.searchsorted(self.hashes, hashes)
        count = self.count[place][inverse].astype(np.int64)
        ids = self.ids[texts.ragged(self.at[place][inverse].astype(np.int64), count)].astype(np.uint32)
        per_row = np.bincount(rows, weights=count, minlength=n).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_row)])
        if not odd.any():
            return ids, bounds
        parts, lengths = [], per_row.copy()
        for row in range(n):
            if odd[row]:
                whole = raw[offsets[row] : offsets[row + 1]].decode()
                parts.append(np.array(self.tokenizer.encode(whole, add_special_tokens=False).ids, np.uint32))
                lengths[row] = len(parts[-1])
            else:
                parts.append(ids[bounds[row] : bounds[row + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])

    def documents(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first row, ids, offsets)`` per slice of a column of texts, ``end_id`` after every text; null is empty."""
        for i, n, data, offsets in texts.slices(column):
            ids, bounds = self.slice_ids(data, offsets)
            out = np.full(len(ids) + n, end_id, np.uint32)
            ends = bounds[1:] + np.arange(n)
            body = np.ones(len(out), bool)
            body[ends] = False
            out[body] = ids
            yield i, out, bounds + np.arange(n + 1)
