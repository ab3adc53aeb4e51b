"""What a Python worker holds does not grow with what it has read."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tidewick.llm import jaccard_join, quality, token_units

BYTE_PAIRS = token_units.vocabulary("byte_bpe_50k.json")


def test_units_met_once_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_units, "KEPT", 2000)
    rng = random.Random(3)
    common = [f"word{i}" for i in range(300)]
    found = token_units.UnitEncoder(BYTE_PAIRS, False)
    sizes = []
    for part in range(12):
        rows = [" ".join([*rng.sample(common, 60), *(f"z{part}{rng.randrange(10**9)}" for _ in range(40))]) for _ in range(20)] + [None]
        for i, ids, bounds in found.documents(pa.array(rows), 0):
            for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), i):
                want = found.tokenizer.encode(rows[r] or "", add_special_tokens=False).ids
                assert ids[a:b].tolist() == [*want, 0] and ids.dtype == np.uint32
        sizes.append(len(found.hashes))
        assert len(found.hashes) == len(found.at) == len(found.count) == len(found.again)
    # one part's units beyond what is kept at most, though each part brings some 800 of its own
    assert max(sizes) <= 2000 + 1200 and found.used <= 8 * (2000 + 1200)
    assert found.ids.itemsize == 2


def test_repeated_numbers_are_counted_in_place():
    rng = np.random.default_rng(5)
    for most in (2, 9, 400):
        parts = [rng.integers(0, most, m).astype(np.uint64) for m in (0, 1, 50, 300)]
        tokens, times = np.unique(np.concatenate(parts), return_counts=True)
        got, counted = jaccard_join.repeated(parts, 4)
        assert parts == [] and (got == tokens[times >= 4]).all() and (counted == times[times >= 4]).all()
    assert [len(x) for x in jaccard_join.repeated([], 4)] == [0, 0]


def test_slices_hold_some_megabytes():
    rows = pa.array([" ".join(f"word{(i * 31 + k) % 9973}" for k in range(300)) for i in range(2000)])
    ratio = np.zeros(quality.BUCKETS)
    quality.weights(rows, ratio)
    tracemalloc.start()
    quality.weights(rows, ratio)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.nbytes > 5 << 20 and most < 60 << 20
