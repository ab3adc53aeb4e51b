import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pytest

from tidewick.llm import exact_dedup, jaccard_join
from tidewick.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(text):
    return (text or "").translate(FOLD)


def check_exact(rows, got):
    groups = defaultdict(list)
    for key, text in rows:
        groups[folded(text)].append(key)
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        keys = [k for k in groups[text] if k is not None]
        assert r.doc_id in groups[text]
        assert r.keep_id == (max(keys) if keys else None) and r.group_size == len(groups[text])
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[text] += 1
    assert kept == dict.fromkeys(groups, 1)


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_exact_dedup_edges(make_docs, edge_rows, support):
    docs = make_docs(edge_rows)
    check_exact(edge_rows, exact_dedup.decisions(docs, support=support).collect())
    left = exact_dedup.drop_duplicates(docs, support=support)
    assert left.columns == docs.columns
    assert sorted(folded(r.text) for r in left.collect()) == sorted({folded(t) for _, t in edge_rows})


def test_exact_dedup_hot_groups(make_docs):
    rows = [(i, ["hot", "HOT", "warm"][i % 3] if i < 300 else f"text {i}") for i in range(400)] + [(299, "warm")] * 50
    docs = make_docs(rows)
    assert 0 < exact_dedup.heavy_winners(
        docs.select(exact_dedup.text_digest(docs.text).alias("_digest"), docs.doc_id.alias("_key")), ["_key"], 0.1
    ).count() <= 10
    check_exact(rows, exact_dedup.decisions(docs, support=0.1).collect())
    assert exact_dedup.drop_duplicates(docs, support=0.1).count() == 102


def test_exact_dedup_empty_table(make_docs):
    empty = make_docs([(1, "x")]).limit(0)
    assert exact_dedup.decisions(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


# --- n-gram Jaccard join


def shingle_set(text, width=4):
    words = [w for w in folded(text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected_groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(
        ((k, len(sets[i]), least.get(find(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=repr
    )


def edited(words, rng, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return words


def near_copies(seed, size):
    """Families of near copies at, above and below the threshold, a passage that many share, and other texts."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for i in range(size):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 250))]
        for c in range(rng.choice([1, 1, 2, 8])):
            body = edited(base, rng, rng.choice([0, 1, 2, 4, 6]))
            if i % 3 == 0:
                body = body + passage
            rows.append((1000 * i + c, " ".join(body).capitalize()))
    return rows


def test_jaccard_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    got = jaccard_join.groups(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_groups(edge_rows)
    assert jaccard_join.groups(docs.limit(0)).count() == 0
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns and 5 not in [r.doc_id for r in left.collect()]


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 3)])
def test_jaccard_families(make_docs, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(seed, 60)
    got = jaccard_join.groups(make_docs(rows)).collect()
    want = expected_groups(rows)
    assert len({c for _, _, c in want}) < len(rows)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_one_row_of_each_component_stays(make_docs):
    one, two, alone = (" ".join(f"{c}{i}" for i in range(100)) for c in "abc")
    rows = [
        (3, one), (7, f"{one} more"), (7, alone), (None, two), (None, f"{two} more"), (9, f"{alone} x y"), (3, one),
        (None, f"{one} z"), (None, None), (None, ""),
    ]
    left = sorted(((r.doc_id, r.text) for r in jaccard_join.one_of_each(make_docs(rows)).collect()), key=repr)
    assert (None, two) in left or (None, f"{two} more") in left
    assert [r for r in left if r[1] not in (two, f"{two} more")] == sorted([(3, one), (7, alone), (None, None), (None, "")], key=repr)
    assert len(left) == 5


@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=40, unique=True), min_size=2, max_size=30))
@settings(max_examples=60, deadline=None)
def test_traversal_keeps_every_link(sets):
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 31).astype(np.uint64)
    n = np.array([len(s) for s in sets])
    sig = jaccard_join.signatures(np.concatenate([np.sort(hashes[s]) for s in sets]), n)
    fp = np.arange(len(sets))
    pairs = jaccard_join.block_pairs(fp, n, sig, fp, np.zeros(len(sets), int), False)
    found = {tuple(sorted(p)) for p in pairs}
    for i in range(len(sets)):
        for j in range(i):
            a, b = set(sets[i]), set(sets[j])
            if 100 * len(a & b) >= 85 * len(a | b):
                assert (j, i) in found


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(4)
    frequent = np.sort(rng.integers(0, 1 << 63, 20).astype(np.uint64))
    screen = np.zeros(1 << 24, bool)
    screen[(frequent >> np.uint64(40)).astype(np.int64)] = True
    for _ in range(200):
        a = set(rng.integers(0, 1 << 63, rng.integers(5, 60)).tolist()) | set(rng.choice(frequent, 10).tolist())
        b = set(list(a)[: int(len(a) * 0.95)])
        if 100 * len(a & b) < 85 * len(a | b):
            continue
        first = []
        for s in (a, b):
            h = np.sort(np.array(list(s), np.uint64))
            first.append(set(jaccard_join.prefixes(h, np.array([len(h)]), frequent, screen)[0].tolist()))
        assert first[0] & first[1]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(7, i) for i in range(20, 40)] + [(3, 3), (5, 4), (4, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(20, 40)}, 4: 4, 5: 4}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
