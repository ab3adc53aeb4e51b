import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewick.llm import queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """For every item its sorted (-score, doc_id is null, doc_id)."""
    counts = [(key, Counter(terms(t))) for key, t in docs]
    counts = [(key, c, sum(c.values())) for key, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for key, c, n in counts:
            m = 75 + (25 * n * n_docs) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m))
                for w, times in Counter(terms(text)).items() if w in c
            )
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, rank, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows_of(found):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()], key=str)


@pytest.fixture
def make_items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string").select("item_id", "text", F.lit(1).alias("rank"), F.lit(2).alias("_tag"))

    return make


def test_search_against_brute_force(make_docs, make_items, edge_rows):
    docs = edge_rows + [(20 + i, f"one two {'three ' * i} É K") for i in range(30)] + [(19, "one two  É K")] * 2
    items = [(1, "One, two; two THREE word7 word7"), (2, None), (3, ""), (4, "absent words"), (5, "été ſ"), (6, "word1 word2"), (1, "one"), (None, "漢字かな x")]
    got = ranked_search.search(make_docs(docs), make_items(items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == brute(docs, items)
    few = ranked_search.search(make_docs(docs), make_items(items), k=3, block_pairs=2)  # many blocks of items
    assert rows_of(few) == brute(docs, items, 3)
    assert rows_of(ranked_search.search(make_docs(docs).limit(0), make_items(items))) == []
    assert rows_of(ranked_search.search(make_docs(docs), make_items(items).limit(0))) == []


def test_skipping_keeps_every_tie(make_docs, make_items):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 5, 40])))) for i in range(700)]
    docs += [(5000 + i, "w40 w50 w3") for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(25)] + [(99, "w40 w50 w3 w0")]
    want = brute(docs, items)
    # small segments and windows, so that thresholds carry over and bounds skip
    for share in (0.0, 0.2, 1e9):
        found = ranked_search.search(make_docs(docs), make_items(items), segment_bytes=4000, window=16, short_share=share)
        assert rows_of(found) == want


def test_segments_skip_documents():
    """A long list that cannot reach the threshold alone names no candidates."""
    import numpy as np

    class Stats:
        docs, terms, weights = 4, 8, np.array([10, 1])

    row = {
        "lengths": np.array([2, 2, 2, 2], np.int32).tobytes(), "terms": [0, 1], "holding": [1, 4],
        "places": np.array([2, 0, 1, 2, 3], np.int32).tobytes(), "counts": np.ones(5, np.int32).tobytes(),
    }
    part = ranked_search.Segment(row, Stats)
    one = int(part.impacts[0])
    docs, scores = part.best(np.array([0, 1]), np.array([10, 1]), 1, 2 * one, short_share=0.25)
    assert docs.tolist() == [2] and scores.tolist() == [11 * one]
    docs, _ = part.best(np.array([0, 1]), np.array([10, 1]), 1, 12 * one, short_share=0.25)
    assert not len(docs)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_registered_query(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    assert rows_of(queries.QUERIES["op12_ranked_search"](spark, path)) == brute(docs, items)
