import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewick.llm import neighbours, quality, queries, url_filter


# --- nearest neighbours


def exact_neighbours(rows, k):
    good = {}
    for key, v in rows:
        if key is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[key, tuple(v)] = None
    out = {}
    for key, v in good:
        if key % 100 == 0:
            near = sorted((math.dist(v, w), other) for other, w in good if other != key and len(w) == len(v))
            out[key] = near[:k]
    return out


def test_neighbours_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)] + [(i, [1.0] * 6) for i in range(200, 230)]
    rows += [(300, [1.0] * 6), (400, None), (500, [0.0] * 6), (600, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (700, []),
             (800, [float("nan")] + [1.0] * 5), (900, [float("inf")] + [1.0] * 5), (1000, [1.0, 2.0]), (1001, [1.0, 3.0]),
             (None, [1.0] * 6), (0, rows[0][1]), (-100, [0.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("p0", F.lit(2))
    got = neighbours.nearest(df).collect()
    want = exact_neighbours(rows, 10)
    mine = {}
    for r in got:
        mine.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(mine) == {k for k, v in want.items() if v}
    hits = sum(len({v for _, _, v in mine[q]} & {v for _, v in want[q]}) for q in mine)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in mine.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
    assert [v for _, _, v in sorted(mine[300])] == list(range(200, 210))  # ties to the smaller id
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_neighbours_over_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").withColumn("vec_id", F.col("vec_id") * 20)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact_neighbours(rows, 10)
    got = neighbours.nearest(df).collect()
    assert len(got) == sum(map(len, want.values()))
    hits = sum(r.vec_id in {v for _, v in want[r.query_id]} for r in got)
    assert hits >= 0.9 * len(got)
    scores = {(q, v): s for q, near in want.items() for s, v in near}
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-12 for r in got if (r.query_id, r.vec_id) in scores)


def test_chi_square_quantile():
    assert abs(neighbours.chi_square_quantile(0.95, 8) - 15.507) < 1e-3
    assert abs(neighbours.chi_square_quantile(0.99, 2) - 9.210) < 1e-3


# --- URLs


def expected_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[: min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, name, prefix in queries.URL_RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(prefix) and (best is None or len(name + prefix) > len(best[1])):
            best = (verdict, name + prefix)
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?q#f", "http://example.org/en/1", "http://example.org/en/2",
    "http://org", "http://org/", "http://xorg/a", "http://a.com/fr/", "http://a.com/de/b/c#/x", "http://a.com?x=/fr/",
    "http://É.ORG/ü", "ftp://a.net/b://c/d", "http://example.org/es", "://org/x", "http://a.b/" + "x" * 100_000, "http://a.com/fr/\n?",
]


def test_url_rules_and_hosts(spark):
    rows = [(i, u) for i, u in enumerate([*URLS, URLS[4]])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    got = url_filter.judge(df, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, best = expected_rule(dict(rows)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == best[0] if best else r.verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0
    alone = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(alone, queries.URL_RULES).collect()] == ["allow", "allow"]


def brute_difference(model, url):
    data = np.frombuffer(url.encode(), np.uint8)
    ctx, chars = url_filter.cells(data, np.array([0, len(data)]))
    total = 0.0
    for i in range(len(data)):
        logs = []
        for c in (0, 1):
            p = 1 / 256
            for order in range(url_filter.ORDERS):
                p = (model[c, 1, order][chars[order, i]] + url_filter.ALPHA * p) / (model[c, 0, order][ctx[order, i]] + url_filter.ALPHA)
            logs.append(math.log(p))
        total += logs[0] - logs[1]
    return total / max(len(data), 1)


def test_url_model_held_out(spark):
    rng = np.random.default_rng(2)
    urls = [(f"http://{'shop-pills' if i % 2 else 'library'}{rng.integers(1000)}.net/{'buy-now' if i % 2 else 'book'}/{i}", bool(i % 2)) for i in range(400)]
    df = spark.createDataFrame(urls, "url string, blocked boolean")
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    model = url_filter.train(df.where(~held))
    scored = url_filter.with_difference(df.where(held), "url", "difference", model)
    least = url_filter.threshold(scored)
    rows = scored.collect()
    assert np.mean([(r.difference < least) == r.blocked for r in rows]) > 0.97
    for r in rows[:5]:
        assert abs(r.difference - brute_difference(model, r.url)) < 1e-9


def test_url_model_counts_every_context(spark):
    rng = np.random.default_rng(6)
    rows = [("".join(map(chr, rng.integers(97, 123, 30))), bool(i % 2)) for i in range(2000)]
    seen = [Counter(), Counter()]
    for url, blocked in rows:
        for i in range(len(url)):
            for order in range(url_filter.ORDERS):
                before = "^" * (order - i) + url[max(0, i - order) : i]
                seen[blocked][before] += 1
                seen[blocked][before, url[i]] += 1
    assert len(seen[0]) > 1 << 16
    df = spark.createDataFrame(rows, "url string, blocked boolean").repartition(3)
    scored = url_filter.with_difference(df, "url", "difference", url_filter.train(df)).collect()
    assert sorted((r.url, r.blocked) for r in scored) == sorted(rows)
    for r in scored[::50]:
        total = 0.0
        for i, char in enumerate(r.url):
            p = [1 / 256, 1 / 256]
            for order in range(url_filter.ORDERS):
                before = "^" * (order - i) + r.url[max(0, i - order) : i]
                p = [(seen[c][before, char] + url_filter.ALPHA * p[c]) / (seen[c][before] + url_filter.ALPHA) for c in (0, 1)]
            total += math.log(p[0]) - math.log(p[1])
        assert abs(r.difference - total / len(r.url)) < 1e-9


def test_url_counts_meet_without_broadcast(spark):
    rng = np.random.default_rng(8)
    rows = [("".join(map(chr, rng.integers(97, 123, 40))), bool(i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "url string, blocked boolean").repartition(3)
    model = url_filter.train(df)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")  # so that only the query itself can rule a broadcast out
    try:
        scored = url_filter.with_difference(df, "url", "difference", model)
        got = scored.collect()
        plan = scored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.url, r.blocked) for r in got) == sorted(rows)
    for r in got[::100]:
        assert abs(r.difference - brute_difference(model, r.url)) < 1e-9


# --- quality


def weight_of(ratio, text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    bucket, _ = quality.grams(raw, np.array([0, len(raw)]))
    return float(ratio[bucket].sum())


def test_quality_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    ratio, scored, least = quality.fit(docs, labels)
    rows = {r._key: r for r in scored.collect()}
    texts_of = {r.doc_id: r.text for r in docs.collect()}
    # the model: counts of all documents, and of the good ones not held out
    target = {r._id for r in quality.labelled(labels).where("_good and not _held").collect()}
    counts = np.zeros((2, quality.BUCKETS))
    for k, t in texts_of.items():
        raw = np.frombuffer(t.encode(), np.uint8)
        n = np.bincount(quality.grams(raw, np.array([0, len(raw)]))[0], minlength=quality.BUCKETS)
        counts[0] += n
        counts[1] += n * (k in target)
    assert np.allclose(ratio, quality.log_ratio(*counts))
    assert all(abs(rows[k].log_weight - weight_of(ratio, t)) < 1e-6 for k, t in texts_of.items())
    # Gumbel top-k keeps the k largest keys
    got = quality.resample(docs, labels).collect()
    kept = {r.doc_id for r in got if r.kept}
    k = len(kept)
    assert kept == {r.doc_id for r in sorted(got, key=lambda r: -r.gumbel)[:k]} and len(got) == len(texts_of)
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in texts_of}
    good = [d for d, q in truth.items() if q == 1]
    bad = [d for d, q in truth.items() if q == 0]
    assert np.mean([d in kept for d in good]) >= 0.99 and np.mean([d in kept for d in bad]) <= 0.3
    left = quality.keep(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept


def test_quality_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    labels = spark.createDataFrame(
        [(1, 1), (4, 1), (4, 0), (6, 1), (None, 1), (7, None), (8, 0)], "doc_id long, quality int"
    ).withColumn("_id", F.lit(3))
    got = quality.resample(docs, labels).collect()
    assert len(got) == len(edge_rows) and all(r.log_weight == 0 for r in got if r.doc_id in (1, 2, 8))
    assert len({(r.gumbel, r.kept) for r in got if r.doc_id == 5}) == 1
    assert all(r.kept for r in quality.resample(docs, labels.limit(0)).collect())
    assert quality.resample(docs.limit(0), labels).count() == 0
    assert quality.keep(docs, labels.limit(0)).columns == docs.columns


def test_gumbel_keys_sample_in_proportion(spark):
    df = spark.range(20_000).select(quality.gumbel_key(F.lit(0.0), F.col("id")).alias("g"))
    values = np.array([r.g for r in df.collect()])
    assert abs(values.mean() - 0.5772) < 0.03 and abs(values.var() - math.pi**2 / 6) < 0.06


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.0, 2.0], [5.0] * 7, [-1e300, 1e300, 0.0, 1e-300], list(range(-50, 50))])
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "g double")
    for k in range(1, len(values) + 1, max(1, len(values) // 7)):
        assert quality.kth_largest(df, "g", k, bins=4) == sorted(map(float, values), reverse=True)[k - 1]
