import random

from pyspark.sql import functions as F

import corpus_pipeline
from tidewick.llm import jaccard_join, secret_scan

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "secret scans", "packing"
    ]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.materialise(stage(spark, seen[-1], SF), "test"))
    for df in seen[1:-1]:
        assert df.columns == columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in seen]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] and ids[3] == ids[4] == ids[5]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d in ids[0] if quality.get(d) == 1]
    assert sum(d in ids[1] for d in good) >= 0.98 * len(good)
    low = [(r.text or "").lower() for r in seen[2].collect()]
    assert len(set(low)) == len(low)
    left = jaccard_join.groups(seen[3]).collect()
    assert len({r.component_id for r in left}) == len(left)
    assert all(not r.findings for r in secret_scan.scan(seen[4]).collect())
    assert all(r.n_chars == len(r.text) for r in seen[4].collect())


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def five_word_sets(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_near_copies_are_those_of_five_words(spark):
    rng = random.Random(5)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(10_000)}" for _ in range(203)]
        more = [f"v{rng.randrange(10_000)}" for _ in range(40 + i // 4)]
        edited = list(words)
        for at in rng.sample(range(5, 195), 1 + i % 6):
            edited[at] = f"x{at}"
        rows += [(10 * i + 2, " ".join(words)), (10 * i + 1, " ".join(words + more)), (10 * i + 3, " ".join(edited))]
    sets = [five_word_sets(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    least = {}
    for (key, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, key), key)
    left = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), SF)
    assert sorted(r.doc_id for r in left.collect()) == sorted(least.values())
    assert len(least) < len({r.component_id for r in jaccard_join.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()})


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialise(stage(spark, out[-1], SF), "test"))
    return out


def test_odd_rows_and_clashing_names(spark, make_docs, edge_rows):
    secret = "the password: hunter2hunter2 is written here again and again in this text"
    rows = edge_rows + [(20, secret), (20, secret), (21, secret.upper()), (22, secret), (23, None)]
    docs = make_docs(rows).withColumns({"n_before": F.lit(7), "n_chars": F.when(F.col("doc_id") != 4, F.char_length("text"))})
    seen = stages(spark, docs)
    assert all(df.columns == docs.columns for df in seen[1:-1])
    kept = [{(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()} for df in seen[1:5]]
    assert [len(k) for k in kept[1:]] == [df.count() for df in seen[2:5]]  # no row twice once the copies are gone
    assert kept[0] >= kept[1] >= kept[2]
    low = [(t or "").lower() for _, t in kept[1]]
    assert len(low) == len(set(low))
    if any("hunter2" in low_text for low_text in low):
        assert any("[secret]" in (t or "") for _, t in kept[3])
    assert not any("hunter2" in (t or "").lower() for _, t in kept[3])
    for r in seen[4].collect():
        assert r.n_before == 7 and (r.n_chars is None or r.n_chars == len(r.text))
    packed = {r.doc_id for r in seen[5].select("doc_id").collect()}
    assert packed == {k for k, _ in kept[3]}


def test_tables_without_lengths_and_empty_ones(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).drop("n")
    seen = stages(spark, docs)
    assert "n_chars" not in seen[4].columns and seen[5].count() >= seen[4].count()
    assert [df.count() for df in stages(spark, docs.limit(0))] == [0] * 6
