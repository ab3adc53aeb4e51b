import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewick.llm import packing, segmentations, texts, token_files, token_units

BYTES, WORDS = token_units.vocabulary("byte_bpe_50k.json"), token_units.vocabulary("word_bpe_49k.json")
PIECES = token_units.vocabulary("piece_bpe_32k.model")
TOKENIZERS = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


def ids_of(path, text, end):
    return [*TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def unit_ids(path, fold, rows):
    out = []
    for _, ids, bounds in token_units.encoder(path, fold).documents(pa.array(rows, pa.string()), 1):
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


TEXT = st.text(st.sampled_from(list("aB'.,! \n\t\r\x0b\xa0\u2003\x1cé漢1٣🙂<|>sSΣσt-_")), max_size=40)


@pytest.mark.parametrize("path,fold", [(BYTES, False), (WORDS, True)])
@given(rows=st.lists(TEXT, min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_units_give_the_ids_of_whole_texts(path, fold, rows):
    assert unit_ids(path, fold, rows) == [ids_of(path, t, 1) for t in rows]


def test_units_with_special_tokens_and_a_small_store(monkeypatch, edge_rows):
    monkeypatch.setattr(token_units, "KEPT", 3)
    rows = [t for _, t in edge_rows] + ["a<|endoftext|>b", "<|startoftext|> x", None]
    for path, fold in ((BYTES, False), (WORDS, True)):
        for _ in range(2):
            assert unit_ids(path, fold, rows) == [ids_of(path, t, 1) for t in rows]


# --- packing


def check_packing(rows, got):
    want = Counter()
    for key, text in rows:
        ids = ids_of(BYTES, text, 0)
        for at in range(0, len(ids), 1024):
            part = ids[at : at + 1024]
            want[(key, at, len(part), crc(part), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return places


def test_packing_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    check_packing(edge_rows, packing.digests(docs, BYTES).collect())
    assert packing.digests(docs.limit(0), BYTES).count() == 0
    whole = packing.pack(docs, BYTES).select("doc_id", "start", "ids").collect()
    got = defaultdict(list)
    for r in sorted(whole, key=lambda r: r.start):
        got[r.doc_id].extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got[6] == ids_of(BYTES, dict(edge_rows)[6], 0) and got[1] == [0]


def test_packing_in_groups_wastes_little(make_docs):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["word"] * int(rng.integers(1, 1500)))) for i in range(600)]
    docs = make_docs(rows)
    stored = packing.materialise(packing.pieces(docs, BYTES, 0).withColumn("ids_crc32", F.crc32("ids")), "pieces")
    got = packing.assign(stored, group=100).withColumnRenamed("_key", "doc_id").collect()
    places = check_packing(rows, got)
    used = sum(length for parts in places.values() for _, length in parts)
    assert used / (1024 * len(places)) > 0.95


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=100, deadline=None)
def test_first_fit_decreasing(lengths):
    bins, offsets, used = packing.first_fit_decreasing(np.array(lengths, np.int64), 50)
    free = []
    for k in np.argsort(-np.array(lengths, np.int64), kind="stable"):
        at = next((i for i, f in enumerate(free) if f >= lengths[k]), len(free))
        if at == len(free):
            free.append(50)
        assert (bins[k], offsets[k]) == (at, 50 - free[at])
        free[at] -= lengths[k]
    assert used == len(free)


# --- token files


@given(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=300))
@settings(max_examples=100, deadline=None)
def test_codes_give_any_token(ids):
    codes = token_files.Codes(token_files.encode(np.array(ids, np.uint32)))
    assert len(codes) == len(ids)
    places = np.random.default_rng(len(ids)).permutation(len(ids))
    assert codes.take(places).tolist() == [ids[p] for p in places]


@pytest.mark.parametrize("segment", [1 << 17, 50])
def test_token_files_round_trip(spark, make_docs, edge_rows, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", segment)
    rows = edge_rows + [(100 + i, f"Text number {i}") for i in range(40)]
    path = str(tmp_path / "tokens")
    token_files.write(make_docs(rows), path, WORDS, 2)
    got = token_files.read(spark, path).orderBy("start").collect()
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    texts_of = defaultdict(list)
    for k, t in rows:
        texts_of[k].append(ids_of(WORDS, t, 2))
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and ids in texts_of[r.doc_id]
        at += len(ids)
    assert len(got) == len(rows)


def test_token_files_of_nothing(spark, make_docs, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(make_docs([(1, "x")]).limit(0), path, WORDS, 2)
    assert token_files.read(spark, path).count() == 0


# --- segmentations


def all_segmentations(model, text):
    """Log probability of every segmentation."""
    raw = b" " + text.encode() if text else b""
    known = {b: i for i, b in enumerate(model.bytes) if model.weight[i] > -np.inf}
    out = {}

    def go(at, path, weight):
        if at == len(raw):
            out[path] = weight
            return
        size = next(k for k in range(1, 5) if at + k == len(raw) or raw[at + k] & 0xC0 != 0x80)
        if raw[at : at + size] not in known:
            go(at + size, path + tuple(int(model.byte_id[b]) for b in raw[at : at + size]), weight + model.byte_weight * size)
        for end in range(at + 1, len(raw) + 1):
            if (piece := known.get(raw[at:end])) is not None:
                go(end, (*path, piece), weight + model.weight[piece])

    go(0, (), 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {p: w - total for p, w in out.items()}


def draw(text, n, k):
    model = segmentations.model(PIECES)
    rows = []
    for _, m, data, offsets in texts.slices(pa.array([text] * n), 1 << 30):
        lat, samples, after = segmentations.slice_samples(model, data, offsets, np.arange(m, dtype=np.uint64) * 7919, k)
        for s in samples:
            ids, bounds = segmentations.ids_of(model, lat, s.edges, s.bounds)
            rows.append([tuple(ids[a:b].tolist()) if h else None for a, b, h in zip(bounds[:-1], bounds[1:], s.has, strict=True)])
            assert (s.value[s.has] > after[s.has]).all()
    return model, rows, samples, after


@pytest.mark.parametrize("text", ["the cat", "é漢", " a  b", "x\ny", "hats"])
def test_samples_without_replacement(text):
    n, k = 8000, 3
    model, rows, samples, after = draw(text, n, k)
    want = all_segmentations(model, text)
    for row in zip(*rows, strict=True):
        some = [p for p in row if p is not None]
        assert len(set(some)) == len(some) == min(k, len(want)) and set(some) <= set(want)
    p = {s: np.exp(w) for s, w in want.items()}
    first, second = Counter(rows[0]), Counter(rows[1])
    for s in sorted(p, key=p.get)[-5:]:
        assert abs(first[s] / n - p[s]) < 5 * np.sqrt(p[s] / n) + 1e-3
        then = sum(p[a] * p[s] / (1 - p[a]) for a in p if a != s)
        assert abs(second[s] / n - then) < 5 * np.sqrt(then / n) + 1e-3
    # inclusion scores weigh the samples to a total of one (Horvitz-Thompson)
    total = np.zeros(n)
    for s in samples:
        with np.errstate(over="ignore"):
            total += np.where(s.has, np.exp(s.log_prob) / -np.expm1(-np.exp(s.log_prob - after)), 0)
    assert abs(total.mean() - 1) < 0.02


def test_segmentations_round_trip(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    encoded = segmentations.encode(docs, PIECES)
    got = segmentations.decode(encoded, PIECES).collect()
    known = defaultdict(set)
    for k, t in edge_rows:
        known[k].add(t or "")
    assert {r.doc_id for r in got} == {k for k, _ in edge_rows}
    for r in got:
        assert r.text in known[r.doc_id] and r.n_pieces == len(r.ids) and 0 <= r.inclusion <= 1
    empty = [r for r in got if r.doc_id in (1, 2)]
    assert [(r.sample, r.n_pieces, r.log_prob, r.inclusion) for r in empty] == [(1, 0, 0.0, 1.0)] * 2
    by = {(r.doc_id, r.sample): r.ids for r in got}
    assert by[4, 1] != by[4, 2]
    again = segmentations.encode(docs.repartition(1), PIECES).collect()
    assert {(r.doc_id, r.sample): r.ids for r in again} == by
    digests = {(r.doc_id, r.sample): r for r in segmentations.encode(docs, PIECES, digests=True).collect()}
    assert all(digests[k].ids_crc32 == crc(ids) for k, ids in by.items())
    assert digests[6, 2].text_crc32 == zlib.crc32(dict(edge_rows)[6].encode())
    assert segmentations.encode(docs.limit(0), PIECES).count() == 0


def test_library_decodes_the_samples_too(spark):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50)
    texts_of = {r.doc_id: r.text for r in docs.collect()}
    for r in segmentations.encode(docs, PIECES).collect():
        assert sp.decode(r.ids) == texts_of[r.doc_id]


@pytest.mark.parametrize("text", ["hatshats", "in on at"])
def test_unlikely_segmentations_are_drawn_too(text):
    """More samples than segmentations: all come, those of a log probability far below any threshold as well."""
    n = 20
    want = all_segmentations(segmentations.model(PIECES), text)
    k = len(want) + 1
    assert k < 200
    _, rows, samples, after = draw(text, n, k)
    for row in zip(*rows, strict=True):
        assert set(row[:-1]) == set(want) and row[-1] is None
    assert (after == -np.inf).all()
    for s in samples[:-1]:
        assert (s.value > -np.inf).all()


def test_masses_of_siblings_are_exact_however_small():
    model = segmentations.model(PIECES)
    data = np.frombuffer(" international  statement".encode(), np.uint8)
    lat = segmentations.lattice(model, data, np.array([0, len(data)]))
    for node in np.flatnonzero(lat.count):
        mine = np.arange(lat.first[node], lat.first[node] + lat.count[node])
        for e in mine:
            others = lat.logp[mine[mine != e]]
            assert lat.rest[e] == -np.inf if len(mine) == 1 else abs(lat.rest[e] - np.logaddexp.reduce(others)) < 1e-9


def test_query_digests_are_of_real_ids_and_decoded_texts(spark, make_docs, edge_rows, monkeypatch):
    """The query goes through ``encode`` and ``decode``: rows of ids in small slices, nulls kept."""
    monkeypatch.setattr(segmentations, "DECODED", 7)
    called = []
    real = segmentations.decode
    monkeypatch.setattr(segmentations, "decode", lambda *a, **b: called.append(1) or real(*a, **b))
    docs = make_docs(edge_rows)
    digests = segmentations.encode(docs, PIECES, digests=True).collect()
    assert called and {r.text_crc32 for r in digests} == {zlib.crc32((t or "").encode()) for _, t in edge_rows}
    ids = [900, 901, 902]
    lists = spark.createDataFrame([(1, None), (2, []), (3, ids)], "n int, ids array<int>")
    packed = spark.createDataFrame([(1, None), (2, b""), (3, np.array(ids, "<u4").tobytes())], "n int, ids binary")
    said = [{r.n: r.said for r in segmentations.decode(df, PIECES, out="said").collect()} for df in (lists, packed)]
    assert said[0] == said[1] and said[0][1] is None and said[0][2] == "" and said[0][3]


def test_rows_far_from_any_likely_segmentation(monkeypatch):
    """The same samples wherever a path's near part ends: rows without enough groups there look behind it."""
    texts_of = ["the cat sat on the mat and " * 9, "hatshats", "", "x"]
    rows = pa.array(texts_of * 25)
    model = segmentations.model(PIECES)
    seen = []
    for near in (-64.0, -0.5, -1e9):
        monkeypatch.setattr(segmentations, "NEAR", near)
        for sampled in (1 << 18, 100):
            monkeypatch.setattr(segmentations, "SAMPLED", sampled)
            found = []
            for i, lat, samples, after in segmentations._parts(model, rows, np.arange(100, dtype=np.uint64) * 7919, 4):
                for r in range(len(after)):
                    of = [tuple(s.edges[s.bounds[r] : s.bounds[r + 1]].tolist()) for s in samples]
                    found.append((i + r, of, [round(float(s.value[r]), 6) for s in samples], round(float(after[r]), 6)))
            seen.append(found)
    assert len(seen[0]) == 100 and all(x == seen[0] for x in seen[1:])
