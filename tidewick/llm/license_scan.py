"""Licence scans by a positional index of rare words.

Words are runs of lower-case letters, digits and non-ASCII characters after lower-casing A-Z.  The index posts every
template word with its positions; document frequencies are counted over all documents, for the templates' words only.
Of the files in which all mandatory key phrases of a template stand, the licence words are looked up from the highest IDF
down: each occurrence of a posted word gives an alignment (file position - template position).  Look-ups for a template end when
the words tried hold more than 1 - ``LEAST`` of its IDF, as an alignment without any of them cannot reach ``LEAST``; so
none is missed.  An alignment is verified: every mandatory phrase must stand, word by word, within ``SLACK`` words of where the
template has it, and the IDF share of template words found in place must reach ``LEAST``.  Base phrases are found wherever
their words stand consecutively.

Defined results: null or empty texts have no words, no labels and score 0; a text may have any length; repeated rows
give repeated results; an empty table gives an empty result.  Only the key and text columns are read.  The score is
the best verified IDF share, 1 where a base phrase stands.
"""

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.llm import texts

SLACK = 2
LEAST = 0.6


class Template(NamedTuple):
    label: str
    text: str
    phrases: tuple[str, ...]  # mandatory, each a part of ``text``


# fixed values: phrase and label
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

TEMPLATES = [
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license", "version 2 0"),
    ),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license", "version 3")),
    *[
        Template(
            label,
            f"free software you can redistribute it and or modify it under the terms of the {name} as published by the free "
            f"software foundation either version {version} of the license or at your option any later version",
            (f"{name} as published", f"version {version} of the license"),
        )
        for label, name, version in (
            ("gpl-2.0", "gnu general public license", "2"), ("gpl-3.0", "gnu general public license", "3"),
            ("lgpl", "gnu lesser general public license", "2 1"), ("lgpl", "gnu lesser general public license", "3"),
            ("agpl", "gnu affero general public license", "3"),
        )
    ],
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use", "source and binary forms"),
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
]

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(text: str) -> list[str]:
    raw = texts.lower_ascii(np.frombuffer(text.encode(), np.uint8))
    starts, ends, _ = texts.runs(_WORD[raw], np.array([0, len(raw)]))
    return [raw[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]


class Vocabulary:
    """The words of templates and base phrases, numbered by the order of their hashes."""

    def __init__(self, templates: Sequence[Template] = TEMPLATES, base: Sequence[tuple[str, str]] = BASE):
        self.templates, self.base = list(templates), list(base)
        names = sorted({w for t in templates for x in (t.text, *t.phrases) for w in words_of(x)} | {w for p, _ in base for w in words_of(p)})
        raw = np.frombuffer("".join(names).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in names])
        hashes = texts.hash_spans(raw, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64))
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.number = {names[k]: i for i, k in enumerate(order)}

    def ids(self, text: str) -> np.ndarray:
        return np.array([self.number[w] for w in words_of(text)])

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(word number or -1, row)`` of every word of a slice."""
        low = texts.lower_ascii(data)
        starts, ends, rows = texts.runs(_WORD[low], offsets)
        hashes = texts.hash_spans(low, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1), rows


def phrase_places(ids: np.ndarray, rows: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of ``phrase`` stand consecutively in one row."""
    at = np.flatnonzero(ids == phrase[0])
    at = at[at + len(phrase) <= len(ids)]
    at = at[rows[at] == rows[at + len(phrase) - 1]] if len(at) else at
    for k in range(1, len(phrase)):
        at = at[ids[at + k] == phrase[k]]
    return at


class Index:
    """Postings of all template words, for given IDFs."""

    def __init__(self, words: Vocabulary, idf: np.ndarray):
        self.words, self.idf = words, idf
        self.bodies = [words.ids(t.text) for t in words.templates]
        self.keys, self.tried = [], []
        for t, body in enumerate(self.bodies):
            keys = []
            for phrase in words.templates[t].phrases:
                want = words.ids(phrase)
                first = next(k for k in range(len(body)) if (body[k : k + len(want)] == want).all() and k + len(want) <= len(body))
                keys.append((first, want))
            self.keys.append(keys)
            # words by IDF; those before the last one needed hold at most 1 - LEAST of it
            names = np.unique(body)
            names = names[np.argsort(-idf[names], kind="stable")]
            held = np.cumsum([idf[body[body == w]].sum() for w in names])
            needed = int(np.searchsorted(held, (1 - LEAST) * held[-1] * (1 + 1e-9), "right")) + 1
            self.tried.append([(w, np.flatnonzero(body == w)) for w in names[:needed]])

    def alignments(self, ids: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, template, share)`` of every verified alignment of a slice."""
        none = np.zeros(0, np.int64)
        out_row, out_t, out_share = [], [], []
        for t, body in enumerate(self.bodies):
            places = [phrase_places(ids, rows, want) for _, want in self.keys[t]]
            has = np.ones(n_rows, bool)
            for at in places:
                has &= np.bincount(rows[at], minlength=n_rows) > 0
            if not has.any():
                continue
            known = np.flatnonzero(has[rows])
            tops = []
            for word, inside in self.tried[t]:
                hits = known[ids[known] == word]
                tops.append((hits[:, None] - inside[None, :]).ravel() * np.int64(n_rows) + np.repeat(rows[hits], len(inside)))
            pair = np.unique(np.concatenate([none, *tops]))
            top, row = pair // n_rows, pair % n_rows
            good = np.ones(len(row), bool)
            for (first, _), at in zip(self.keys[t], places, strict=True):
                near = np.zeros(len(row), bool)
                for shift in range(-SLACK, SLACK + 1):
                    want = top + first + shift
                    k = np.minimum(np.searchsorted(at, want), len(at) - 1)
                    near |= (at[k] == want) & (rows[at[k]] == row)
                good &= near
            row, top = row[good], top[good]
            total = np.zeros(len(row))
            for k, word in enumerate(body):
                at = top + k
                inside = (at >= 0) & (at < len(ids))
                safe = np.where(inside, at, 0)
                total += np.where(inside & (rows[safe] == row) & (ids[safe] == word), self.idf[word], 0.0)
            share = total / max(self.idf[body].sum(), 1e-12)
            good = share >= LEAST
            out_row.append(row[good])
            out_t.append(np.full(int(good.sum()), t))
            out_share.append(np.minimum(share[good], 1.0))
        return np.concatenate([none, *out_row]), np.concatenate([none, *out_t]), np.concatenate([np.zeros(0), *out_share])


def document_frequencies(docs: DataFrame, words: Vocabulary, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents, and documents with each vocabulary word; the driver gets one sum per word."""
    n = len(words.hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + 1, np.int64)
        for batch in batches:
            total[n] += batch.num_rows
            for _, _, data, offsets in texts.slices(batch.column(0)):
                ids, rows = words.read(data, offsets)
                known = ids >= 0
                pairs = np.unique(rows[known] * n + ids[known], return_index=True)[0]
                total[:n] += np.bincount(pairs % n, minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 1)), pa.array(total)], names=["word", "n"])

    found = docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n + 1, np.int64)
    for word, k in found:
        out[word] = k
    return int(out[n]), out[:n]


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    templates: Sequence[Template] = TEMPLATES, base: Sequence[tuple[str, str]] = BASE,
) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = Vocabulary(templates, base)
    n, df = document_frequencies(docs, words, text)
    index = Index(words, np.log((n + 1) / (df + 1)) + 1e-6)
    phrases = [(words.ids(p), label) for p, label in base]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, size, data, offsets in texts.slices(batch.column(1)):
                ids, row = words.read(data, offsets)
                n_words = np.bincount(row, minlength=size)
                first = np.cumsum(n_words) - n_words
                n_base, low, high = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
                score = np.zeros(size)
                base_labels: dict[int, set[str]] = {}
                labels: dict[int, set[str]] = {}
                for phrase, label in phrases:
                    at = phrase_places(ids, row, phrase)
                    r = row[at]
                    place = at - first[r]
                    n_base += np.bincount(r, minlength=size)
                    np.minimum.at(low, r, place)
                    np.maximum.at(high, r, place)
                    for x in np.unique(r).tolist():
                        base_labels.setdefault(x, set()).add(label)
                score[n_base > 0] = 1.0
                for r, t, share in zip(*index.alignments(ids, row, size), strict=True):
                    labels.setdefault(int(r), set()).add(words.templates[t].label)
                    score[r] = max(score[r], share)
                def joined(x):
                    return ",".join(sorted(x))

                missing = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, size), pa.array(n_words), pa.array(n_base),
                        pa.array(low, mask=missing), pa.array(high, mask=missing),
                        pa.array([joined(base_labels.get(r, ())) for r in range(size)]),
                        pa.array([joined(base_labels.get(r, set()) | labels.get(r, set())) for r in range(size)]),
                        pa.array(score),
                    ],
                    names=["_key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    schema = (
        f"_key {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double"
    )
    return rows.mapInArrow(look, schema).withColumnRenamed("_key", key)
