"""Personal data by anchor expansion.

One Aho-Corasick automaton walks every whole text once and reports anchors: at-signs, schemes, cue words of
identifiers, a plus before a digit, and two digits that touch or stand a dot, space or hyphen apart.  From an anchor the
parser of its kind expands to the left and right by fixed character classes and then validates what it spans: parts of an
address, number of digits, Luhn's sum.  An anchor before the end of its kind's last match is skipped, so matches of a
kind are leftmost and do not overlap, and a span that fails its validation is dropped without a second try.  Expansion never
crosses the anchor before it, so a text costs time in proportion to its length.

Kinds, in the order of the results: email, ip, card, phone (the base), and login (``scheme://user@host``), tel
(``tel:`` and a number), account (a cue word, then an identifier with six digits or more), pan (a run of 16 to 19
digits that passes Luhn, also inside a longer chain of numbers).

Defined results: positions count code points, ends are exclusive.  Null and empty texts have no findings; a text may have
any length; repeated rows give repeated results; an empty table gives an empty result.  ``find`` reads only the
key and text columns; ``mask`` keeps every column, whatever its name.
"""

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the kinds in the order of their spans
BASE = ["email", "ip", "card", "phone"]
MORE = ["login", "tel", "account", "pan"]
KINDS = BASE + MORE
# fixed values: words before an identifier; found in lower case, capitalised and in capitals
CUES = ["account", "acct", "iban", "passport", "ssn"]
LEAST_DIGITS = 6  # of an account's identifier

SLICE_ROWS = 1024
FINDING = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LOCAL = _LETTERS | _DIGITS | frozenset("._%+-")
_SCHEME = _LETTERS | _DIGITS | frozenset("+.-")

# what an anchor expands to on its right, and the digits in it
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_FOUR = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_RUN = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[^\x00-\x20/?#@]+@[A-Za-z0-9.-]+")
_TEL = re.compile(r"tel:\+?[0-9().-]+")
_IDENTIFIER = re.compile(r"(?:\x20(?:no|number))?[\x20.:#=]+([A-Z0-9-]+)")


class Anchor(NamedTuple):
    kind: str
    size: int


@cache
def anchors() -> ahocorasick.Automaton:
    """All anchors; one that serves several kinds carries them all."""
    digits = sorted(_DIGITS)
    texts = {"@": ["email"], "://": ["login"], "tel:": ["tel"]}
    texts |= {form: ["account"] for cue in CUES for form in (cue, cue.capitalize(), cue.upper())}
    texts |= {f"+{d}": ["phone"] for d in digits}
    texts |= {f"{a}.{b}": ["ip"] for a in digits for b in digits}
    texts |= {f"{a}{gap}{b}": ["card"] if gap else ["card", "pan"] for a in digits for gap in ("", " ", "-") for b in digits}
    found = ahocorasick.Automaton()
    for text, kinds in texts.items():
        found.add_word(text, [Anchor(kind, len(text)) for kind in kinds])
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _count(text: str) -> int:
    return sum(c in _DIGITS for c in text)


def _left(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


# a parser gets the text, the anchor's start and size, and the end of its kind's last match; it gives (start, end, valid),
# or no start and the place before which the kind has nothing


def _email(text: str, at: int, size: int, floor: int):
    start = _left(text, at, floor, _LOCAL)
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else (None, floor, False)


def _ip(text: str, at: int, size: int, floor: int):
    start = _left(text, at, floor, _DIGITS)
    four = _FOUR.match(text, start)
    if not four:
        return None, _DOTTED.match(text, start).end(), False
    parts = [p.lstrip("0") or "0" for p in four.group().split(".")]
    return start, four.end(), all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _card(text: str, at: int, size: int, floor: int):
    end = _CHAIN.match(text, at).end()
    digits = text[at:end].replace(" ", "").replace("-", "")
    return at, end, 16 <= len(digits) <= 19 and luhn(digits)


def _pan(text: str, at: int, size: int, floor: int):
    end = _RUN.match(text, at).end()
    return at, end, 16 <= end - at <= 19 and luhn(text[at:end])


def _phone(text: str, at: int, size: int, floor: int):
    found = _PHONE.match(text, at)
    return (at, found.end(), 8 <= _count(found.group()) <= 15) if found else (None, floor, False)


def _login(text: str, at: int, size: int, floor: int):
    start = _left(text, at, floor, _SCHEME)
    while start < at and text[start] not in _LETTERS:
        start += 1
    found = _LOGIN.match(text, at) if start < at else None
    return (start, found.end(), True) if found else (None, floor, False)


def _tel(text: str, at: int, size: int, floor: int):
    found = _TEL.match(text, at)
    return (at, found.end(), 7 <= _count(found.group()) <= 15) if found else (None, floor, False)


def _account(text: str, at: int, size: int, floor: int):
    found = _IDENTIFIER.match(text, at + size)
    return (at, found.end(), _count(found.group(1)) >= LEAST_DIGITS) if found else (None, floor, False)


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "login": _login, "tel": _tel, "account": _account, "pan": _pan}


def findings(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of every finding, by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {}
    done: dict[str, int] = {}
    for last, hits in anchors().iter(text):
        for kind, size in hits:
            at, floor = last - size + 1, done.get(kind, 0)
            if at >= floor:
                start, done[kind], valid = _PARSERS[kind](text, at, size, floor)
                if valid:
                    found.setdefault(kind, []).append((start, done[kind]))
    return [(kind, *span) for kind in KINDS if kind in found for span in found[kind]]


def _rows(column: pa.Array) -> Iterator[str]:
    """One text at a time, so that only Arrow holds the batch; null is empty."""
    for value in column:
        yield value.as_py() or ""


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``findings``, an array of (kind, start, end) by kind as listed, then start."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                mine = [[{"kind": k, "start": a, "end": b} for k, a, b in findings(t)] for t in _rows(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(mine, kind)], names=["_key", "findings"])

    schema = T.StructType([rows.schema["_key"], T.StructField("findings", FINDING)])
    return rows.mapInArrow(look, schema).withColumnRenamed("_key", key)


def masked(text: str) -> str:
    """Every finding replaced by its kind in brackets; of overlapping findings the union, named by the first."""
    out, end = [], 0
    for start, stop, kind in sorted((a, -b, KINDS.index(k)) for k, a, b in findings(text)):
        stop = -stop
        if start >= end:
            out += [text[end:start], f"[{KINDS[kind]}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the same columns and every finding in ``text`` masked; null stays null."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                new = pa.array([None if v.as_py() is None else masked(v.as_py()) for v in part.column(at)], part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([new if c == at else part.column(c) for c in range(part.num_columns)], schema=part.schema)

    return docs.mapInArrow(rewrite, docs.schema)


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of an array of findings, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of findings of each base kind, a hash of the base spans, and all spans."""
    found = find(docs)
    base = F.filter("findings", lambda f: f["kind"].isin(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE), F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("findings")).alias("spans")
    )
