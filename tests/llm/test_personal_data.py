import hashlib
import random
import re

import pytest

from tidewick.llm import personal_data, queries

_CUES = "|".join(f for c in personal_data.CUES for f in (c, c.capitalize(), c.upper()))
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "login": r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/?#@]+@[A-Za-z0-9.-]+",
    "tel": r"tel:\+?[0-9().-]+",
    "account": rf"({_CUES})(\x20no|\x20number)?[\x20.:#=]+([A-Z0-9-]+)",
    "pan": r"[0-9]+",
}


def checksum(digits):
    doubled = [int(c) for c in digits]
    for i in range(len(doubled) - 2, -1, -2):
        doubled[i] = sum(divmod(2 * doubled[i], 10))
    return sum(doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "ip": lambda: all(int(p[-4000:]) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and checksum(digits),
                "pan": lambda: 16 <= len(digits) <= 19 and checksum(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
                "tel": lambda: 7 <= len(digits) <= 15,
                "account": lambda: len(re.sub("[^0-9]", "", m[3])) >= 6,
            }.get(kind, lambda: True)()
            if good:
                out.append((kind, *m.span()))
    return out


ROWS = [
    (301, "é a.b+c%d@x-1.example.com, a@b@c.d. x@y.z@w.v @no.pe me@host a@b..c ümlaut@x.de"),
    (302, "1.2.3.4.5.6.7.8 256.1.1.1 10.0.0.255 001.0002.3.4 1.2.3 9..8 1.2.3.4.5.6.7"),
    (303, "4111 1111-1111 1111 and 4111111111111111 4111111111111112x 4111111111111111-4111111111111111 1 2"),
    (304, "+1 (017) 555-7713 rest +12 +1 2 +49 30 1234567 ++44 20 7946 0958 +1--------- +12345678901234567"),
    (305, "see https://user:pa%20ss@host.example/x 1a+b://x@y ftp://@z a://b@c://d@e tel:+1(212)555-0100 tel:12"),
    (306, "Account no: AB-123456 acct #999999 IBAN DE89370400440532013000 SSN 078-05-1120 account none ACCOUNT 12345 passport numberX"),
    (307, "1" * 5000 + ".2.3.4 " + "0" * 5000 + "1.2.3.4"),
    (308, ("wörter 🙂 mail.77@mail3.example.com and +1 (321) 555-0000; " * 2000)),
]


def test_findings_against_finditer(make_docs, edge_rows):
    rows = edge_rows + ROWS + ROWS[:1]
    got = personal_data.find(make_docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(k) for k, _ in rows)
    want = dict(reversed(rows))
    for r in got:
        assert [tuple(f) for f in r.findings] == brute(want[r.doc_id]), r.doc_id
    assert {f.kind for r in got for f in r.findings} == set(personal_data.KINDS)
    assert personal_data.find(make_docs(rows).limit(0)).count() == 0


def test_random_strings_of_anchors():
    rng = random.Random(5)
    parts = ["@", ".", "-", " ", "+", "1", "25", "999", "4111111111111111", "a", "Zz", "://", ":", "tel:", "account", " no", "IBAN", "#", "é", "(", "/"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 24)))
        assert personal_data.findings(text) == brute(text), text


def test_masks(make_docs, edge_rows):
    docs = make_docs(edge_rows + ROWS)
    got = personal_data.mask(docs)
    assert got.schema == docs.schema
    texts = {r.doc_id: r.text for r in got.collect()}
    assert all(texts[k] == t for k, t in edge_rows)
    assert texts[303] == "[card] and [pan] 4111111111111112x [pan]-[pan] 1 2"
    assert texts[305].startswith("see [login]/x")
    assert personal_data.mask(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_registered_query(spark, sf):
    got = {r.doc_id: r for r in queries.QUERIES["op13_personal_data"](spark, f"/root/testdata/{sf}").collect()}
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()
    assert len(docs) == len(got)
    for d in docs:
        spans, r = brute(d.text), got[d.doc_id]
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in personal_data.BASE)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in personal_data.BASE]
