import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewick.llm import conversation_repair as repair
from tidewick.llm import queries

GOAL = re.compile(r"(s?(ua)+)?")
GRAMMAR = {"": "su", "s": "u", "u": "a", "a": "u"}


def every_audit(symbols, most):
    """(cost, audit) of all edit strings with at most ``most`` inserts whose roles fit, by trying them all."""
    found = []

    def go(i, roles, cost, audit, inserts):
        if i == len(symbols) and GOAL.fullmatch(roles):
            found.append((cost, audit))
        if inserts < most:
            for r in "ua":
                go(i, roles + r, cost + 5, audit + "I", inserts + 1)
        if i < len(symbols):
            go(i + 1, roles, cost + 2, audit + "D", inserts)
            if symbols[i] != "x":
                cut = 5 if symbols[i].isupper() else 0
                go(i + 1, roles + symbols[i].lower(), cost + cut, audit + "K", inserts)
                for r in "ua":
                    go(i + 1, roles + r, cost + cut + 1, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return min(found)


def greedy(symbols):
    """Least cost and audit by costs to go: of the edits on a cheapest way the least letter."""
    def edits(i, s):
        for r in "ua":
            if r in GRAMMAR[s]:
                yield "I", i, r, 5
        if i < len(symbols):
            yield "D", i + 1, s, 2
            if symbols[i] != "x":
                cut = 5 if symbols[i].isupper() else 0
                low = symbols[i].lower()
                if low in GRAMMAR[s]:
                    yield "K", i + 1, low, cut
                for r in "ua":
                    if r in GRAMMAR[s]:
                        yield "R", i + 1, r, 1 + cut

    togo = {(len(symbols), ""): 0, (len(symbols), "a"): 0, (len(symbols), "u"): 5, (len(symbols), "s"): 10}
    for i in reversed(range(len(symbols))):
        for s in GRAMMAR:
            togo[i, s] = min(c + togo[j, t] for e, j, t, c in edits(i, s) if e != "I")
        for _ in range(3):
            for s in GRAMMAR:
                togo[i, s] = min([togo[i, s], *[c + togo[j, t] for e, j, t, c in edits(i, s) if e == "I"]])
    i, s, out = 0, "", ""
    while i < len(symbols) or togo[i, s]:
        e, i, s, _ = min((e, j, t, c) for e, j, t, c in edits(i, s) if c + togo[j, t] == togo[i, s])
        out += e
    return togo[0, ""], out


def test_least_audits_of_all_short_conversations():
    for n in range(4):
        for symbols in itertools.product("suaoxUA", repeat=n):
            symbols = "".join(symbols)
            assert greedy(symbols) == every_audit(symbols, 2), symbols
            assert repair.chain([repair.solve(symbols)] if symbols else []) == greedy(symbols), symbols


def test_chunks_and_collisions_change_nothing():
    rng = random.Random(11)
    for _ in range(300):
        symbols = "".join(rng.choices("suaoxSUAO", [1, 6, 6, 1, 3, 1, 2, 2, 1], k=rng.randint(1, 40)))
        cuts = sorted(rng.sample(range(1, len(symbols)), rng.randint(0, min(4, len(symbols) - 1)))) if len(symbols) > 1 else []
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        want = greedy(symbols)
        assert repair.chain([repair.solve(p) for p in parts]) == want
        assert repair.chain([repair.solve(p, prime=3) for p in parts]) == want  # nearly every hash collides
        assert repair.chain([repair.solve(p, (0,) if k == 0 else (0, 1, 2, 3)) for k, p in enumerate(parts)]) == want


def test_audits_compare_like_strings():
    rng = random.Random(2)
    for prime in (2, 5, repair._PRIME):
        audits = repair.Audits(prime)
        for _ in range(400):
            audits.add(rng.randrange(max(0, len(audits.letters) - 9), len(audits.letters)), rng.choice("DK"))
        for _ in range(3000):
            x, y = rng.randrange(401), rng.randrange(401)
            assert audits.less(x, y) == (audits.text(x) < audits.text(y))


def brute(rows, is_damaged=False):
    """The report of (conv, turn, role, text) rows, damaged first."""
    out, by_conv = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = 5 if is_damaged else zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_conv[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:16], hashlib.sha256(r[2].encode()).digest()))
        seen, symbols, faults = set(), "", []
        for _, role, text in mine:
            inner = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            first = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else first.upper() if fault else first
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit = greedy(symbols)
        lines, left, state = [], list(mine), ""
        for edit in audit:
            if edit != "I":
                _, role, text = left.pop(0)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == "u" else "user"
            lines.append(f"{role}:{'' if edit == 'I' else text}")
            state = role[0]
        assert not left and GOAL.fullmatch("".join(x[0] for x in lines))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.fixture
def make_rows(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        return df.select("*", *[F.lit(c).alias(c) for c in ("conv", "digest", "audit", "line", "part", "copies", "_kind", "_conv")]).repartition(5)

    return make


ROWS = [
    (1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes"), (1, 5, "user", "Hi."), (1, 6, None, None), (1, None, "assistant", "early!"),
    (2, 3, "user", " \n\t "), (3, 0, "assistant", "é. \n"), (3, 1, "assistant", "ü ."), (None, 1, "user", "x."), (None, None, None, ""),
    (4, 0, "User", "cap?"), (4, 1, "", "no role."), (4, 1, "", "no role."), (5, None, "user", "a."), (5, None, "assistant", "b."),
    (6, 0, "user", "word " * 60_000 + "."), (6, 1, "assistant", "word " * 60_000), (2**62, 7, "system", "alone."),
] + [(7, i, "user" if i % 3 else "assistant", f"t{i % 50}" + ".!?"[i % 3]) for i in range(300)] + [(8, i, "user", f"t{i}.") for i in range(40) if i % 4 == 3]


def test_report_against_brute_force(make_rows):
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.report(make_rows(ROWS)).collect()}
    assert got == brute(ROWS)
    assert repair.report(make_rows(ROWS).limit(0)).count() == 0


def test_long_conversations_lie_in_many_partitions(spark, make_rows):
    rng = random.Random(4)
    rows = [(9, i, rng.choice(["user", "assistant", "user", "bot"]), rng.choice(["a.", "b", f"t{i}.", f"t{i}.", ""])) for i in range(3000)]
    rows += [(10, None, "user", "same.")] * 700 + [(11, 0, "user", "q."), (11, 1, "assistant", "r.")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair.audits(make_rows(rows), chunk=64)
        got = {r.conv_id: r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = brute(rows, is_damaged=True)
    assert {k: tuple(r[c] for c in COLUMNS[:-1]) for k, r in got.items()} == {k: v[:-1] for k, v in want.items()}
    lines = repair.repaired(make_rows(rows), found)
    assert {r.conv_id: r.repaired_sha256 for r in repair.fingerprints(lines).collect()} == {k: v[-1] for k, v in want.items() if k != 10}
    assert lines.where("conv_id = 10").count() == 0 and got[10].audit == "D" * 700


def test_names_may_be_strings(spark):
    rows = spark.createDataFrame([("x", 0, "user", "Hi."), ("x", 1, "assistant", "Ho.")], "c string, t int, r string, b string")
    got = repair.audits(rows, "c", "t", "r", "b")
    assert got.columns[0] == "c" and [(r.c, r.audit) for r in got.collect()] == [("x", "KK")]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_registered_query(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_conversation_repair"](spark, path).collect()}
    assert got == brute(rows)
