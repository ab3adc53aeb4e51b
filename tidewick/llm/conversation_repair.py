"""Conversation structure repair by a persistent audit DP.

Rows of a conversation go by turn (null first), ties by the first ``PREFIX`` characters of role and text and then by a digest, so that
equal rows stand together.  A row's first fault counts: blank, duplicate (role and text seen earlier), truncated.  Every
row is kept (K), given the other role (R) or deleted (D), empty rows are inserted (I), so that the role initials become
``(s?(ua)+)?`` at the least cost; of equal costs the ASCII-least audit, the string of edits, wins.

Four states know which roles may follow: nothing yet, after s, after u, after a.  For each state the DP holds the
cost and the audit, which is a node: a letter and a link to the audit before it, so that audits share their beginnings.
Nodes hold binary-lifting ancestors and the rolling hash of their audit; of two audits of equal cost the longest common
prefix is found by hashes of ancestors, verified by walking the links, and the letter behind it decides.  Letters
determine states, so no audit of equal cost and state begins another, and the lesser one stays so whatever follows.

No conversation is gathered.  Facts without texts are sorted by range, so a conversation may lie in many partitions, and
cut into chunks of ``CHUNK`` rows; a chunk gives its counts and, for every pair of states, cost, audit and the order of
audits from one state.  An audit of a chunk ends with a row's edit (inserts come before rows or at the very end), so the
order within a chunk decides wherever costs are equal.  One pass per conversation over its chunks adds up costs from the
end and picks audits from the start; it holds 16 letters a row, its result one.  Texts are shuffled once: the audit
of a conversation and then its rows in order stream through one task, which holds the audit and one batch.

Defined results: a null role or text is one space, a null conversation is a conversation, null turns come first; texts may have any
length; repeated rows are duplicates; an empty table gives empty results.  Other columns are not read.
"""

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewick.session import materialise

CHUNK = 1024
PREFIX = 16
SHORT = 24  # chunks up to this length are solved once per worker
# fixed values: white space, costs, and the two roles that edits give
SPACE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

# states: nothing yet, after s, after u, after a
STATES = range(4)
AFTER = {"s": 1, "u": 2, "a": 3}
MAY = ("su", "u", "a", "u")  # initials that may follow a state
GIVEN = ("u", "u", "a", "u")  # the role that a rerole or an insert gives there
END = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]  # the inserts that finish a conversation
LEGAL = {"su", "ua", "au"}

_BASE, _PRIME = 257, (1 << 61) - 1


class Audits:
    """Strings of edits as linked nodes; node 0 is the empty one."""

    def __init__(self, prime: int = _PRIME):
        self.prime = prime
        self.letters, self.depths, self.hashes, self.ups = [""], [0], [0], [[]]

    def add(self, parent: int, letter: str) -> int:
        """The node of ``parent``'s string and one more letter; ups[k] is the ancestor 2**k letters before."""
        ups = [parent]
        while len(self.ups[ups[-1]]) >= len(ups):
            ups.append(self.ups[ups[-1]][len(ups) - 1])
        self.letters.append(letter)
        self.depths.append(self.depths[parent] + 1)
        self.hashes.append((self.hashes[parent] * _BASE + ord(letter)) % self.prime)
        self.ups.append(ups)
        return len(self.letters) - 1

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letters[node])
            node = self.ups[node][0]
        return "".join(reversed(out))

    def _at(self, node: int, depth: int) -> int:
        while self.depths[node] > depth:
            far = (self.depths[node] - depth).bit_length() - 1
            node = self.ups[node][far]
        return node

    def _equal(self, x: int, y: int) -> bool:
        """Whether two strings of one length are equal, letter by letter up to the node they share."""
        while x != y:
            if self.letters[x] != self.letters[y]:
                return False
            x, y = self.ups[x][0], self.ups[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether x's string is less than y's."""
        depth = min(self.depths[x], self.depths[y])
        a, b = self._at(x, depth), self._at(y, depth)
        if self.hashes[a] == self.hashes[b]:
            if self._equal(a, b):
                return self.depths[x] < self.depths[y]
            return self.text(x) < self.text(y)
        # the shallowest ancestors that differ: their parents end the common prefix
        for k in reversed(range(len(self.ups[a]))):
            if k < len(self.ups[a]) and self.hashes[self.ups[a][k]] != self.hashes[self.ups[b][k]]:
                a, b = self.ups[a][k], self.ups[b][k]
        if self._equal(self.ups[a][0], self.ups[b][0]):
            return self.letters[a] < self.letters[b]
        return self.text(x) < self.text(y)

    def least(self, options: list[tuple[int, int]]) -> tuple[int, int]:
        """Of (cost, node) the cheapest, then the least string."""
        cost = min(c for c, _ in options)
        nodes = [n for c, n in options if c == cost]
        best = nodes[0]
        for node in nodes[1:]:
            if self.less(node, best):
                best = node
        return cost, best


def _step(audits: Audits, best: list, symbol: str) -> list:
    """The four states after one row: a role initial or o (capital: truncated), or x (must go)."""
    # inserts before the row: into u from all but u, then into a
    for target, sources in ((2, (0, 1, 3)), (3, (2,))):
        known = [best[s][0] + INSERT for s in sources if best[s]]
        least = min([*known, *([best[target][0]] if best[target] else [])], default=None)
        options = [(least, audits.add(best[s][1], "I")) for s in sources if best[s] and best[s][0] + INSERT == least]
        if best[target]:
            options.append(best[target])
        if options:
            best = [*best[:target], audits.least(options), *best[target + 1 :]]
    cut, initial = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
    options: list[list] = [[] for _ in STATES]
    for s in STATES:
        if not best[s]:
            continue
        cost, node = best[s]
        options[s].append((cost + DELETE, node, "D"))
        if symbol != "x":
            if initial in MAY[s]:
                options[AFTER[initial]].append((cost + KEEP + cut, node, "K"))
            options[AFTER[GIVEN[s]]].append((cost + REROLE + cut, node, "R"))
    out = []
    for mine in options:
        least = min((c for c, _, _ in mine), default=None)
        found = [(c, audits.add(n, letter)) for c, n, letter in mine if c == least]
        out.append(audits.least(found) if found else None)
    return out


def solve(symbols: str, starts: tuple = tuple(STATES), prime: int = _PRIME) -> tuple[list, list, list]:
    """For the start states and every end state (4 * start + end): cost (None: impossible), place among the start's audits, audit."""
    costs, places, texts = [None] * 16, [None] * 16, [None] * 16
    for start in starts:
        audits = Audits(prime)
        best: list = [None] * 4
        best[start] = (0, 0)
        for symbol in symbols:
            best = _step(audits, best, symbol)
        order = cmp_to_key(lambda x, y: -1 if audits.less(best[x][1], best[y][1]) else 1)
        for place, end in enumerate(sorted([e for e in STATES if best[e]], key=order)):
            at = 4 * start + end
            costs[at], places[at], texts[at] = best[end][0], place, audits.text(best[end][1])
    return costs, places, texts


_solved = lru_cache(1 << 15)(solve)


def chain(chunks: list[tuple[list, list, list]]) -> tuple[int, str]:
    """The least cost and audit of a conversation from those of its chunks; the first may know only the first state."""
    rest = [cost for cost, _ in END]
    behind = [rest]
    for costs, _, _ in reversed(chunks):
        rest = [min((costs[4 * s + e] + rest[e] for e in STATES if costs[4 * s + e] is not None), default=None) for s in STATES]
        behind.append(rest)
    out, state = [], 0
    for (costs, places, texts), rest in zip(chunks, behind[-2::-1], strict=True):
        ends = [e for e in STATES if costs[4 * state + e] is not None]
        end = min(ends, key=lambda e: (costs[4 * state + e] + rest[e], places[4 * state + e]))
        out.append(texts[4 * state + end])
        state = end
    return behind[-1][0], "".join([*out, END[state][1]])


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damage by ``crc32(conv_id:turn) % 20``; nulls of role and text become one space."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    d = rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("_kind"),
    ).where("_kind <> 0")
    copies = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))
    return d.select("conv_id", "turn", "role", "text", F.explode(copies).alias("_copy")).drop("_copy")


def _named(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Columns of our own: conv, turn, role, text, the order of ties, and a digest of conversation, role and text."""
    space = F.lit(" ")
    d = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
    )
    parts = F.concat_ws(":", F.coalesce(F.char_length(F.col("conv").cast("string")), F.lit(-1)), "conv", F.char_length("role"), "role", "text")
    return d.select(
        "*", F.substring("role", 1, PREFIX).alias("by_role"), F.substring("text", 1, PREFIX).alias("by_text"),
        F.unhex(F.sha2(parts.cast("binary"), 256)).alias("digest"),
    )


def _order(*first: str) -> list[Column]:
    return [F.asc_nulls_first(c) for c in (*first, "turn", "by_role", "by_text", "digest")]


def facts(named: DataFrame) -> DataFrame:
    """Rows without texts, equal ones as one with their number: conv, turn, order columns, initial, fault flags, first, copies."""
    inner = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = named.select(
        "conv", "turn", "by_role", "by_text", "digest",
        F.when(initial.isin(*AFTER), initial).otherwise("o").alias("initial"),
        (inner == "").alias("blank"),
        (~F.coalesce(F.right(inner, F.lit(1)).isin(".", "!", "?"), F.lit(False))).alias("truncated"),
    )
    same = ["conv", "turn", "by_role", "by_text", "digest", "initial", "blank", "truncated"]
    rows = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    seen = rows.where("not blank").groupBy(F.col("digest").alias("seen")).agg(
        F.max(F.col("turn").isNull()).alias("early"), F.min("turn").alias("earliest")
    )
    first = F.when(F.col("early"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("earliest"))
    return rows.join(seen, (F.col("digest") == F.col("seen")) & ~F.col("blank"), "left").select(
        *same, F.coalesce(first, F.lit(False)).alias("first"), "copies"
    )


_COUNTS = ["n", "distinct", "blank", "duplicate", "truncated", "illegal"]
_CHUNK = {
    "part": "int", "number": "long", "low": "long", "high": "long", "head": "string", "tail": "string", **dict.fromkeys(_COUNTS, "long"),
    "costs": "array<long>", "places": "array<int>", "texts": "array<string>",
}
_RESULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_ARROW = {
    "bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
}


def _columns(kind: str, others: dict[str, str]) -> str:
    return f"conv {kind}, " + ", ".join(f"{c} {t}" for c, t in others.items())


def _batch(rows: list[tuple], kind: str, others: dict[str, str]) -> pa.RecordBatch:
    types = [_ARROW[t] for t in (kind, *others.values())]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["conv", *others])


class _Chunk:
    """One chunk while its rows pass."""

    def __init__(self, conv, first: bool):
        self.conv, self.symbols = conv, []
        self.starts = (0,) if first else tuple(STATES)
        self.low = self.high = None
        self.head = self.tail = ""
        self.counts = dict.fromkeys(_COUNTS, 0)

    def add(self, turn: int | None, initial: str, fault: str, symbol: str):
        c = self.counts
        if turn is not None and turn != self.high:
            c["distinct"] += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if fault:
            c[fault] += 1
        if self.tail and self.tail + initial not in LEGAL:
            c["illegal"] += 1
        self.head = self.head or initial
        self.tail = initial
        self.symbols.append(symbol)

    def row(self, part: int, number: int) -> tuple:
        symbols = "".join(self.symbols)
        solved = (_solved if len(symbols) <= SHORT else solve)(symbols, self.starts)
        return (self.conv, part, number, self.low, self.high, self.head, self.tail, *self.counts.values(), *solved)


def _cut(batches: Iterator[pa.RecordBatch], kind: str, size: int) -> Iterator[pa.RecordBatch]:
    """Sorted facts of a partition as chunks."""
    chunk, done, part, number = None, [], 0, 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "part", "turn", "initial", "blank", "truncated", "first", "copies")]
        for conv, part, turn, initial, blank, truncated, first, copies in zip(*columns, strict=True):
            for copy in range(copies):
                if chunk is None or chunk.conv != conv or len(chunk.symbols) == size:
                    # a conversation that follows another one in its partition begins there
                    begins = chunk is not None and chunk.conv != conv
                    if chunk is not None:
                        done.append(chunk.row(part, number))
                        number += 1
                    chunk = _Chunk(conv, begins)
                again = copy > 0 or not first
                fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else ""
                chunk.add(turn, initial, fault, "x" if blank or again else initial.upper() if truncated else initial)
                if len(done) == CHUNK:
                    yield _batch(done, kind, _CHUNK)
                    done = []
    if chunk is not None:
        yield _batch([*done, chunk.row(part, number)], kind, _CHUNK)


def _joined(chunks: list[dict]) -> tuple:
    """One conversation from its chunks in order."""
    low, high, distinct = None, None, sum(x["distinct"] for x in chunks)
    for x in chunks:
        if x["low"] is not None:
            distinct -= x["low"] == high
            low = x["low"] if low is None else low
            high = x["high"]
    illegal = sum(x["illegal"] for x in chunks) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(chunks, chunks[1:]))
    faults = [sum(x[c] for x in chunks) for c in ("blank", "duplicate", "truncated")]
    cost, audit = chain([(x["costs"], x["places"], x["texts"]) for x in chunks])
    return chunks[0]["conv"], 0 if low is None else high - low + 1 - distinct, *faults, illegal, cost, audit


def _join(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Sorted chunks of whole conversations as one row each."""
    schema = dict.fromkeys(_RESULTS, "long") | {"audit": "string"}
    chunks, done = [], []
    for batch in batches:
        for row in batch.to_pylist():
            if chunks and chunks[0]["conv"] != row["conv"]:
                done.append(_joined(chunks))
                chunks = []
            chunks.append(row)
        yield _batch(done, kind, schema)
        done = []
    if chunks:
        yield _batch([_joined(chunks)], kind, schema)


def _kind(df: DataFrame) -> str:
    return df.schema["conv"].dataType.simpleString()


def audits(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Per conversation: ``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit.  Integers or strings name conversations."""
    named = _named(rows, conv, turn, role, text)
    kind = _kind(named)
    ordered = facts(named).repartitionByRange(*_order("conv")).sortWithinPartitions(*_order("conv"))
    chunks = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(lambda b: _cut(b, kind, chunk), _columns(kind, _CHUNK))
    whole = chunks.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "part", "number")
    schema = dict.fromkeys(_RESULTS, "long") | {"audit": "string"}
    return whole.mapInArrow(lambda b: _join(b, kind), _columns(kind, schema)).withColumnRenamed("conv", conv)


_LINE = {"line": "long", "role": "string", "text": "string"}


def _walk(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """The audit of a conversation and then its rows, as repaired lines."""
    audit, at, state, line = "", 0, 0, 0
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")]
        for conv, edits, role, text in zip(*columns, strict=True):
            if edits is not None:
                audit, at, state, line = edits, 0, 0, 0
            else:
                edit, at = audit[at], at + 1
                if edit != "D":
                    given = role if edit == "K" else ROLES[GIVEN[state]]
                    out.append((conv, line, given, text))
                    state, line = AFTER[given[0]], line + 1
            while audit[at : at + 1] == "I":
                out.append((conv, line, ROLES[GIVEN[state]], ""))
                state, line, at = AFTER[GIVEN[state]], line + 1, at + 1
        yield _batch(out, kind, _LINE)


def repaired(
    rows: DataFrame, audited: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv``, line, ``role``, ``text``.

    A conversation lies whole in one partition, its lines in order.
    """
    named = _named(rows, conv, turn, role, text)
    kind = _kind(named)
    found = audited.select(F.col(conv).alias("conv"), "audit")
    both = named.unionByName(found, allowMissingColumns=True).repartition("conv")
    both = both.sortWithinPartitions(F.asc_nulls_first("conv"), F.col("audit").isNull(), *_order())
    lines = both.select("conv", "audit", "role", "text").mapInArrow(lambda b: _walk(b, kind), _columns(kind, _LINE))
    return lines.select(F.col("conv").alias(conv), "line", F.col("role").alias(role), F.col("text").alias(text))


def _hash(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    schema = {"repaired_sha256": "string"}
    conv, state = None, None
    for batch in batches:
        done = []
        for name, line, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "line", "role", "text")), strict=True):
            if line == 0:
                if state is not None:
                    done.append((conv, state.hexdigest()))
                conv, state = name, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        yield _batch(done, kind, schema)
    if state is not None:
        yield _batch([(conv, state.hexdigest())], kind, schema)


def fingerprints(lines: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """``conv`` and repaired_sha256: the hash of a repaired conversation's ``role:text``, joined by newlines.

    ``lines`` is the result of ``repaired``; a hash reads its input in one run, so one task streams a conversation.
    """
    named = lines.select(F.col(conv).alias("conv"), "line", F.col(role).alias("role"), F.col(text).alias("text"))
    kind = _kind(named)
    return named.mapInArrow(lambda b: _hash(b, kind), _columns(kind, {"repaired_sha256": "string"})).withColumnRenamed("conv", conv)


def report(conversations: DataFrame) -> DataFrame:
    """The damaged conversations, audited and repaired: one row for every conversation of the table."""
    rows = damage(conversations)
    audited = materialise(audits(rows), "audits")
    hashes = fingerprints(repaired(rows, audited)).select(F.col("conv_id").alias("_conv"), "repaired_sha256")
    found = audited.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv").withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in _RESULTS]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
