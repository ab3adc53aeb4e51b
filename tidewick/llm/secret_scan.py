"""Secret scans over every version of every text, through a ledger of blobs (DataFrame functions only).

A blob is a text's content address (SHA-256 of its bytes; null counts as empty).  The ledger is a Parquet table with one
row per blob and batch: the rules (``name@version``) that the batch ran on it, and what they found.  A scan
addresses all versions, takes the blobs for which some rule version is unseen, runs just those rules on one copy of
each, appends to the ledger, and joins the ledger's findings back to all paths.  Copies are dropped within each task
before anything is shuffled, so a text that holds a third of all rows costs one row per task; into a new ledger,
texts that no rule matches go as digests only.

Positions count code points, ends are exclusive; matches of a rule are leftmost and do not overlap.  Texts without a
match, empty texts and null texts have an empty list of findings.  Rows that repeat give repeated results; an empty
table gives an empty result (and adds nothing to the ledger).  Only the key and text columns are read.
"""

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewick.session import scratch_path

FINDING = "struct<start:int,rank:int,kind:string,end:int>"


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int  # whose length must reach ``least``; shorter matches are dropped after matching
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# fixed values: the base kinds
BASE = [
    Rule("assign", 1, r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
]
MORE = [
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
]
RULES = BASE + MORE
# a cheap condition that every match of the rule's length meets, where the pattern alone matches almost anywhere
SCREEN = {"hex": r"[0-9a-f]{32}"}


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """All matches of a rule as structs: the code points before (since the last match), in it, and in its group."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("g"),
        F.split(text, rule.pattern, -1).alias("gap"),
    )
    found = F.transform(
        F.filter(parts, lambda p: p["m"].isNotNull()),
        lambda p, i: F.struct(
            F.lit(rank).alias("rank"),
            i.alias("i"),
            F.char_length(p["gap"]).alias("gap"),
            F.char_length(p["m"]).alias("size"),
            F.char_length(p["g"]).alias("inner"),
        ),
    )
    none = F.array().cast("array<struct<rank:int,i:int,gap:int,size:int,inner:int>>")
    return F.when(text.rlike(SCREEN.get(rule.kind, rule.pattern)), found).otherwise(none)


def _screened(text: Column, rules: Sequence[Rule]) -> Column:
    """Whether any rule may match; where none does there is nothing to find."""
    return reduce(lambda a, b: a | b, [text.rlike(SCREEN.get(r.kind, r.pattern)) for r in rules])


def _find(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, todo): blob, rules, findings.

    One row per match stays in its blob's partition; starts are running sums of the lengths before.
    """
    hits = F.concat(
        *[
            F.when(F.array_contains("todo", r.name), _matches(F.col("text"), r, k)).otherwise(
                F.array().cast("array<struct<rank:int,i:int,gap:int,size:int,inner:int>>")
            )
            for k, r in enumerate(rules)
        ]
    )
    rows = blobs.select("blob", "todo", hits.alias("hits")).select("blob", "todo", F.explode_outer("hits").alias("h"))
    w = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("blob", "todo", "h.rank", "h.i", "h.gap", "h.size", "h.inner")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(w).cast("int"))
    rank = F.col("rank")
    least, kind = F.lit(None).cast("int"), F.lit(None).cast("string")
    for k, r in enumerate(rules):
        least, kind = F.when(rank == k, r.least).otherwise(least), F.when(rank == k, r.kind).otherwise(kind)
    finding = F.struct((F.col("end") - F.col("size")).alias("start"), rank, kind.alias("kind"), "end")
    return rows.groupBy("blob").agg(
        F.first("todo").alias("rules"),
        F.sort_array(F.collect_list(F.when(F.col("inner") >= least, finding))).cast(f"array<{FINDING}>").alias("findings"),
    )


def update_ledger(versions: DataFrame, ledger: str, text: str = "text", rules: Sequence[Rule] = RULES) -> None:
    """Scan the blobs of ``versions`` that some rule version has not seen, and append them to ``ledger``."""
    spark = versions.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    rows = versions.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    try:
        seen = spark.read.parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # nothing is seen yet: texts that no rule matches go on as digests only
        rows = rows.withColumns({"text": F.coalesce(F.when(_screened(F.col("text"), rules), F.col("text")), F.lit("")), "todo": names})
    else:
        done = seen.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
        unseen = (
            rows.select("blob").distinct().join(done, "blob", "left")
            .select("blob", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
            .where(F.size("todo") > 0)
        )
        rows = rows.join(unseen, "blob")
    _find(rows.dropDuplicates(["blob"]), rules).write.mode("append").parquet(ledger)


def findings_of(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(blob, findings)`` of all blobs in which the given rule versions found something, sorted by start and rule."""
    current = F.array(*[F.lit(r.name) for r in rules])
    names = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.name))])
    kept = F.filter(
        "findings", lambda f: F.array_contains("rules", names[f["kind"]]) & F.array_contains(current, names[f["kind"]])
    )
    rows = ledger.select("blob", kept.alias("findings")).where(F.size("findings") > 0)
    merged = rows.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("f"))
    place = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))])
    again = F.transform(
        "f", lambda f: F.struct(f["start"].alias("start"), place[f["kind"]].alias("rank"), f["kind"].alias("kind"), f["end"].alias("end"))
    )
    return merged.select("blob", F.sort_array(F.array_distinct(again)).cast(f"array<{FINDING}>").alias("findings"))


def scan(
    versions: DataFrame, ledger: str | None = None, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per version: key, blob (hex), findings ``array<struct<start, rank, kind, end>>``.

    ``ledger`` is the ledger's path (kept and reused between scans); by default a new one in the shared folder.
    """
    ledger = ledger or scratch_path(versions.sparkSession, "ledger")
    update_ledger(versions, ledger, text, rules)
    found = findings_of(versions.sparkSession.read.parquet(ledger), rules)
    paths = versions.select(F.col(key).alias("_key"), blob_of(F.col(text)).alias("blob"))
    return paths.join(found, "blob", "left").select(
        F.col("_key").alias(key),
        F.lower(F.hex("blob")).alias("blob"),
        F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings"),
    )


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def redact(docs: DataFrame, ledger: str | None = None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark`` (overlapping findings by one).

    Texts that no rule matches pass through where they are read; only the others meet the findings.
    """
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    update_ledger(docs, ledger, text)
    blob, spans = (next(f"{x}{i}" for i in range(len(docs.columns) + 1) if f"{x}{i}" not in docs.columns) for x in ("_b", "_f"))
    found = findings_of(docs.sparkSession.read.parquet(ledger)).select(F.col("blob").alias(blob), F.col("findings").alias(spans))
    body = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, f):
        before = F.substring(body, acc["at"] + 1, F.greatest(f["start"] - acc["at"], F.lit(0)))
        end = F.greatest(f["end"], acc["at"])
        joined = F.concat(acc["out"], before, F.when(f["start"] >= acc["at"], F.lit(mark)).otherwise(""))
        return F.struct(end.alias("at"), joined.alias("out"))

    clean = F.aggregate(
        F.col(spans), start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.char_length(body)))
    )
    may = F.coalesce(_screened(body, RULES), F.lit(False))
    joined = docs.where(may).withColumn(blob, blob_of(body)).join(found, blob, "left")
    rewritten = joined.withColumn(text, F.when(F.col(spans).isNotNull(), clean).otherwise(body)).select(*docs.columns)
    return docs.where(~may).union(rewritten)
