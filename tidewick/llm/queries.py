"""The registered queries of this subpackage, and their SQL where there is one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewick.llm import (
    conversation_repair, exact_dedup, jaccard_join, license_scan, neighbours, packing, personal_data, quality, ranked_search, secret_scan,
    segmentations, token_files, url_filter,
)
from tidewick.llm.token_units import vocabulary
from tidewick.session import scratch_path

# fixed values: the rules of the URL query
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf, "documents"))
    base = [r.kind for r in secret_scan.BASE]
    mine = F.filter("findings", lambda f: f["kind"].isin(base))

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(secret_scan.spans_text(mine).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("findings")).alias("spans"),
    )


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digests(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf, "documents"), path, vocabulary("word_bpe_49k.json"), 2)
    found = token_files.read(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf, "documents"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf, "documents"))


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES)


def op2_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"))


def op7_segmentations(spark: SparkSession, sf: str) -> DataFrame:
    return segmentations.encode(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"), digests=True)


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.resample(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents"))


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf, "conversations"))


def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data.digests(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_neighbours, op3_packing, op4_token_files, op5_jaccard_join, op6_exact_dedup, op7_segmentations, op8_url_filter,
        op9_quality, op10_license_scan, op11_conversation_repair,
        op12_ranked_search, op13_personal_data,
    )
}

_SECRETS = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
               r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
}


def _secrets_sql() -> str:
    parts = []
    for k, (kind, (pattern, group, least)) in enumerate(_SECRETS.items()):
        text = pattern.replace("'", "''")
        parts.append(
            f"select doc_id, {k} as rank, '{kind}' as kind, {least} as least, regexp_extract_all(t, '{text}', 0) as m, "
            f"regexp_extract_all(t, '{text}', {group}) as g, regexp_split_to_array(t, '{text}') as gaps from docs"
        )
    return f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
matches as ({" union all ".join(parts)}),
places as (select *, unnest(range(1, len(m) + 1)) as i from matches where len(m) > 0),
found as (
  select *, start + length(m[i]) as stop
  from (select *, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as start from places)
  where length(g[i]) >= least),
spans as (select doc_id, start, rank, kind, kind || ':' || start || ':' || stop as span from found)
select doc_id,
       count(span) filter (kind = 'assign') as n_assign,
       count(span) filter (kind = 'access') as n_access,
       count(span) filter (kind = 'hex') as n_hex,
       sha256(coalesce(string_agg(span, ',' order by start, rank) filter (rank < 3), '')) as base_sha256,
       coalesce(string_agg(span, ',' order by start, rank), '') as spans
from docs left join spans using (doc_id) group by doc_id
"""


def _repair_sql() -> str:
    """The same audits by a recursion over rows that carries, for each state, the least (cost, audit, lines)."""
    impossible = 10**9
    given, after = ("user", "user", "assistant", "user"), (2, 2, 3, 2)

    def add(state: str, cost: str, letter: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"

    def least(options: list[str]) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def inserted(s: int) -> str:
        return f"chr(10) || '{given[s]}:'"

    # inserts before a row, into the states after user and then after assistant
    user = least(["s2", *[add(f"s{s}", "5", "I", inserted(s)) for s in (0, 1, 3)]])
    assistant = least(["s3", add("u2", "5", "I", inserted(2))])
    before = {0: "s0", 1: "s1", 2: "u2", 3: "u3"}
    after_row = []
    for end in range(4):
        options = [add(before[end], "2", "D")]
        for s in range(4):
            kept = [i for i, e in (("s", 1), ("u", 2), ("a", 3)) if e == end and (s == 0 and i in "su" or s in (1, 3) and i == "u" or s == 2 and i == "a")]
            options += [add(before[s], f"case when ok and left(role, 1) = '{i}' then cut else {impossible} end", "K", "chr(10) || role || ':' || text") for i in kept]
            if after[s] == end:
                options.append(add(before[s], f"case when ok then 1 + cut else {impossible} end", "R", f"chr(10) || '{given[s]}:' || text"))
        after_row.append(f"{least(options)} as s{end}")
    start = "{'c': 0::bigint, 'a': '', 't': ''}"
    none = f"{{'c': {impossible}::bigint, 'a': '', 't': ''}}"
    last = least(["s0", "s3", add("s2", "5", "I", inserted(2)), add("s1", "10", "II", f"{inserted(1)} || {inserted(2)}")])
    text = "regexp_replace(t, '[.!?]', '', 'g')"
    return f"""
with recursive
table_of as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
                        order by i) as tbl from range(256) as r(i)),
named as (
  select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name, coalesce(role, ' ') as r, coalesce(text, ' ') as t
  from conversations),
kinds as (
  select *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
                lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind from named, table_of),
damaged as (
  select conv_id, turn, case kind when 4 then 'user' else r end as role, case kind when 1 then '' when 2 then {text} else t end as text,
         unnest(case kind when 3 then [1, 2] else [1] end) as copy
  from kinds where kind <> 0),
placed as (
  select conv_id, turn, role, text, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as inner_text,
         row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen
  from damaged),
faults as (
  select *, case when inner_text = '' then 'blank' when seen > 1 then 'duplicate'
                 when right(inner_text, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
         left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as pair
  from placed),
rows_in as (select *, fault in ('', 'truncated') as ok, case fault when 'truncated' then 5 else 0 end as cut from faults),
steps as (
  select conv_id, 0::bigint as i, {start} as s0, {none} as s1, {none} as s2, {none} as s3 from (select distinct conv_id from conversations)
  union all
  select conv_id, i, {", ".join(after_row)} from (
    select conv_id, i, ok, cut, role, text, s0, s1, s2, u2, {assistant} as u3 from (
      select r.conv_id, r.i, r.ok, r.cut, r.role, r.text, s0, s1, s2, s3, {user} as u2
      from steps join rows_in r on r.conv_id is not distinct from steps.conv_id and r.i = steps.i + 1))),
ends as (select conv_id, {last} as best from steps qualify i = max(i) over (partition by conv_id)),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from rows_in group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.c as cost, best.a as audit, sha256(best.t[2:]) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id
"""


_CUES = "account|Account|ACCOUNT|acct|Acct|ACCT|iban|Iban|IBAN|passport|Passport|PASSPORT|ssn|Ssn|SSN"
_IDENTIFIER = r"(\x20no|\x20number)?[\x20.:#=]+([A-Z0-9-]+)"
_LUHN = """length(d) between 16 and 19 and list_sum(list_transform(range(1, length(d) + 1), lambda i:
  case when i % 2 = 1 then substr(d, length(d) + 1 - i, 1)::int
       else substr(d, length(d) + 1 - i, 1)::int * 2 - case when substr(d, length(d) + 1 - i, 1) > '4' then 9 else 0 end end)) % 10 = 0"""
# kind, pattern, what a match (m, its digits d) must meet
_PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 and right('000' || p, 3)::int <= 255))"),
    ("card", r"[0-9]([\x20-]?[0-9])+", _LUHN),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) between 8 and 15"),
    ("login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/?#@]+@[A-Za-z0-9.-]+", "true"),
    ("tel", r"tel:\+?[0-9().-]+", "length(d) between 7 and 15"),
    ("account", f"({_CUES}){_IDENTIFIER}", f"length(regexp_replace(regexp_extract(m, '({_CUES}){_IDENTIFIER}', 3), '[^0-9]', '', 'g')) >= 6"),
    ("pan", "[0-9]+", _LUHN),
]


def _personal_sql() -> str:
    matches = " union all ".join(
        f"select doc_id, {k} as rank, regexp_extract_all(t, '{p}', 0) as ms, regexp_split_to_array(t, '{p}') as gaps from docs"
        for k, (_, p, _) in enumerate(_PERSONAL)
    )
    valid = " ".join(f"when {k} then {v}" for k, (_, _, v) in enumerate(_PERSONAL))
    names = " ".join(f"when {k} then '{n}'" for k, (n, _, _) in enumerate(_PERSONAL))
    return f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
matches as ({matches}),
places as (select *, unnest(range(1, len(ms) + 1)) as i from matches where len(ms) > 0),
found as (
  select doc_id, rank, ms[i] as m, regexp_replace(ms[i], '[^0-9]', '', 'g') as d,
         (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::bigint as start
  from places),
spans as (
  select doc_id, rank, start, case rank {names} end || ':' || start || ':' || (start + length(m)) as span
  from found where case rank {valid} end)
select doc_id,
       count(span) filter (rank = 0) as n_email, count(span) filter (rank = 1) as n_ip,
       count(span) filter (rank = 2) as n_card, count(span) filter (rank = 3) as n_phone,
       sha256(coalesce(string_agg(span, ',' order by rank, start) filter (rank < 4), '')) as base_sha256,
       coalesce(string_agg(span, ',' order by rank, start), '') as spans
from docs left join spans using (doc_id) group by doc_id
"""


ORACLES = {
    "op11_conversation_repair": _repair_sql(),
    "op12_ranked_search": r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
lengths as (select doc_id, count(*) as n from words group by doc_id),
total as (select count(*) as docs, sum(n)::bigint as terms from lengths),
counts as (select doc_id, term, count(*) as tf from words group by doc_id, term),
weights as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from counts, total group by term, docs),
asked as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
scores as (
  select item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms)))))::bigint as score
  from asked join weights using (term) join counts using (term) join lengths using (doc_id), total group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scores where score > 0 qualify rank <= 20
""",
    "op13_personal_data": _personal_sql(),
    "op1_secret_scan": _secrets_sql(),
    "op6_exact_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
      from documents)
window same as (partition by norm)
""",
}
