"""Compare registered Spark queries with their DuckDB oracles.

    python tests/oracle.py [--sf DIR] [--time] [key ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _cell(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, text) -> str:
    """Empty if equal, else what differs."""
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(text)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    types = {c: [type(next((r[i] for r in rows if r[i] is not None), None)).__name__ for rows in (got, want)]
             for i, c in enumerate(got_cols)}
    kinds = {c: t for c, t in types.items() if t[0] != t[1]}
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; types {kinds}"
    if kinds:
        return f"types {kinds}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cols = sorted({c for g, w in bad for c, x, y in zip(got_cols, g, w) if x != y})
        return f"{len(bad)}/{len(got)} rows differ in {cols}; e.g.\n  {got_cols}\n  {bad[0][0]}\n  {bad[0][1]}"
    return ""


def main():
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connect(sf)
    failed = []
    for key in args or queries:
        t = time.time()
        try:
            df = queries[key](spark, sf)
            if key in oracles:
                problem, kind = compare(df, con, oracles[key]), "sql"
            else:
                n = len(df.collect())
                problem, kind = ("" if n else "no rows"), f"rows={n}"
        except Exception as e:  # noqa: BLE001
            problem, kind = f"{type(e).__name__}: {str(e)[:1500]}", "error"
        if problem:
            failed.append(key)
        print(f"{'FAIL' if problem else 'ok  '} {key:28s} {kind:9s} {time.time() - t:6.2f}s {problem}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
