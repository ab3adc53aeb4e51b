"""Features bucketed by slot: pairing exchanges moves no feature row."""

import pytest
from pyspark.sql import functions as F

from tidewick.plans import features
from tidewick.session import bucketed

START, PERIOD = 1_700_000_100, 300
COLUMNS = ["close", "volume", "momentum_rsi"]


@pytest.fixture
def table(spark):
    """Three exchanges on one pair, two on another; the third exchange begins late and has nulls."""
    rows = [
        (e, p, PERIOD, START + PERIOD * i, 100.0 + (i * k) % 7, float(i), None if e == "c" and i % 5 == 0 else 50.0 + k + i)
        for k, (e, p) in enumerate([("a", "p"), ("b", "p"), ("c", "p"), ("a", "q"), ("c", "q")], 1)
        for i in range(20 if e == "c" else 0, 60)
    ]
    schema = "exchange string, trading_pair string, period int, timestamp long, close double, volume double, momentum_rsi double"
    return spark.createDataFrame(rows, schema)


def test_every_pair_has_both_sides_features(spark, table):
    """Against two plain joins, for a stored table and for any other."""
    side = lambda n: table.select(
        F.col("exchange").alias(f"exchange_{n}"), *features.SLOT, *[F.col(c).alias(f"{c}_exchange_{n}") for c in COLUMNS])
    want = side(1).join(side(2), features.SLOT).where("exchange_1 < exchange_2")
    names = sorted(want.columns)
    rows = lambda d: sorted(map(tuple, d.select(*names).collect()), key=repr)
    expected = rows(want)
    assert len(expected) == 60 + 3 * 40
    for source in (table, features.feature_store(table)):
        assert rows(features.arb_features(source, COLUMNS)) == expected


def test_pairing_reads_the_store_without_a_shuffle(spark, table):
    """Nothing between a scan of the store and the joins of exchanges and features."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = features.arb_features(features.feature_store(table), COLUMNS)._jdf.queryExecution().executedPlan()
        scans = []

        def walk(node, above):
            name = node.nodeName()
            if name.startswith("Scan parquet"):
                scans.append((name, above))
            for i in range(node.children().size()):
                walk(node.children().apply(i), [*above, name])

        walk(plan, [])
        wide = [above for _, above in scans if "ObjectHashAggregate" in above]
        assert len(scans) >= 3 and len(wide) == 1
        for _, above in scans:  # the nearest join is reached without an exchange
            joins = [i for i, n in enumerate(above) if n == "SortMergeJoin"]
            assert joins and not any("Exchange" in n for n in above[joins[-1] :]), above
        assert not any("Exchange" in n for n in wide[0])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bucketed_table_is_whole(spark, table):
    stored = bucketed(table, features.SLOT)
    assert stored.columns == table.columns and stored.exceptAll(table).isEmpty() and stored.count() == table.count()
    empty = bucketed(table.limit(0), features.SLOT)
    assert empty.isEmpty() and features.arb_features(empty, COLUMNS).isEmpty()
