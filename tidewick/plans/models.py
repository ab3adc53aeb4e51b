"""Classifiers per series: training, grid and random search, scoring, stacking.

One forest belongs to one series, as its users want it; the forests of all series are grown by the same jobs
(``growing``) and applied in one plan (``forests``).  Spark ML serves where one model spans all series.
"""

import random
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewick.functions.scalar import arbitrage_label, seconds_to_datetime, trade_label
from tidewick.operators import backtest, clean, evaluate
from tidewick.operators.chunks import edge_rows, row_positions
from tidewick.plans.forests import PACKED, Candidate, score
from tidewick.plans.growing import grow_forests, packed_schema
from tidewick.schema import PAIR, SERIES
from tidewick.session import join_small, materialise
from tidewick.sinks.tables import names_in, touch

# fixed values: the forests of the trade and arbitrage models; Spark ML allows depth 30 at most
DEFAULT_FOREST = {"numTrees": 100, "maxDepth": 17, "featureSubsetStrategy": "70", "seed": 42}
MAX_DEPTH = 30
# fixed values: grids of the arbitrage and trade searches
ARB_GRID = {
    "maxDepth": [14, 15, 17, 18, 21, 25],
    "featureSubsetStrategy": ["50", "55", "60", "65", "70", "75", "80"],
    "numTrees": [100, 150],
}
TRADE_GRID = {"maxDepth": [17, 20, 25, 27], "featureSubsetStrategy": ["40", "45", "50", "55", "60"], "numTrees": [100]}

# fixed values: rows a series must exceed to be trained on, and tested on
TRADE_ROWS, ARB_ROWS = (400, 100), (200, 20)


def trainable(table: DataFrame, keys: Sequence[str], train: int, test: int) -> DataFrame:
    """The rows of series with more than so many training and test rows."""
    part = F.col("part")
    rows = clean.eligible_series(table, {"_a": (part == "train", train), "_b": (part == "test", test)}, keys)
    return join_small(table, rows.select(*keys), keys, "left_semi", salt_by="timestamp")


def forest(features: Sequence[str], **params) -> Pipeline:
    """Random forest on plain columns; labels are 0..n-1 in ``label``."""
    settings = {**DEFAULT_FOREST, **params}
    if settings["maxDepth"] > MAX_DEPTH:
        raise ValueError(f"trees are at most {MAX_DEPTH} deep, not {settings['maxDepth']}")
    assemble = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assemble, RandomForestClassifier(labelCol="label", featuresCol="features", **settings)])


def trade_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model input: complete numbers and the up / not-up label."""
    return clean.zero_fill(_numeric(df, features), features).withColumn("label", F.col("target").cast("double"))


def arb_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model input with the states -1, 0, 1 as labels 0, 1, 2."""
    return clean.zero_fill(_numeric(df, features), features).withColumn("label", (F.col("target") + 1).cast("double"))


def _numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def artifact(base: str, kind: str, series: Sequence, params: Mapping | None = None) -> str:
    parts = [str(x) for x in (*series, *(params or {}).values())]
    return f"{base}/model_{kind}_" + "_".join(parts)


FINISHED = "FINISHED"


def features_per_node(strategy: str | int, n_features: int) -> int:
    """How many features a node may split on, by the name of a strategy or as a number."""
    named = {"all": n_features, "auto": max(1, round(n_features**0.5)), "sqrt": max(1, round(n_features**0.5)), "onethird": max(1, n_features // 3)}
    return named[strategy] if strategy in named else min(int(strategy), n_features)


def _settings(params: Mapping) -> dict:
    settings = {**DEFAULT_FOREST, **params}
    if settings["maxDepth"] > MAX_DEPTH:
        raise ValueError(f"trees are at most {MAX_DEPTH} deep, not {settings['maxDepth']}")
    return settings


def _finished(spark: SparkSession, path: str, schema) -> DataFrame:
    """All fits under ``path`` that were written whole."""
    whole = [f"{path}/{n}" for n in names_in(spark, path) if FINISHED in names_in(spark, f"{path}/{n}")]
    return spark.read.schema(schema).parquet(*[f"{p}/forests" for p in whole]) if whole else spark.createDataFrame([], schema)


def fit_forests(
    table: DataFrame, keys: Sequence[str], features: Sequence[str], classes: int, path: str, candidates: Iterable[Mapping] = ({},)
) -> DataFrame:
    """Packed forests that serve all candidates on every series, stored under ``path``.

    Candidates that share a number of features a node share a forest of the greatest depth and number of trees.  A forest that was
    stored whole for the same training rows, features and settings is kept; only series without one are fitted.
    """
    spark, keys = table.sparkSession, list(keys)
    asked = [_settings(p) for p in candidates]
    subsets = sorted({features_per_node(p["featureSubsetStrategy"], len(features)) for p in asked})
    trees, depth = max(p["numTrees"] for p in asked), max(p["maxDepth"] for p in asked)
    seed = asked[0]["seed"]
    train = table.where(F.col("part") == "train")
    what = F.lit(repr((list(features), classes, subsets, trees, depth, seed)))
    rows = F.bit_xor(F.xxhash64(*keys, "timestamp", "label", *features))
    marks = materialise(train.groupBy(*keys).agg(F.hex(F.xxhash64(rows, F.count(F.lit(1)), what)).alias("mark")), "marks")
    schema = packed_schema(train, keys, {"mark": "string"})
    stored = _finished(spark, path, schema)
    todo = marks.join(stored.select(*keys, "mark").distinct(), [*keys, "mark"], "left_anti")
    if todo.take(1):
        missing = join_small(train, todo, keys, salt_by="timestamp")
        grown = grow_forests(missing.drop("mark"), keys, features, classes, subsets, trees, depth, seed)
        new = f"{path}/fit-{uuid.uuid4().hex}"
        join_small(grown, todo, keys, salt_by="tree").select(*keys, *PACKED, "mark").write.parquet(f"{new}/forests")
        touch(spark, f"{new}/{FINISHED}")
        stored = _finished(spark, path, schema)
    return stored.join(marks, [*keys, "mark"], "left_semi").drop("mark")


def fit_report(predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and accuracy of both parts per series."""
    hit = (F.col("prediction") == F.col("label")).cast("double")
    parts = {p: F.col("part") == p for p in ("train", "test")}
    return predicted.groupBy(*keys).agg(
        *[F.count_if(cond).alias(f"n_{p}") for p, cond in parts.items()],
        *[F.avg(F.when(cond, hit)).alias(f"{p}_accuracy") for p, cond in parts.items()],
    )


def param_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    return reduce(lambda rows, kv: [{**r, kv[0]: v} for r in rows for v in kv[1]], grid.items(), [{}])


def random_params(draws: int, choices: Mapping[str, Sequence], seed: int = 42) -> list[dict]:
    """Seeded random draws from the choices."""
    rng = random.Random(seed)
    return [{k: rng.choice(list(v)) for k, v in choices.items()} for _ in range(draws)]


SEARCHED = {"max_features": "featureSubsetStrategy", "max_depth": "maxDepth", "n_estimators": "numTrees"}


def searched(
    table: DataFrame, features: Sequence[str], keys: Sequence[str], classes: int, candidates: Iterable[dict], path: str, keep: Sequence[str]
) -> DataFrame:
    """Test rows scored by every candidate's forest of their series: keys, ``keep``, the parameters, prediction.

    One forest per number of features is grown; candidates are its cuts.  A candidate that comes again is one.
    """
    asked = [_settings(p) for p in {tuple(sorted(p.items())): p for p in candidates}.values()]
    forests = fit_forests(table, keys, features, classes, path, asked)
    wanted = [
        Candidate(n, features_per_node(p["featureSubsetStrategy"], len(features)), p["maxDepth"], p["numTrees"]) for n, p in enumerate(asked)
    ]
    scored = score(table.where(F.col("part") == "test"), forests, features, keys, keep, wanted)
    chosen = [(n, str(p["featureSubsetStrategy"]), p["maxDepth"], p["numTrees"]) for n, p in enumerate(asked)]
    names = table.sparkSession.createDataFrame(chosen, "candidate int, max_features string, max_depth int, n_estimators int")
    return scored.join(names, "candidate").drop("candidate")


def search_trade(table: DataFrame, features: Sequence[str], candidates: Iterable[dict], path: str) -> DataFrame:
    """Backtest of every candidate on every series (of any period): one row per (ex_tp, period, candidate)."""
    tested = searched(table, features, SERIES, 2, candidates, path, ["timestamp", "close_diff"])
    runs = [*SERIES, *SEARCHED]
    d = tested.select(*runs, "timestamp", "close_diff", (F.col("prediction") == 1).alias("y_pred"))
    # a candidate's run over a series is a series of its own to the backtest
    own = F.concat_ws("|", "exchange", *SEARCHED)
    summary = backtest.backtest_summary(d.withColumn("exchange", own).drop(*SEARCHED))
    parts = F.split("exchange", r"\|")
    return summary.select(
        F.concat_ws("_", parts[0], "trading_pair").alias("ex_tp"),
        "period",
        parts[1].alias("max_features"),
        parts[2].cast("int").alias("max_depth"),
        parts[3].cast("int").alias("n_estimators"),
        "pct_gain",
        "gain",
        "fees",
        "net_profit",
        "pct_net_profit",
    )


def search_arb(
    table: DataFrame, features: Sequence[str], candidates: Iterable[dict], path: str
) -> tuple[DataFrame, DataFrame]:
    """Confusion counts and profits of every candidate on every exchange pair.

    ``table`` has pct_profit beside the features; both results have ex_tp, period and the parameters.
    """
    tested = searched(table, features, PAIR, 3, candidates, path, ["timestamp", "label", "pct_profit"])
    tested = materialise(
        tested.select(
            F.concat_ws("_", "exchange_1", "exchange_2", "trading_pair").alias("ex_tp"), "period", *SEARCHED,
            (F.col("label") - 1).cast("int").alias("actual"), (F.col("prediction") - 1).cast("int").alias("predicted"),
            "pct_profit",
        ),
        "searched",
    )
    model = ["ex_tp", "period", *SEARCHED]
    confusion = tested.groupBy(*model, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return confusion, evaluate.arb_profit_summary(tested, model, "predicted")


def score_newest(
    rows: DataFrame, forests: DataFrame, keys: Sequence[str], features: Sequence[str], subset: int, now: Column | None = None
) -> DataFrame:
    """Stored forests on the newest row of their series, as prediction records.

    p_time is when the predicted period begins, c_time (``now``, by default the clock) when the record was made; trade
    records carry exchange, arbitrage records (``keys`` of exchange pairs) exchange_1 and exchange_2.
    """
    newest = edge_rows(rows, 1, keys=keys).drop("rank")
    scored = score(newest, forests, features, keys, ["timestamp"], [Candidate(subset=subset)])
    due = F.col("timestamp") + F.col("period")
    made = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    pair = "exchange_1" in keys
    label = arbitrage_label((F.col("prediction") - 1).cast("int")) if pair else trade_label(F.col("prediction") == 1)
    return scored.select(
        seconds_to_datetime(due).alias("p_time"), made.alias("c_time"), *[k for k in keys if k != "period"],
        label.alias("prediction"),
    )


def stack(
    rows: DataFrame, features: Sequence[str], depths: Sequence[int], keys: Sequence[str], folds: int = 4, params: Mapping | None = None
) -> DataFrame:
    """Forests' class probabilities as the features of a second classifier, cross-fitted along time.

    The training part of every series is cut into ``folds`` stretches.  A stretch is scored by forests grown on the stretches
    before it, the test part by forests grown on the whole training part; the first stretch is not scored, as nothing comes
    before it.  A fold is a further key, so all forests are grown at once, and members are cuts of one forest at their ``depths``.
    """
    keys, settings = list(keys), _settings({**(params or {}), "maxDepth": max(depths)})
    placed = row_positions(rows.where(F.col("part") == "train"), keys)
    train = materialise(placed.withColumn("_slice", F.expr(f"int(pos * {folds} div n_rows)")).drop("pos", "n_rows"), "stacked")
    later = train.withColumn("_fold", F.explode(F.sequence(F.col("_slice") + 1, F.lit(folds)))).drop("_slice")
    subset = features_per_node(settings["featureSubsetStrategy"], len(features))
    by = [*keys, "_fold"]
    forests = materialise(grow_forests(later, by, features, 2, [subset], settings["numTrees"], max(depths), settings["seed"]), "members")
    asked = train.where("_slice > 0").withColumnRenamed("_slice", "_fold").unionByName(
        rows.where(F.col("part") == "test").withColumn("_fold", F.lit(folds))
    )
    kept = ["timestamp", "part", "label"]
    members = [Candidate(i, subset, depth) for i, depth in enumerate(depths)]
    scored = score(asked, forests, features, by, kept, members)
    inputs = [f"_member_{i}" for i in range(len(depths))]
    chance = F.get("probability", 1)
    wide = scored.groupBy(*keys, *kept).agg(*[F.max(F.when(F.col("candidate") == i, chance)).alias(c) for i, c in enumerate(inputs)])
    wide = materialise(wide, "member-scores")
    top = Pipeline(
        stages=[VectorAssembler(inputCols=inputs, outputCol="features"), LogisticRegression(labelCol="label")]
    )
    model = top.fit(wide.where(F.col("part") == "train"))
    return model.transform(wide).select(*keys, "timestamp", "part", "label", *inputs, "prediction")
