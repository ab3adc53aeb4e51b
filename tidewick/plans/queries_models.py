"""Registered queries: evaluation, model choice, classifiers."""

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewick.operators import arbitrage, evaluate, splits
from tidewick.plans import base, features, models, regimes
from tidewick.plans.base import HOUR, MODEL, K, candles, labelled, results, sql, tidy
from tidewick.plans.forests import Candidate, score
from tidewick.schema import ARB_PREDICTION_KEY, PAIR, SERIES, TRADE_PREDICTION_KEY
from tidewick.session import join_small, materialise, scratch_path
from tidewick.sinks.tables import write_predictions
from tidewick.sources.candles import read_confusions, read_performance

QUERIES, ORACLES = {}, {}


def add(key, query, oracle=None):
    QUERIES[key] = query
    if oracle is not None:
        ORACLES[key] = oracle


# --- evaluation ------------------------------------------------------------------------------

_CELLS = """cells as (
  select model_name, actual, predicted, count(*) as n from {source} group by all),
known as (select distinct model_name, label from (select model_name, actual as label from cells union all
                                                   select model_name, predicted from cells)),
matrix as (
  select a.model_name, a.label as actual, p.label as predicted, coalesce(n, 0) as n
  from known a join known p using (model_name)
  left join cells c on c.model_name = a.model_name and c.actual = a.label and c.predicted = p.label)"""
_DOCS, _RESULTS = _CELLS.format(source="labelled"), _CELLS.format(source="results")

add(
    "confusion_matrix",
    lambda s, d: tidy(evaluate.confusion_matrix(results(s, d), ["model_name"])),
    sql(
        """select model_name, actual, predicted, n,
        n / nullif(sum(n) over (partition by model_name, actual), 0) as share from matrix""",
        "share",
        ctes=_RESULTS,
    ),
)
add(
    "accuracy",
    lambda s, d: tidy(evaluate.accuracy(results(s, d), ["model_name"])),
    sql("select model_name, avg(cast(actual = predicted as double)) as accuracy from results group by all", "accuracy"),
)
add(
    "classification_report",
    lambda s, d: tidy(
        evaluate.classification_report(evaluate.confusion_matrix(labelled(s, d), ["model_name"]), ["model_name"])
    ),
    sql(
        """select model_name, label, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1,
        support from (
          select model_name, label, coalesce(hit / nullif(pred, 0), 0) as precision, coalesce(hit / nullif(support, 0), 0) as recall,
                 cast(support as bigint) as support
          from (select k.model_name, k.label, sum(case when actual = label and predicted = label then n else 0 end) as hit,
                       sum(case when predicted = label then n else 0 end) as pred,
                       sum(case when actual = label then n else 0 end) as support
                from known k join matrix using (model_name) group by all))""",
        "precision recall f1",
        ctes=_DOCS,
    ),
)


def _scorecard(s, d):
    r = materialise(results(s, d), "results")
    confusion = r.groupBy(*MODEL, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    scored = evaluate.model_scorecard(confusion)
    return confusion.select(*MODEL).distinct().join(scored, "model_name"), r


_SCORES = """cards as (
  select model_name,
    coalesce(sum(n) filter (where actual = -1 and predicted = -1), 0) as hm, coalesce(sum(n) filter (where predicted = -1), 0) as pm,
    coalesce(sum(n) filter (where actual = 0 and predicted = 0), 0) as hz, coalesce(sum(n) filter (where predicted = 0), 0) as pz,
    coalesce(sum(n) filter (where actual = 1 and predicted = 1), 0) as hp, coalesce(sum(n) filter (where predicted = 1), 0) as pp,
    bool_or(actual <> 0 or predicted <> 0) as known_arb from cells group by all),
scorecard as (
  select ex_tp, max_features, max_depth, n_estimators, model_name,
    cast(case when known_arb then hm + hp else 0 end as bigint) as correct_arb,
    case when known_arb then 1 - hz / nullif(pz, 0) else 0 end as pct_wrong_0,
    case when known_arb then 1 - hp / nullif(pp, 0) else 0 end as pct_wrong_1,
    case when known_arb then 1 - hm / nullif(pm, 0) else 0 end as pct_wrong_neg1,
    cast(case when known_arb then hm else 0 end as bigint) as correct_arb_neg1,
    cast(case when known_arb then hp else 0 end as bigint) as correct_arb_1,
    cast(case when known_arb then hz else 0 end as bigint) as correct_arb_0
  from cards join (select distinct ex_tp, max_features, max_depth, n_estimators, model_name from results) using (model_name)),
summary as (
  select ex_tp, max_features, max_depth, n_estimators, model_name, avg(pct_profit) as pct_profit_mean,
         median(pct_profit) as pct_profit_median from results where predicted <> 0 group by all),
performance as (
  select *, (pct_profit_mean + 0.3) * 1 as shifted from scorecard join summary
    using (ex_tp, max_features, max_depth, n_estimators, model_name))"""
_ALL = f"{_RESULTS}, {_SCORES}"
_WRONG = "pct_wrong_0 pct_wrong_1 pct_wrong_neg1"
_CARD = ["correct_arb", "pct_wrong_0", "pct_wrong_1", "pct_wrong_neg1", "correct_arb_neg1", "correct_arb_1", "correct_arb_0"]
add(
    "model_scorecard",
    lambda s, d: tidy(_scorecard(s, d)[0].select(*MODEL, *_CARD)),
    sql(f"select {', '.join(MODEL)}, {', '.join(_CARD)} from scorecard", _WRONG, ctes=_ALL),
)


def _profit_summary(s, d):
    return evaluate.arb_profit_summary(results(s, d), MODEL, "predicted")


_PROFITS = "pct_profit_mean pct_profit_median"
add(
    "arb_profit_summary",
    lambda s, d: tidy(_profit_summary(s, d)),
    sql("select * from summary", _PROFITS, ctes=_ALL),
)


def _performance(s, d):
    """Scorecard and profits of all models."""
    card, r = _scorecard(s, d)
    return card.join(evaluate.arb_profit_summary(r, MODEL, "predicted"), MODEL)


add(
    "leaderboard",
    lambda s, d: tidy(evaluate.leaderboard(_profit_summary(s, d), "pct_profit_mean", ["model_name"])),
    sql("select * from summary order by pct_profit_mean desc, model_name", _PROFITS, ctes=_ALL),
)
add(
    "best_model_per_series",
    lambda s, d: tidy(evaluate.best_per_group(_performance(s, d), "ex_tp", "correct_arb", ["model_name"])),
    sql(
        f"""select {', '.join(MODEL)}, {', '.join(_CARD)}, pct_profit_mean, pct_profit_median from performance
        qualify row_number() over (partition by ex_tp order by correct_arb desc, model_name) = 1""",
        f"{_WRONG} {_PROFITS}",
        ctes=_ALL,
    ),
)


def _selectable(s, d):
    """Profits before fees, so that some models pass the profit threshold."""
    p = _performance(s, d)
    return p.withColumn("pct_profit_mean", F.col("pct_profit_mean") + 0.55)


add(
    "select_models",
    # the naive predictors compared here are rarely right, so the thresholds are lower than the defaults
    lambda s, d: tidy(evaluate.select_models(_selectable(s, d), ["model_name"], 0.5, 0, 0.1)),
    sql(
        f"""select {', '.join(MODEL)}, {', '.join(_CARD)}, pct_profit_mean + 0.55 as pct_profit_mean, pct_profit_median
        from performance where pct_wrong_0 < 0.5 and correct_arb > 0 and pct_profit_mean + 0.55 > 0.1
        qualify row_number() over (partition by ex_tp order by correct_arb desc, model_name) = 1""",
        f"{_WRONG} {_PROFITS}",
        ctes=_ALL,
    ),
)
add(
    "confusion_json",
    lambda s, d: evaluate.confusion_json(evaluate.confusion_matrix(results(s, d), ["model_name"])),
    sql(
        """select model_name, '[' || string_agg('{"actual":' || actual || ',"predicted":' || predicted || ',"n":' || n || '}',
        ',' order by actual, predicted) || ']' as confusion from cells group by all""",
        ctes=_RESULTS,
    ),
)
_PERF_SCHEMA = T.StructType(
    [
        T.StructField("ex_tp", T.StringType()),
        *[T.StructField(c, T.IntegerType()) for c in ("max_features", "max_depth", "n_estimators")],
        T.StructField("model_name", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in _PROFITS.split()],
    ]
)


def _concatenated(s, d):
    """Performance files and confusion documents of two runs, the second repeating all models."""
    r = materialise(results(s, d), "results")
    perf, docs = scratch_path(s, "performance"), scratch_path(s, "confusions")
    summary = materialise(evaluate.arb_profit_summary(r, MODEL, "predicted"), "summary")
    json = materialise(evaluate.confusion_json(evaluate.confusion_matrix(r, ["model_name"])), "json")
    summary.write.option("header", True).csv(f"{perf}/run1")
    for run in ("run1", "run2"):
        json.write.json(f"{docs}/{run}")
    read = read_performance(s, f"{perf}/*", _PERF_SCHEMA)
    return read.join(read_confusions(s, f"{docs}/*"), "model_name")


add(
    "concat_perf",
    lambda s, d: tidy(_concatenated(s, d)),
    sql(
        """select summary.*, confusion from summary join (
        select model_name, '[' || string_agg('{"actual":' || actual || ',"predicted":' || predicted || ',"n":' || n || '}',
        ',' order by actual, predicted) || ']' as confusion from cells group by all) using (model_name)""",
        _PROFITS,
        ctes=_ALL,
    ),
)

# --- classifiers -----------------------------------------------------------------------------

PERIOD = HOUR
# fixed values: the four periods of the trade searches, beside the hour of the other queries, and the random draws
SEARCH_PERIODS = (PERIOD, 6 * HOUR, 12 * HOUR, 16 * HOUR, 24 * HOUR)
DRAWS = 50


def _trade_columns(df):
    return [c for c in df.columns if c not in (*SERIES, "timestamp", "target", "part", "label")]


def _long_enough(found, period, least):
    """Candles of the series whose time range holds more than ``least`` rows of ``period``; no other can be trained on."""
    by = ["exchange", "trading_pair"]
    span = (F.max("timestamp") - F.min("timestamp")) / period + 1
    return join_small(found, found.groupBy(*by).agg(span.alias("_n")).where(F.col("_n") > least).select(*by), by, "left_semi", salt_by="timestamp")


def _trade_table(s, d, periods=(PERIOD,), least=(0, 0)):
    """Features, labels and parts of all series with more than ``least`` training and test rows.

    Periods that no series is long enough for are left out before any feature is made.
    """
    stored = materialise(candles(s, d), "candles")
    long = {p: _long_enough(stored, p, sum(least)) for p in periods}
    found = [materialise(features.trade_features(c, p)) for p, c in long.items() if p == periods[0] or c.take(1)]
    rows = reduce(DataFrame.unionByName, found)
    columns = _trade_columns(rows)
    parts = splits.ordered_split(models.trade_rows(rows, columns))
    return materialise(models.trainable(parts, SERIES, *least), "training"), columns


def _trade_models(s, d, path):
    table, columns = _trade_table(s, d, least=models.TRADE_ROWS)
    return table, columns, models.fit_forests(table, SERIES, columns, 2, path)


REPORTED = ["timestamp", "part", "label"]


def _subset(columns):
    return models.features_per_node(models.DEFAULT_FOREST["featureSubsetStrategy"], len(columns))


def _trained(table, forests, keys, columns):
    return models.fit_report(score(table, forests, columns, keys, REPORTED, [Candidate(subset=_subset(columns))]), keys)


def _train_trade(s, d):
    table, columns, forests = _trade_models(s, d, scratch_path(s, "models"))
    return _trained(table, forests, SERIES, columns)


add("train_trade_model", lambda s, d: tidy(_train_trade(s, d)))


def _arb_table(s, d):
    """Features, target and profit of all exchange pairs with enough rows, split with an embargo."""
    table = features.feature_store(features.series_features(candles(s, d), PERIOD))
    training = features.arb_training_set(table, PERIOD)
    training = arbitrage.with_profit(training, 6 * PERIOD, PERIOD)
    rows = materialise(models.arb_rows(training, features.ARB_FEATURES))
    parts = splits.embargo_split(rows, keys=PAIR)
    return materialise(models.trainable(parts, PAIR, *models.ARB_ROWS), "training")


def _arb_models(s, d, path):
    table = _arb_table(s, d)
    return table, models.fit_forests(table, PAIR, features.ARB_FEATURES, 3, path)


def _train_arb(s, d):
    table, forests = _arb_models(s, d, scratch_path(s, "models"))
    return _trained(table, forests, PAIR, features.ARB_FEATURES)


add("train_arb_model", lambda s, d: tidy(_train_arb(s, d)))


def _search(s, d, candidates):
    table, columns = _trade_table(s, d, SEARCH_PERIODS, models.TRADE_ROWS)
    return models.search_trade(table, columns, candidates, scratch_path(s, "search"))


add("grid_search", lambda s, d: tidy(_search(s, d, models.param_grid(models.TRADE_GRID))))
add(
    "random_search",
    lambda s, d: tidy(_search(s, d, models.random_params(DRAWS, {**models.TRADE_GRID, "numTrees": [50, 100]}))),
)


def _arb_search(s, d):
    """Profits and confusion counts of each candidate on each exchange pair."""
    candidates = models.param_grid(models.ARB_GRID)
    confusion, profits = models.search_arb(_arb_table(s, d), features.ARB_FEATURES, candidates, scratch_path(s, "search"))
    model = ["ex_tp", "period", *models.SEARCHED]
    right = F.col("actual") == F.col("predicted")
    cells = confusion.groupBy(*model).agg(
        F.sum("n").alias("n_test"),
        F.coalesce(F.sum(F.when(right & (F.col("actual") != 0), F.col("n"))), F.lit(0)).alias("correct_arb"),
    )
    return cells.join(profits, model, "left")


add("arb_grid_search", lambda s, d: tidy(_arb_search(s, d)))


def _scored(s, d):
    """Models trained, saved and applied to the newest rows; predictions written once."""
    path, out = scratch_path(s, "models"), scratch_path(s, "scored")
    _, columns, forests = _trade_models(s, d, path)
    rows = features.trade_scoring_rows(candles(s, d), PERIOD)
    rows = materialise(models.trade_rows(rows.withColumn("target", F.lit(False)), columns))
    records = models.score_newest(rows, forests, SERIES, columns, _subset(columns))
    for _ in range(2):
        write_predictions(records, out, TRADE_PREDICTION_KEY)
    return s.read.schema(records.schema).parquet(out)


def _key_rows(s, d):
    """What does not depend on a forest: one record per series and its time."""
    found = _scored(s, d)
    complete = F.col("prediction").isNotNull() & F.col("c_time").isNotNull()
    return found.select("p_time", "exchange", "trading_pair", complete.alias("complete"))


add(
    "score_series",
    _key_rows,
    sql(
        f"""select make_timestamp((max("timestamp") + 3600) * 1000000) as p_time, exchange, trading_pair, true as complete
        from grid group by {K} having count(*) > 0"""
    ),
)


def _arb_scored(s, d):
    """Forests of all exchange pairs on each pair's newest features."""
    path, out = scratch_path(s, "models"), scratch_path(s, "scored")
    _, forests = _arb_models(s, d, path)
    newest = features.arb_features(features.feature_store(features.series_features(candles(s, d), PERIOD)))
    rows = materialise(models.arb_rows(newest.withColumn("target", F.lit(0)), features.ARB_FEATURES))
    records = models.score_newest(rows, forests, PAIR, features.ARB_FEATURES, _subset(features.ARB_FEATURES))
    for _ in range(2):
        write_predictions(records, out, ARB_PREDICTION_KEY)
    found = s.read.schema(records.schema).parquet(out)
    complete = F.col("prediction").isNotNull() & F.col("c_time").isNotNull()
    return found.select("p_time", "exchange_1", "exchange_2", "trading_pair", complete.alias("complete"))


add(
    "arb_score_series",
    _arb_scored,
    sql(
        """select make_timestamp((max("timestamp") + 3600) * 1000000) as p_time, exchange_1, exchange_2, trading_pair,
        true as complete from states group by exchange_1, exchange_2, trading_pair, period"""
    ),
)


def _roundtrip(s, d):
    """A forest over all series, before and after it was saved."""
    table, columns = _trade_table(s, d)
    fitted = models.forest(columns).fit(table.where(F.col("part") == "train"))
    path = models.artifact(scratch_path(s, "models"), "trade", ("all",))
    fitted.write().overwrite().save(path)
    both = [
        m.transform(table).select(*SERIES, "timestamp", F.col("prediction").alias(name))
        for m, name in ((fitted, "before"), (PipelineModel.load(path), "after"))
    ]
    joined = both[0].join(both[1], [*SERIES, "timestamp"])
    return joined.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") == F.col("after")).alias("same")
    )


add(
    "model_roundtrip",
    _roundtrip,
    sql(
        f"""select exchange, trading_pair, period, count(*) as n, count(*) as same from grid
        where ("timestamp", exchange, trading_pair) not in
          (select (min("timestamp"), exchange, trading_pair) from grid group by exchange, trading_pair)
          and ("timestamp", exchange, trading_pair) not in
          (select (max("timestamp"), exchange, trading_pair) from grid group by exchange, trading_pair) group by all"""
    ),
)


def _stacked(s, d):
    table, columns = _trade_table(s, d)
    return models.fit_report(models.stack(table, columns, (6, 14), SERIES), SERIES)


add("stacked_model", lambda s, d: tidy(_stacked(s, d)))


def _regimes(s, d):
    values = base.predictions(s, d).select(*SERIES, "timestamp", "close_diff")
    return regimes.regime_labels(values, "close_diff", SERIES)


add("regime_labels", lambda s, d: tidy(_regimes(s, d)))
