import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidewick.plans import growing, models, queries_models
from tidewick.plans.forests import Candidate, forest_nodes, score
from tidewick.schema import SERIES
from tidewick.sinks import tables

FEATURES = ["f", "g", "h", "const"]


@pytest.fixture(scope="module")
def table(spark):
    """Two series; the label follows the features with noise, so that trees go deep."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(700):
        x = rng.random(3).round(2)
        label = float(x[0] + x[1] + rng.normal() * 0.3 > 1) if rng.random() < 0.8 else 2.0
        rows.append(("a" if i % 3 else "b", "p", 300, 300 * i, *map(float, x), 1.0, label, "train" if i < 500 else "test"))
    return spark.createDataFrame(
        rows, "exchange string, trading_pair string, period int, timestamp long, f double, g double, h double, const double, label double, part string"
    )


def nodes_of(forests):
    """{(exchange, subset, tree): {node: (left, right, feature, cut, votes)}}"""
    out = {}
    for r in forests.collect():
        mine = out.setdefault((r.exchange, r.subset, r.tree), {})
        width = len(r.votes) // len(r.node)
        for i, node in enumerate(r.node):
            assert node not in mine
            mine[node] = (r.left[i], r.right[i], r.feature[i], r.cut[i], tuple(r.votes[width * i : width * (i + 1)]))
    return out


def grown(table, **more):
    how = dict(classes=3, subsets=[2, 4], trees=3, depth=12)
    return growing.grow_forests(table.where("part = 'train'"), SERIES, FEATURES, **{**how, **more})


def test_levels_over_blocks_give_the_trees_of_one_task(table):
    whole = nodes_of(grown(table))
    assert len(whole) == 2 * 2 * 3 and max(len(t) for t in whole.values()) > 50
    assert nodes_of(grown(table, block_rows=64)) == whole  # one task, many blocks
    assert nodes_of(grown(table, block_rows=64, local_rows=40)) == whole  # levels, then small nodes
    low = nodes_of(grown(table, depth=3))
    assert nodes_of(grown(table, depth=3, block_rows=128, local_rows=1)) == low  # levels to the leaves


def test_a_cut_forest_is_the_forest_grown_so(table):
    deep = grown(table, trees=6)
    for depth, trees in ((4, 6), (12, 2)):
        small = grown(table, depth=depth, trees=trees)
        asked = [Candidate(0, 2, depth, trees), Candidate(1, 4, depth, trees)]
        cut = score(table, deep, FEATURES, SERIES, ["timestamp"], asked)
        own = score(table, small, FEATURES, SERIES, ["timestamp"], [Candidate(0, 2), Candidate(1, 4)])
        rows = [sorted((r.exchange, r.timestamp, r.candidate, r.prediction, tuple(r.probability)) for r in d.collect()) for d in (cut, own)]
        assert len(rows[0]) == 1400 and rows[0] == rows[1]


def test_trees_against_brute_force(table):
    """Every node: its rows by descent, its class counts, and that no split of its features does better."""
    forests = nodes_of(grown(table, subsets=[4], trees=2, depth=6))
    train = table.where("part = 'train'").toPandas()
    for (exchange, _, tree), nodes in forests.items():
        mine = train[train.exchange == exchange].sort_values("timestamp")
        x, y = mine[FEATURES].to_numpy(), mine["label"].astype(int).to_numpy()
        draws = growing.bootstrap(42, np.array([tree]), mine["timestamp"].to_numpy())[0].astype(float)
        cuts = [np.unique(np.quantile(x[:, f], np.arange(1, 32) / 32, method="inverted_cdf")) for f in range(4)]

        def impurity(rows):
            counts = np.bincount(y[rows], draws[rows], 3)
            return counts.sum() - (counts**2).sum() / max(counts.sum(), 1e-9), counts

        def check(node, rows, depth):
            left, right, feature, cut, votes = nodes[node]
            here, counts = impurity(rows)
            assert np.array_equal(counts, votes)
            options = []
            for f in range(4):
                for value in cuts[f]:
                    goes = x[rows, f] <= value
                    if draws[rows[goes]].sum() and draws[rows[~goes]].sum():
                        options.append(impurity(rows[goes])[0] + impurity(rows[~goes])[0])
            gain = options and min(options) < here - 1e-9
            if feature < 0:
                assert depth == 6 or not gain
                return 1
            goes = x[rows, feature] <= cut
            assert gain and np.isclose(impurity(rows[goes])[0] + impurity(rows[~goes])[0], min(options))
            return 1 + check(left, rows[goes], depth + 1) + check(right, rows[~goes], depth + 1)

        assert check(1, np.arange(len(mine)), 0) == len(nodes)


def test_bootstraps_and_features_are_drawn_evenly():
    draws = growing.bootstrap(7, np.arange(200), np.arange(500) * 3600)
    assert abs(draws.mean() - 1) < 0.02 and abs((draws == 0).mean() - np.exp(-1)) < 0.01
    seen = growing.sampled(7, np.arange(4000), np.ones(4000, int), 10, 3)
    assert all(len(set(r)) == 3 for r in seen.tolist())
    assert np.allclose(np.bincount(seen.ravel(), minlength=10) / 4000, 0.3, atol=0.04)
    more = growing.sampled(7, np.arange(100), np.ones(100, int), 10, 6)
    assert all(set(a) <= set(b) for a, b in zip(seen[:100].tolist(), more.tolist()))


def test_forests_learn(table):
    forests = grown(table, subsets=[2], trees=40, depth=6)
    report = models.fit_report(score(table, forests, FEATURES, SERIES, ["timestamp", "part", "label"], [Candidate(subset=2)]), SERIES)
    for r in report.collect():
        assert r.n_train + r.n_test in (466, 234) and r.train_accuracy > 0.8 and r.test_accuracy > 0.5


def test_fits_resume_only_what_is_whole_and_current(spark, table, tmp_path, monkeypatch):
    fitted = []
    real = models.grow_forests

    def counted(train, *args):
        fitted.append(sorted(r.exchange for r in train.select("exchange").distinct().collect()))
        return real(train, *args)

    monkeypatch.setattr(models, "grow_forests", counted)
    path, small = str(tmp_path / "models"), {"numTrees": 2, "maxDepth": 2, "featureSubsetStrategy": "2"}

    def fit(rows, params=small):
        return models.fit_forests(rows, SERIES, FEATURES, 3, path, [params]).select("exchange", "tree").distinct().count()

    assert fit(table) == 4 and fitted == [["a", "b"]]
    assert fit(table.orderBy("f")) == 4 and len(fitted) == 1  # the same rows
    changed = table.withColumn("f", F.when(F.col("exchange") == "a", F.col("f") + 1).otherwise(F.col("f")))
    assert fit(changed) == 4 and fitted[1:] == [["a"]]  # other rows of one series
    assert fit(table, {**small, "maxDepth": 3}) == 4 and fitted[2:] == [["a", "b"]]  # other settings
    for name in tables.names_in(spark, path):
        fs, p = tables._path(spark, f"{path}/{name}/{models.FINISHED}")
        fs.delete(p, False)
    assert fit(table) == 4 and fitted[3:] == [["a", "b"]]  # fits that never finished


def test_saved_spark_forests_score_like_spark(spark, table, tmp_path):
    paths = {}
    for exchange in "ab":
        mine = table.where((F.col("exchange") == exchange) & (F.col("part") == "train"))
        paths[exchange, "p", 300] = path = models.artifact(str(tmp_path), "trade", (exchange, "p", 300))
        models.forest(FEATURES[:3], numTrees=8, maxDepth=5, featureSubsetStrategy="2").fit(mine).write().save(path)
    packed = forest_nodes(spark, paths, SERIES, [table.schema[k].dataType for k in SERIES])
    got = {(r.exchange, r.timestamp): r for r in score(table, packed, FEATURES[:3], SERIES, ["timestamp"]).collect()}
    assert len(got) == 700
    for (exchange, _, _), path in paths.items():
        for r in PipelineModel.load(path).transform(table.where(F.col("exchange") == exchange)).collect():
            mine = got[r.exchange, r.timestamp]
            assert mine.prediction == r.prediction and np.allclose(mine.probability, r.probability)


def test_too_deep_trees_are_refused(table, tmp_path):
    with pytest.raises(ValueError):
        models.forest(["f"], maxDepth=31)
    with pytest.raises(ValueError):
        models.fit_forests(table, SERIES, FEATURES, 3, str(tmp_path), [{"maxDepth": 31}])


def test_no_series_to_train_on(table, tmp_path):
    none = models.trainable(table, SERIES, 10_000, 10)
    forests = models.fit_forests(none, SERIES, FEATURES, 3, str(tmp_path / "m"))
    assert forests.count() == 0 and score(table, forests, FEATURES, SERIES, ["timestamp"]).count() == 0
    assert {r.exchange for r in models.trainable(table, SERIES, 200, 20).select("exchange").distinct().collect()} == {"a"}


def test_search_scores_each_candidate_once_in_every_period(table, tmp_path):
    rows = table.withColumns({"close_diff": F.col("f") - 0.5, "label": (F.col("label") > 0).cast("double")})
    slow = rows.withColumns({"period": F.lit(600), "timestamp": F.col("timestamp") * 2})
    both = models.trainable(rows.unionByName(slow), SERIES, 10, 10)
    draws = [{"maxDepth": 3, "featureSubsetStrategy": f, "numTrees": 2} for f in ("1", "2", "1")]
    got = models.search_trade(both, ["f", "g", "h"], draws, str(tmp_path)).collect()
    assert sorted((r.ex_tp, r.period, r.max_features) for r in got) == [
        (x, p, f) for x in ("a_p", "b_p") for p in (300, 600) for f in ("1", "2")
    ]


def test_stacked_members_never_score_what_they_were_fitted_on(spark):
    """On labels that are noise, members fitted on a row's own stretch would look clever in training."""
    rng = np.random.default_rng(6)
    rows = [("a", "p", 300, 300 * i, *map(float, rng.random(3)), float(rng.random() < 0.5), "train" if i < 800 else "test") for i in range(1000)]
    noise = spark.createDataFrame(rows, "exchange string, trading_pair string, period int, timestamp long, f double, g double, h double, label double, part string")
    got = models.stack(noise, FEATURES[:3], (2, 8), SERIES, folds=4, params={"numTrees": 20, "featureSubsetStrategy": "2"})
    report = models.fit_report(got, SERIES).first()
    assert (report.n_train, report.n_test) == (600, 200)  # the first stretch has nothing before it
    assert report.train_accuracy < 0.62 and 0.35 < report.test_accuracy < 0.65
    assert got.where("timestamp < 60000").count() == 0 and got.where("_member_0 is null or _member_1 is null").count() == 0
    clear = noise.withColumn("label", (F.col("f") > 0.5).cast("double"))
    report = models.fit_report(models.stack(clear, FEATURES[:3], (2, 8), SERIES, params={"numTrees": 20, "featureSubsetStrategy": "2"}), SERIES).first()
    assert report.test_accuracy > 0.9


@pytest.fixture(scope="module")
def short_series():
    """The registered searches on one trading pair of two exchanges, whose features are made once; nothing else changes."""
    real, table, made = queries_models.candles, queries_models._trade_table, {}
    patch = pytest.MonkeyPatch()
    patch.setattr(queries_models, "candles", lambda s, d: real(s, d).where("trading_pair = 'p0' and exchange in ('click', 'view')"))
    patch.setattr(queries_models, "_trade_table", lambda *a: made.setdefault(a[1:], None) or made.update({a[1:]: table(*a)}) or made[a[1:]])
    yield
    patch.undo()


@pytest.mark.parametrize("key, candidates", [("grid_search", 20), ("random_search", None), ("arb_grid_search", 84)])
def test_registered_searches_run_whole_grids(spark, short_series, key, candidates):
    got = queries_models.QUERIES[key](spark, "/root/testdata/sf0.001").toPandas()
    if candidates is None:
        drawn = models.random_params(queries_models.DRAWS, {**models.TRADE_GRID, "numTrees": [50, 100]})
        candidates = len({tuple(sorted(p.items())) for p in drawn})
    by = got.groupby(["ex_tp", "period"])
    assert (by.size() == candidates).all() and len(by) == (1 if key == "arb_grid_search" else 2)
    assert not got.duplicated(["ex_tp", "period", "max_features", "max_depth", "n_estimators"]).any()
    assert set(got["period"]) == {3600}
