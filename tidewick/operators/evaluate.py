"""Classifier evaluation and model choice."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewick.operators.aggregate import exact_median


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each label occurs in each of the columns; labels are the union over all columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("source"), F.col(c).alias("label")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).where(F.col("p.label").isNotNull())
    counts = long.groupBy("p.label").agg(*[F.count_if(F.col("p.source") == c).alias(f"n_{c}") for c in columns])
    return counts


def confusion_matrix(df: DataFrame, keys: Sequence[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Counts over the full label x label grid of each key, with the share within the actual label."""
    counts = df.groupBy(*keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    labels = (
        counts.select(*keys, F.explode(F.array("actual", "predicted")).alias("label"))
        .where(F.col("label").isNotNull())
        .distinct()
    )
    grid = labels.groupBy(*keys).agg(F.collect_set("label").alias("_labels"))
    grid = grid.withColumn("actual", F.explode("_labels")).withColumn("predicted", F.explode("_labels"))
    full = grid.drop("_labels").join(counts, [*keys, "actual", "predicted"], "left").fillna(0, ["n"])
    row = F.sum("n").over(Window.partitionBy(*keys, "actual"))
    return full.withColumn("share", F.try_divide(F.col("n"), row))


def accuracy(df: DataFrame, keys: Sequence[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def classification_report(confusion: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Precision, recall, f1 and support per label; 0 where undefined."""
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.lit("a").alias("side")),
        F.struct(F.col("predicted").alias("label"), F.lit("p").alias("side")),
    )
    d = confusion.withColumn("_s", F.explode(sides))
    correct = (F.col("actual") == F.col("predicted")) & (F.col("_s.side") == "a")
    per = d.groupBy(*keys, F.col("_s.label").alias("label")).agg(
        F.sum(F.when(correct, F.col("n")).otherwise(0)).alias("_hit"),
        F.sum(F.when(F.col("_s.side") == "a", F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("_s.side") == "p", F.col("n")).otherwise(0)).alias("_predicted"),
    )
    zero = F.lit(0.0)
    per = per.withColumns(
        {
            "precision": F.coalesce(F.try_divide(F.col("_hit"), F.col("_predicted")), zero),
            "recall": F.coalesce(F.try_divide(F.col("_hit"), F.col("support")), zero),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))
    return per.select(*keys, "label", "precision", "recall", "f1", "support")


def model_scorecard(confusion: DataFrame, key: str = "model_name") -> DataFrame:
    """Correct arbitrage predictions and the share of wrong ones per predicted class (-1, 0, 1).

    A class in neither column yields null; a model that knows no class but 0 scores 0 throughout.
    """
    n, a, p = F.col("n"), F.col("actual"), F.col("predicted")
    sum_if = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")
    s = confusion.groupBy(key).agg(
        *[sum_if((a == c) & (p == c)).alias(f"_hit_{t}") for c, t in _CLASSES],
        *[sum_if(p == c).alias(f"_pred_{t}") for c, t in _CLASSES],
        F.max((n > 0) & ((a != 0) | (p != 0))).alias("_any"),
    )
    wrong = lambda t: 1 - F.try_divide(F.col(f"_hit_{t}"), F.col(f"_pred_{t}"))
    known = lambda value: F.when(F.col("_any"), value).otherwise(0)
    return s.select(
        key,
        known(F.col("_hit_neg1") + F.col("_hit_1")).cast("long").alias("correct_arb"),
        *[known(wrong(t)).cast("double").alias(f"pct_wrong_{t}") for t in ("0", "1", "neg1")],
        *[known(F.col(f"_hit_{t}")).cast("long").alias(f"correct_arb_{t}") for t in ("neg1", "1", "0")],
    )


_CLASSES = [(-1, "neg1"), (0, "0"), (1, "1")]


def arb_profit_summary(df: DataFrame, keys: Sequence[str], prediction: str = "pred") -> DataFrame:
    """Mean and exact median profit over rows predicting arbitrage."""
    d = df.where(F.col(prediction) != 0)
    mean = d.groupBy(*keys).agg(F.avg("pct_profit").alias("pct_profit_mean"))
    median = exact_median(d, "pct_profit", keys, "pct_profit_median")
    return mean.join(median, list(keys), "left")


def leaderboard(df: DataFrame, metric: str, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(metric).desc_nulls_last(), *tie)


def best_per_group(df: DataFrame, group: str, metric: str, tie: Sequence[str]) -> DataFrame:
    """The row with the highest metric of each group; equal ones go to the first by ``tie``.

    Expressed as an aggregation, so a group with most of the rows collapses on the map side.
    """
    rest = [c for c in df.columns if c not in {group, metric, *tie}]
    order = F.struct((-F.col(metric)).alias("_order"), *tie, metric, *rest)
    best = df.where(F.col(metric).isNotNull()).groupBy(group).agg(F.min(order).alias("_b"))
    return best.select(*[c if c == group else F.col(f"_b.{c}") for c in df.columns])


def select_models(
    scored: DataFrame, tie: Sequence[str], wrong: float = 0.30, correct: int = 25, profit: float = 0.2
) -> DataFrame:
    """Models rarely wrong on class 0, often right on arbitrage and profitable: the best per series."""
    good = scored.where(
        (F.col("pct_wrong_0") < wrong) & (F.col("correct_arb") > correct) & (F.col("pct_profit_mean") > profit)
    )
    return best_per_group(good, "ex_tp", "correct_arb", tie)


def confusion_json(confusion: DataFrame, key: str = "model_name") -> DataFrame:
    """One JSON document per model: its non-zero cells as records, by actual then predicted label."""
    cell = F.struct("actual", "predicted", "n")
    return confusion.where(F.col("n") > 0).groupBy(key).agg(
        F.to_json(F.array_sort(F.collect_list(cell))).alias("confusion")
    )
