"""Classifier evaluation.

Input: ``label`` and ``prediction`` as integer codes and ``probability`` as array<double>. Everything is
computed from counts, and several models or folds are evaluated in one pass with ``by``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlens.functions import vectors as V
from moodlens.operators import ranking

Z95 = 1.959964


def with_prediction(df: DataFrame) -> DataFrame:
    """Adds the most probable class (the first one on ties) and its probability."""
    return df.withColumn("prediction", V.argmax(F.col("probability"))).withColumn("confidence", F.array_max("probability"))


def pair_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, n_classes: int) -> DataFrame:
    """All label and prediction pairs, zeros included."""
    grid = df.sparkSession.range(n_classes * n_classes).select(
        F.floor(F.col("id") / n_classes).cast("int").alias("label"), F.pmod("id", F.lit(n_classes)).cast("int").alias("prediction"))
    return grid.join(pair_counts(df), ["label", "prediction"], "left").fillna(0, ["n"])


def class_table(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: true positives, truth, predicted, precision, recall and F1 (0 where undefined)."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("c"), hit.alias("tp"), n.alias("t"), zero.alias("p")),
        F.struct(F.col("prediction").alias("c"), zero.alias("tp"), zero.alias("t"), n.alias("p")),
    )
    sums = counts.select(*by, F.explode(sides).alias("s")).groupBy(*by, F.col("s.c").alias("class")).agg(
        F.sum("s.tp").alias("tp"), F.sum("s.t").alias("support"), F.sum("s.p").alias("predicted"))
    safe = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return (
        sums.withColumn("precision", safe(F.col("tp"), F.col("predicted")))
        .withColumn("recall", safe(F.col("tp"), F.col("support")))
        .withColumn("f1", safe(2 * F.col("tp"), F.col("predicted") + F.col("support")))
    )


def macro_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro precision, recall and F1 over the classes seen in truth or prediction."""
    per = class_table(pair_counts(df, by), by)
    return per.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
    )


def agreement(df: DataFrame) -> DataFrame:
    """Cohen's kappa and balanced accuracy."""
    per = class_table(pair_counts(df))
    n = F.sum("support")
    po = F.sum("tp") / n
    pe = F.sum(F.col("support") * F.col("predicted")) / (n * n)
    return per.agg(
        ((po - pe) / F.nullif(1 - pe, F.lit(0.0))).alias("kappa"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
    )


def classification_report(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per class, macro and weighted averages, in the shape of the usual text report."""
    per = class_table(pair_counts(df)).select(
        F.element_at(F.array(*[F.lit(x) for x in names]), F.col("class") + 1).alias("name"), "precision", "recall", "f1", "support")
    cols = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(c).alias(c) for c in cols], F.sum("support").alias("support")).withColumn("name", F.lit("macro avg"))
    weighted = per.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in cols], F.sum("support").alias("support")
    ).withColumn("name", F.lit("weighted avg"))
    return per.unionByName(macro).unionByName(weighted)


def _one_vs_rest(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per class and distinct score: positives and negatives with that score."""
    flat = df.select(*by, "label", F.posexplode("probability").alias("class", "score"))
    y = (F.col("label") == F.col("class")).cast("long")
    return flat.groupBy(*by, "class", "score").agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def auc_per_class(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact one-vs-rest area under the ROC curve by rank sums; null for a class without both sides."""
    part = [*by, "class"]
    ranked = ranking.running_totals(_one_vs_rest(df, by), part, "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    won = F.sum(F.col("pos") * below + F.col("pos") * F.col("neg") * 0.5)
    return ranked.groupBy(*part).agg((won / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))


def macro_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean over classes; not a number when a class is absent."""
    absent = F.count_if(F.col("auc").isNull()) > 0
    return auc_per_class(df, by).groupBy(*by).agg(F.when(absent, F.lit(float("nan"))).otherwise(F.avg("auc")).alias("auc"))


def roc_micro(df: DataFrame, corners: bool = False) -> DataFrame:
    """ROC points over all (row, class) pairs taken together, from the highest score down.

    ``corners`` leaves out points on a straight line between their neighbours: the curve and its area stay the same.
    """
    g = _one_vs_rest(df, ()).groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    g = g.withColumn("_all", F.lit(0)).withColumn("_order", -F.col("score"))
    ranked = ranking.running_totals(g, ["_all"], "_order", ["pos", "neg"], corners)
    if corners:
        straight = F.col("pos") * F.col("next_neg") == F.col("neg") * F.col("next_pos")
        ranked = ranked.filter(F.col("next_pos").isNull() | ~straight)
    totals = g.groupBy("_all").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    # one row of totals
    points = ranked.join(F.broadcast(totals), "_all").select(
        F.col("score").alias("threshold"), (F.col("cum_neg") / F.col("_n")).alias("fpr"), (F.col("cum_pos") / F.col("_p")).alias("tpr"))
    start = totals.select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def confidence_stats(df: DataFrame) -> DataFrame:
    c = F.array_max("probability")
    return df.agg(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))


def class_accuracy_interval(df: DataFrame) -> DataFrame:
    """Share of each true class that was predicted right, with its 95 % interval inside [0, 1]."""
    right = (F.col("label") == F.col("prediction")).cast("double")
    per = df.groupBy(F.col("label").alias("class")).agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))
    half = Z95 * F.sqrt(F.col("accuracy") * (1 - F.col("accuracy")) / F.col("n"))
    return per.withColumn("low", F.greatest(F.lit(0.0), F.col("accuracy") - half)).withColumn(
        "high", F.least(F.lit(1.0), F.col("accuracy") + half))


def predicted_counts(df: DataFrame) -> DataFrame:
    counts = df.groupBy("prediction").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # at most one row per class
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def distinct_predictions(models: Sequence[DataFrame], n_classes: int) -> DataFrame:
    """Whether the models together predict one class, some, or all."""
    seen = reduce(lambda a, b: a.unionByName(b), [m.select("prediction") for m in models])
    k = F.countDistinct("prediction")
    return seen.agg(k.alias("n_predicted"), F.when(k == 1, "one").when(k == n_classes, "all").otherwise("partial").alias("verdict"))


# --- tables of models (one row per model) ----------------------------------------------------------


def metrics_table(scored: DataFrame, by: str = "model") -> DataFrame:
    """One row per model from the stacked predictions of all models."""
    return macro_metrics(scored, [by]).join(macro_auc(scored, [by]), by)


def metrics_of(metrics: DataFrame, model: str) -> DataFrame:
    return metrics.filter(F.col("model") == model)


def winners(metrics: DataFrame) -> DataFrame:
    """Overall winner by F1 then AUC, and the best model of each metric (first by name on ties)."""

    def first(*order: str) -> Column:
        entry = F.struct(*[(-F.round(m, 9)).alias(m) for m in order], F.col("model").alias("model"))
        return F.min(entry)["model"]

    return metrics.agg(
        first("f1", "auc").alias("winner"), first("f1").alias("best_f1"), first("auc").alias("best_auc"),
        first("precision").alias("best_precision"), first("recall").alias("best_recall"),
    )


def compare_results(metrics: DataFrame) -> DataFrame:
    best, worst = F.max("f1"), F.min("f1")
    return metrics.agg(
        best.alias("best_f1"), worst.alias("worst_f1"),
        F.when(worst > 0, (best - worst) / worst * 100).otherwise(0.0).alias("improvement_pct"),
        F.when(best > 0.6, "good").when(best > 0.4, "moderate").otherwise("low").alias("tier"),
    )
