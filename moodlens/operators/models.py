"""Classifiers on review vectors: random forest, softmax boosting, cross-validation.

Input tables carry ``review_id``, an integer ``label`` and ``features`` as array<double>.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.operators import ensemble, evaluation, smote, splits
from moodlens.operators.boosting import Boosting, BoostOptions, best_round, fit_boosting
from moodlens.session import cut_lineage

__all__ = [
    "Boosting", "BoostOptions", "Ensemble", "Forest", "ForestOptions", "balanced", "best_round", "clip", "cross_validate", "cv_metrics",
    "fit_boosting", "fit_forest", "importance_table", "optimise_weights", "vectorised", "with_validation",
]

EPS = 1e-8
MAX_DEPTH = 30  # deepest tree the library builds; stands for "no limit"


@dataclass(frozen=True)
class ForestOptions:
    trees: int = 400
    max_depth: int = 0
    min_leaf: int = 1
    seed: int = 42


def _with_vector(df: DataFrame) -> DataFrame:
    return df.withColumn("_x", array_to_vector("features"))


def vectorised(df: DataFrame) -> DataFrame:
    return _with_vector(df).withColumn("_y", F.col("label").cast("double"))


def clip(df: DataFrame) -> DataFrame:
    inside = F.transform("probability", lambda p: F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS)))
    return df.withColumn("probability", inside)


@dataclass
class Forest:
    model: RandomForestClassificationModel

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(_with_vector(df)).withColumn("probability", vector_to_array("_prob"))
        return evaluation.with_prediction(out.drop("_x", "_prob", "_raw", "_pred"))

    def importances(self) -> list[float]:
        return [float(v) for v in self.model.featureImportances.toArray()]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> Forest:
        return Forest(RandomForestClassificationModel.load(path))


def fit_forest(train: DataFrame, options: ForestOptions = ForestOptions(), weight: str | None = None) -> Forest:
    depth = min(options.max_depth or MAX_DEPTH, MAX_DEPTH)
    rf = RandomForestClassifier(
        featuresCol="_x", labelCol="_y", probabilityCol="_prob", rawPredictionCol="_raw", predictionCol="_pred",
        numTrees=options.trees, maxDepth=depth, minInstancesPerNode=options.min_leaf, seed=options.seed,
        featureSubsetStrategy="sqrt",
    )
    if weight:
        rf = rf.setWeightCol(weight)
    return Forest(rf.fit(vectorised(train)))


@dataclass
class Ensemble:
    forest: Forest
    boosting: Boosting
    w1: float = 0.5
    w2: float = 0.5

    def predict(self, df: DataFrame) -> DataFrame:
        """Both models score the same row, so nothing is joined."""
        first = self.forest.predict(df).withColumnRenamed("probability", "_a").drop("prediction", "confidence")
        both = self.boosting.predict(first).withColumnRenamed("probability", "_b").drop("prediction", "confidence")
        mixed = F.zip_with("_a", "_b", lambda x, y: F.lit(self.w1) * x + F.lit(self.w2) * y)
        return evaluation.with_prediction(both.withColumn("probability", mixed).drop("_a", "_b"))


def importance_table(spark: SparkSession, values: list[float], k: int | None = None) -> DataFrame:
    """``feature, importance``, largest first; one row per embedding dimension."""
    df = spark.createDataFrame([(f"dim_{i}", v) for i, v in enumerate(values)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(k) if k else df


# --- balancing and validation --------------------------------------------------------------------


def balanced(train: DataFrame, method: str, seed: int = 42) -> tuple[DataFrame, str | None]:
    """The rows to fit on and the name of their weight column, if any."""
    if method == "SMOTE":
        out = smote.smote(train.withColumnRenamed("review_id", "id"), seed=seed)
        return cut_lineage(out.select(F.col("id").alias("review_id"), "label", "features")), None
    if method == "Class weights":
        return splits.with_class_weights(train, "label", "weight"), "weight"
    if method == "None":
        return train, None
    raise ValueError(f"unknown balancing method {method!r}")


def with_validation(train: DataFrame, method: str, share: float = 0.15, seed: int = 42) -> tuple[DataFrame, str | None]:
    """Real rows held out for early stopping; only the others are rebalanced."""
    cut = cut_lineage(splits.stratified_split(train, "label", share, seed, column="_part", parts=("fit", "validation")))
    fit_rows, weight = balanced(cut.filter(F.col("_part") == "fit").drop("_part"), method, seed)
    held = cut.filter(F.col("_part") == "validation").drop("_part")
    if weight:
        held = held.withColumn(weight, F.lit(1.0))
    return fit_rows.withColumn("_held", F.lit(False)).unionByName(held.withColumn("_held", F.lit(True))), weight


def cross_validate(
    train: DataFrame, fit: Callable, k: int = 5, method: str = "None", seed: int = 42
) -> DataFrame:
    """Out-of-fold predictions with their ``fold``; rebalancing happens inside each fold's train part.

    ``fit(rows, weight_column)`` returns a model. A failing fold raises: no made-up zeros.
    """
    folded = cut_lineage(splits.stratified_folds(train, "label", k, seed))
    parts = []
    for i in range(k):
        rows, weight = balanced(folded.filter(F.col("fold") != i).drop("fold"), method, seed)
        model = fit(rows, weight)
        parts.append(clip(model.predict(folded.filter(F.col("fold") == i))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def cv_metrics(predictions: DataFrame) -> DataFrame:
    """Mean over folds of the macro metrics; folds without an AUC do not count towards its mean."""
    per = evaluation.macro_metrics(predictions, ["fold"]).join(evaluation.macro_auc(predictions, ["fold"]), "fold")
    return per.agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
        F.avg(F.when(~F.isnan("auc"), F.col("auc"))).alias("auc"), F.count("*").alias("folds"),
    )


def optimise_weights(
    train: DataFrame, n_classes: int, forest: ForestOptions, boost: BoostOptions, seed: int = 42, method: str = "None"
) -> tuple[float, float]:
    """Fit both models on 80 % of the train rows and pick the grid weight with the best macro F1 on the rest.

    With class weights as balancing method the forest keeps them here, too.
    """
    cut = cut_lineage(splits.stratified_split(train, "label", 0.2, seed, column="_part", parts=("fit", "validation")))
    fit_rows, held = cut.filter(F.col("_part") == "fit"), cut.filter(F.col("_part") == "validation")
    weighted, weight = balanced(fit_rows, method) if method == "Class weights" else (fit_rows, None)
    a = fit_forest(weighted, forest, weight).predict(held)
    b = fit_boosting(fit_rows, n_classes, boost).predict(held)
    best = ensemble.best_weights(ensemble.weight_grid(a, b)).first()
    return best["w1"], best["w2"]
