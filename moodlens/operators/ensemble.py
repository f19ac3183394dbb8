"""Weighted probability ensemble of two models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.operators import evaluation

GRID = 9


def _paired(first: DataFrame, second: DataFrame, row_id: str) -> DataFrame:
    return first.select(row_id, "label", F.col("probability").alias("_a")).join(
        second.select(row_id, F.col("probability").alias("_b")), row_id)


def combine(first: DataFrame, second: DataFrame, w1: float = 0.5, w2: float | None = None, row_id: str = "review_id") -> DataFrame:
    """``w1 * p1 + w2 * p2`` per class; the first class wins ties."""
    w2 = 1.0 - w1 if w2 is None else w2
    mixed = F.zip_with("_a", "_b", lambda x, y: F.lit(w1) * x + F.lit(w2) * y)
    return evaluation.with_prediction(_paired(first, second, row_id).select(row_id, "label", mixed.alias("probability")))


def weight_grid(first: DataFrame, second: DataFrame, row_id: str = "review_id") -> DataFrame:
    """Macro F1 of the nine weights 0.1 to 0.9, in one grouped query."""
    weights = F.explode(F.array(*[F.lit(i * 0.1) for i in range(1, GRID + 1)]))
    grid = _paired(first, second, row_id).withColumn("w1", weights)
    mixed = F.zip_with("_a", "_b", lambda x, y: x * F.col("w1") + y * (1.0 - F.col("w1")))
    scored = evaluation.with_prediction(grid.select("w1", "label", mixed.alias("probability")))
    return evaluation.macro_metrics(scored, ["w1"]).select("w1", "f1")


def best_weights(grid: DataFrame) -> DataFrame:
    """The weight with the best F1; the smallest one on ties, even weights if none is above zero."""
    top = grid.orderBy(F.desc(F.round("f1", 9)), "w1").limit(1)
    w1 = F.when(F.col("f1") > 0, F.col("w1")).otherwise(F.lit(0.5))
    return top.select(w1.alias("w1"), (1.0 - w1).alias("w2"), "f1")
