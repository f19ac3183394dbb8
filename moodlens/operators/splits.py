"""Hold-out split, folds, class weights and the choice of balancing method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.operators import ranking


def _quota(test_size: float):
    def quota(total):
        return F.when(
            total < 2, F.raise_error(F.lit("every class needs at least two rows to be split")).cast("long")
        ).otherwise(F.round(total * F.lit(test_size)).cast("long"))

    return quota


def stratified_split(
    df: DataFrame, label: str = "Emotion", test_size: float = 0.2, seed: int = 42, row_id: str = "review_id",
    column: str = "split", parts: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Adds the split column: in each class exactly ``round(n * test_size)`` rows are held out.

    Rows are compared with their class's cut-off hash, so no row is shuffled.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    cut = ranking.hash_cutoffs(df.select(row_id, label), [label], _quota(test_size), row_id, seed)
    held_out = ranking.hash_key(row_id, seed) <= F.col("cutoff")
    # one row per class
    return (
        df.join(F.broadcast(cut.select(label, "cutoff")), label, "left")
        .withColumn(column, F.when(held_out, parts[1]).otherwise(parts[0]))
        .drop("cutoff")
    )


def stratified_folds(
    df: DataFrame, label: str = "Emotion", k: int = 5, seed: int = 42, row_id: str = "review_id"
) -> DataFrame:
    """Adds ``fold`` 0..k-1; sizes within a class differ by at most one."""
    ranked = ranking.hash_rank(df, [label], row_id, seed)
    return ranked.withColumn("fold", F.pmod(F.col("class_rank") - 1, F.lit(k)).cast("int")).drop("class_rank")


def class_counts(df: DataFrame, label: str = "Emotion") -> DataFrame:
    return df.groupBy("split", label).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, label: str = "Emotion") -> DataFrame:
    """``n / (classes * class size)`` per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    return counts.withColumn("total", totals.select("total").scalar()).withColumn("k", totals.select("k").scalar()).select(
        label, "n", (F.col("total") / (F.col("k") * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str = "Emotion", column: str = "weight") -> DataFrame:
    """Adds the weight of each row's class; the joined table has one row per class."""
    w = class_weights(df, label).select(label, F.col("weight").alias(column))
    return df.join(F.broadcast(w), label)


def default_balancing(df: DataFrame, label: str = "Emotion") -> DataFrame:
    """SMOTE when one class holds more than 60 % of the rows, else none."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    share = F.max("n") / F.sum("n")
    return counts.agg(share.alias("max_share"), F.when(share > 0.6, "SMOTE").otherwise("None").alias("method"))
