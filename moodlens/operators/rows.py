"""Row selection: duplicates, short texts, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.functions import text
from moodlens.operators import ranking


def _first_ids(df: DataFrame, keys: Sequence[Column], row_id: str) -> DataFrame:
    # partial aggregation leaves one row per key and task, so a group holding a third of all rows is no hot spot
    return df.groupBy(text.row_key(*keys)).agg(F.min(row_id).alias(row_id)).select(row_id)


def flag_repeats(df: DataFrame, keys: Sequence[Column], row_id: str = "review_id", flag: str = "is_duplicate") -> DataFrame:
    """Marks every row that is not the first (smallest id) of its key group.

    The join is on the unique row id, which cannot be skewed.
    """
    first = _first_ids(df, keys, row_id).withColumn("_first", F.lit(True))
    return df.join(first, row_id, "left").withColumn(flag, F.col("_first").isNull()).drop("_first")


def keep_first(df: DataFrame, keys: Sequence[Column], row_id: str = "review_id") -> DataFrame:
    return df.join(_first_ids(df, keys, row_id), row_id, "left_semi")


def drop_exact_duplicates(df: DataFrame, row_id: str = "review_id") -> DataFrame:
    """Keep the first of rows that agree in every data column."""
    return keep_first(df, [F.col(c) for c in df.columns if c != row_id], row_id)


def exact_text_duplicates(df: DataFrame, row_id: str = "review_id") -> DataFrame:
    return flag_repeats(df, [F.col("clean_text")], row_id)


def drop_text_duplicates(df: DataFrame, row_id: str = "review_id") -> DataFrame:
    return keep_first(df, [F.col("clean_text")], row_id)


def hash_duplicates(df: DataFrame, column: str = "clean_text", row_id: str = "review_id") -> DataFrame:
    """Adds the content hash and marks repeats of it; a null text hashes as the empty text."""
    hashed = df.withColumn("content_hash", text.content_hash(F.col(column)))
    return flag_repeats(hashed, [F.col("content_hash")], row_id)


def drop_hash_duplicates(df: DataFrame, column: str = "clean_text", row_id: str = "review_id") -> DataFrame:
    return keep_first(df, [text.content_hash(F.col(column))], row_id)


def is_short(threshold: int = 2) -> Column:
    return F.col("n_tokens") <= threshold


def short_reviews(df: DataFrame, threshold: int = 2) -> DataFrame:
    return df.filter(is_short(threshold))


def drop_short(df: DataFrame, threshold: int = 2) -> DataFrame:
    return df.filter(~is_short(threshold))


def short_report(df: DataFrame, threshold: int = 2) -> DataFrame:
    n = F.count("*")
    short = F.count_if(is_short(threshold))
    return df.agg(
        n.alias("n_rows"),
        short.alias("n_short"),
        (short * 100.0 / F.nullif(n, F.lit(0))).alias("pct_short"),
        (short > n * 0.1).alias("high_share"),
    )


def random_sample(df: DataFrame, n: int, seed: int = 42, row_id: str = "review_id") -> DataFrame:
    """Exactly n rows, the same ones for the same seed on any cluster."""
    return ranking.smallest_hashes(df, n, row_id, seed)


def of_emotion(df: DataFrame, emotion: str) -> DataFrame:
    return df.filter(F.col("Emotion") == emotion)


def train_rows(df: DataFrame, split: DataFrame, row_id: str = "review_id") -> DataFrame:
    return df.join(split.filter(F.col("split") == "train").select(row_id), row_id, "left_semi")


def preview_rows(df: DataFrame, n: int = 12) -> DataFrame:
    """First n rows with shortened texts."""
    return (
        df.orderBy("review_id").limit(n)
        .select(
            "review_id", "Score", "Emotion",
            text.preview(F.col("Summary"), 60).alias("Summary"),
            text.preview(F.col("clean_text"), 80).alias("clean_text_preview"),
        )
    )


def first_sample_per_emotion(df: DataFrame) -> DataFrame:
    first = F.min_by("clean_text", "review_id")
    return df.groupBy("Emotion").agg(text.preview(first, 60).alias("sample"))
