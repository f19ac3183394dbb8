"""Shared inputs of the catalogue."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.operators import cleaning, diagnostics, ensemble, evaluation, keywords, splits
from moodlens.session import scratch_path
from moodlens.sources import derived, sinks


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return derived.reviews(spark, sf)


def cleaned_all(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_reviews(reviews(spark, sf), drop_empty=False)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_reviews(reviews(spark, sf))


def kept(df: DataFrame) -> DataFrame:
    """Keep an input that several passes read. Disk-backed, and rebuilt from its source if lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def staged(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """The cleaned rows for operators that read them more than once; only the columns they need."""
    return kept(cleaned(spark, sf).select(*(cols or ("review_id", "Emotion", "tokens"))))


def written(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """The cleaned rows as a table, for jobs whose Python needs the memory that kept rows would take."""
    rows = cleaned(spark, sf).select(*(cols or ("review_id", "Emotion", "tokens")))
    return sinks.save_stage(rows, scratch_path(spark, "clean"), "zstd")


def freq(df: DataFrame) -> DataFrame:
    return diagnostics.token_freq(df)


def vectors(df: DataFrame) -> DataFrame:
    return derived.fixture_vectors(diagnostics.token_freq(df))


def split(df: DataFrame) -> DataFrame:
    return splits.stratified_split(df, "Emotion")


def long_vectors(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """One row per vector component."""
    return df.select(*keep, F.posexplode(vector).alias("dim", "value"))


def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Stacked predictions of the two derived models and their ensemble, one row per model and review."""
    first = kept(evaluation.with_prediction(derived.probabilities(spark, sf)))
    second = kept(evaluation.with_prediction(derived.probabilities(spark, sf, second=True)))
    both = ensemble.combine(first, second, 0.4, 0.6)
    named = [(first, "Random Forest"), (second, "Boosting"), (both, "Ensemble")]
    cols = ["review_id", "label", "probability", "prediction"]
    parts = [df.select(*cols, F.lit(name).alias("model")) for df, name in named]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.metrics_table(model_predictions(spark, sf))


def keyword_weights(spark: SparkSession, sf: str) -> DataFrame:
    counts = keywords.emotion_counts(cleaned(spark, sf), min_df=2)
    return keywords.cloud(keywords.log_odds(counts, min_freq=2))


def keyword_table(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.keyword_table(keyword_weights(spark, sf))
