"""From raw reviews to the cleaned, labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.functions import labels, text


def source_text(df: DataFrame, summary_only: bool = True, fallback: bool = True, compat_nan: bool = False) -> Column:
    """Which text to clean.

    Summary alone, Summary with Text where Summary is missing or blank, or both joined.
    ``compat_nan`` turns a null summary into the word ``nan`` instead of treating it as missing.
    """
    summary = F.col("Summary")
    if compat_nan:
        summary = F.coalesce(summary, F.lit("nan"))
    has_text = "Text" in df.columns
    if summary_only:
        if fallback and has_text:
            return F.when(text.is_blank(summary), F.col("Text")).otherwise(summary)
        return summary
    if has_text:
        both = F.concat(F.coalesce(summary, F.lit("")), F.lit(" "), F.coalesce("Text", F.lit("")))
        return F.regexp_replace(both, rf"(?U)^{text.SPACE}+|{text.SPACE}+\z", "")
    return summary


def drop_empty_clean(df: DataFrame) -> DataFrame:
    return df.filter(F.length("clean_text") > 0)


def clean_reviews(
    df: DataFrame,
    options: text.CleanOptions = text.CleanOptions(),
    summary_only: bool = True,
    fallback: bool = True,
    compat_nan: bool = False,
    drop_empty: bool = True,
    negative_max: int = 2,
    neutral: int = 3,
    positive_min: int = 4,
) -> DataFrame:
    """Adds ``source_text, tokens, n_tokens, clean_text, Emotion``; one scan, no shuffle."""
    out = df.withColumn("source_text", source_text(df, summary_only, fallback, compat_nan))
    out = out.withColumn("_cleaned", text.clean_tokens(F.coalesce(F.col("source_text"), F.lit("")), options))
    if drop_empty:
        # A plain filter would be pushed below the projection and clean every text twice.
        kept = F.when(F.size("_cleaned") > 0, F.array("_cleaned"))
        out = out.select("*", F.explode_outer(kept).alias("tokens")).filter(F.col("tokens").isNotNull())
    else:
        out = out.withColumn("tokens", F.col("_cleaned"))
    out = out.drop("_cleaned")
    out = out.withColumn("n_tokens", F.size("tokens")).withColumn("clean_text", F.array_join("tokens", " "))
    return out.withColumn("Emotion", labels.emotion_mapped(F.col("Score"), negative_max, neutral, positive_min))


def tokens_long(df: DataFrame, *keep: str) -> DataFrame:
    """One row per token occurrence, with the kept columns and the position.

    The outer form keeps the optimizer from adding a size filter that would clean every text twice.
    """
    long = df.select(*keep, F.posexplode_outer("tokens").alias("pos", "token"))
    return long.filter(F.col("token").isNotNull())
