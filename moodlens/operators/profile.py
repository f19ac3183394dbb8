"""Table profile and label distributions: one pass each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlens.functions import labels, text


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null and null counts, null share in percent."""
    n = F.count("*")
    counts = df.agg(n.alias("n_rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    entries = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"c{i}").alias("non_null"))
        for i, f in enumerate(df.schema.fields)
    ])
    nulls = F.col("n_rows") - F.col("e.non_null")
    return counts.select("n_rows", F.explode(entries).alias("e")).select(
        "e.column", "e.dtype", "e.non_null", nulls.alias("nulls"),
        F.round(nulls * 100.0 / F.nullif("n_rows", F.lit(0)), 2).alias("null_pct"),
    )


def duplicate_row_count(df: DataFrame) -> DataFrame:
    groups = df.groupBy(text.row_key(*df.columns)).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def score_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("Score").agg(F.count("*").alias("n"))


def with_share(counts: DataFrame, n: str = "n", by: tuple[str, ...] = (), share: str = "pct") -> DataFrame:
    """Percent of the total; ``counts`` is already grouped to a few rows."""
    total = F.sum(n).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return counts.withColumn(share, F.col(n) * 100.0 / total)


def emotion_distribution(df: DataFrame) -> DataFrame:
    return with_share(df.groupBy("Emotion").agg(F.count("*").alias("n")))


def score_emotions(df: DataFrame) -> DataFrame:
    """Distribution of the default emotions over rows that have a score."""
    scored = df.filter(F.col("Score").isNotNull())
    return emotion_distribution(scored.select(labels.emotion_default(F.col("Score")).alias("Emotion")))


def dataset_summary(df: DataFrame) -> DataFrame:
    n = F.count("*")
    cells = reduce(lambda a, b: a + b, [F.count(F.col(c)) for c in df.columns])
    return df.agg(
        n.alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        (cells * 100.0 / F.nullif(n * len(df.columns), F.lit(0))).alias("completeness_pct"),
    )


def invalid_scores(df: DataFrame) -> DataFrame:
    n, bad = F.count("*"), F.count_if(F.col("Score").isNull())
    return df.agg(
        bad.alias("n_invalid"),
        (bad * 100.0 / F.nullif(n, F.lit(0))).alias("pct_invalid"),
        (bad > n * 0.5).alias("mostly_invalid"),
    )


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """What cleaning did. ``cleaned`` must still hold the rows that became empty."""
    src, out = F.coalesce("source_text", F.lit("")), F.coalesce(F.size("tokens"), F.lit(0))
    before = F.size(text.tokenise(src))
    kept = F.sum("_after") / F.nullif(F.sum("_before"), F.lit(0))
    return (
        cleaned.select(
            before.alias("_before"), out.alias("_after"), text.is_blank(F.col("Summary")).alias("_fallback")
        )
        .agg(
            F.count_if(F.col("_before") == 0).alias("empty_before"),
            F.count_if(F.col("_after") == 0).alias("empty_after"),
            F.sum("_before").alias("tokens_before"),
            F.sum("_after").alias("tokens_after"),
            F.coalesce(kept, F.lit(0.0)).alias("preservation_rate"),
            F.coalesce(kept < 0.3, F.lit(True)).alias("low_preservation"),
            F.count_if("_fallback").alias("n_fallback"),
        )
    )


def class_balance(df: DataFrame) -> DataFrame:
    """Largest and smallest class share and the verdict on their ratio."""
    counts = df.groupBy("Emotion").agg(F.count("*").alias("n"))
    top, low, total = F.max("n"), F.min("n"), F.sum("n")
    return counts.agg(
        F.max_by("Emotion", F.struct(F.col("n"), F.col("Emotion"))).alias("largest_class"),
        (top / total).alias("max_share"),
        (low / total).alias("min_share"),
        (top / low).alias("ratio"),
        F.when(top / total > 0.7, "severe").when(top / low > 3, "moderate").otherwise("good").alias("verdict"),
    )


def imbalance_ratio(df: DataFrame) -> DataFrame:
    """Largest over smallest class; infinite when a class is empty."""
    counts = df.groupBy("Emotion").agg(F.count("*").alias("n"))
    ratio = F.when(F.min("n") > 0, F.max("n") / F.min("n")).otherwise(F.lit(float("inf")))
    return counts.agg(
        F.max("n").alias("max_class"), F.min("n").alias("min_class"), ratio.alias("ratio"),
        F.when(ratio > 10, "significant").when(ratio > 3, "moderate").otherwise("balanced").alias("tier"),
    )


def by_year(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Time").isNotNull()).groupBy(F.year("Time").alias("year")).agg(
        F.count("*").alias("n"), F.min(F.to_date("Time")).alias("first_day"), F.max(F.to_date("Time")).alias("last_day")
    )


def emotion_trend(df: DataFrame, granularity: str = "Month", time: str = "Time", group: str = "Emotion") -> DataFrame:
    """Counts per period and emotion with the emotion's share of its period."""
    counts = df.groupBy(labels.period(F.col(time), granularity).alias("period"), group).agg(F.count("*").alias("n"))
    return with_share(counts, by=("period",), share="share_pct")
