"""Prediction tables, confidence and the prediction history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlens.functions import text
from moodlens.functions import vectors as V


def label_of(index: Column, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in names]), index + 1)


def label_predictions(df: DataFrame, names: Sequence[str], confidence: bool = True, all_probabilities: bool = False) -> DataFrame:
    """Adds ``Predicted_Emotion`` and, as asked, ``Confidence`` and one ``Prob_<label>`` per class."""
    out = df.withColumn("Predicted_Emotion", label_of(V.argmax(F.col("probability")), names))
    if confidence:
        out = out.withColumn("Confidence", F.array_max("probability"))
    if all_probabilities:
        for i, name in enumerate(names):
            out = out.withColumn(f"Prob_{name}", F.col("probability")[i])
    return out


def zero_vector_guard(df: DataFrame) -> DataFrame:
    """Marks rows without a recognised word: their prediction says nothing."""
    return df.withColumn("no_known_words", V.near_zero(F.col("features")))


def ranked_probabilities(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per review and label, from the most probable down; label order breaks ties."""
    entries = F.array(*[
        F.struct((-F.col("probability")[i]).alias("neg"), F.lit(i).alias("i"), F.lit(n).alias("label")) for i, n in enumerate(names)
    ])
    return df.select("review_id", F.posexplode(F.sort_array(entries)).alias("pos", "e")).select(
        "review_id", (F.col("pos") + 1).alias("rank"), "e.label", (-F.col("e.neg")).alias("probability"))


def confidence_tier(c: Column) -> Column:
    return F.when(c >= 0.8, "high").when(c >= 0.6, "moderate").when(c >= 0.4, "low").otherwise("very low")


def batch_summary(df: DataFrame, label: str = "Predicted_Emotion") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0))))


def batch_quality(df: DataFrame, confidence: str = "Confidence") -> DataFrame:
    c, n = F.col(confidence), F.count("*")
    low = F.count_if(c < 0.6)
    return df.agg(F.avg(c).alias("mean_confidence"), F.count_if(c >= 0.8).alias("n_high"), low.alias("n_low"),
                  (low * 100.0 / F.nullif(n, F.lit(0))).alias("pct_low"))


def history_rows(df: DataFrame, model: str, text_col: str = "Text", when: Column | None = None) -> DataFrame:
    """Log rows for scored reviews; the text is cut to fifty characters for display."""
    t = F.col(text_col)
    shown = F.when(F.length(t) > 50, text.preview(t, 50)).otherwise(t)
    return df.select(
        "review_id", shown.alias("text"), F.col("Predicted_Emotion").alias("prediction"), F.col("Confidence").alias("confidence"),
        F.lit(model).alias("model"), (F.current_timestamp() if when is None else when).alias("timestamp"),
        F.col("n_tokens").alias("word_count"),
        F.coalesce(F.col("n_in_vocab") / F.nullif("n_tokens", F.lit(0)), F.lit(0.0)).alias("vocab_coverage"),
    )


def recent(history: DataFrame, k: int = 10) -> DataFrame:
    """The newest k predictions with their mean confidence."""
    top = history.orderBy(F.desc("timestamp"), F.desc("review_id")).limit(k)
    return top.withColumn("mean_confidence", F.avg("confidence").over(Window.partitionBy(F.lit(0))))


def most_common(history: DataFrame) -> DataFrame:
    counts = history.groupBy("prediction").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "prediction").limit(1)


def history_analytics(history: DataFrame) -> DataFrame:
    per = history.groupBy("prediction").agg(
        F.count("*").alias("n"), F.sum("confidence").alias("c"), F.sum("vocab_coverage").alias("v"))
    return per.agg(
        F.sum("n").alias("n_predictions"), (F.sum("c") / F.sum("n")).alias("mean_confidence"),
        F.min(F.struct((-F.col("n")).alias("k"), F.col("prediction").alias("prediction")))["prediction"].alias("most_common"),
        (F.sum("v") / F.sum("n")).alias("mean_coverage"),
    )


def append_history(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def reset_history(like: DataFrame, path: str) -> None:
    """Empty the log and keep its columns."""
    like.limit(0).write.mode("overwrite").parquet(path)
