"""Writers. Each returns the path so that a caller can read the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """CSV with header. Array columns are joined by commas, as CSV holds no arrays."""
    flat = df.select(*[
        F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name)
        if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema.fields
    ])
    flat.write.mode(mode).options(header=True, escape='"').csv(path)
    return path


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", codec: str | None = None) -> str:
    """Parquet, compressed as the session says unless ``codec`` names another way."""
    df.write.mode(mode).options(**({"compression": codec} if codec else {})).parquet(path)
    return path


def write_cleaned(df: DataFrame, path: str) -> str:
    """Cleaned dataset without the working columns."""
    return write_csv(df.drop("source_text", "tokens", "n_tokens"), path)


def write_metrics(df: DataFrame, path: str) -> str:
    return write_csv(df, path)


def write_keywords(df: DataFrame, path: str) -> str:
    return write_csv(df.select("Emotion", "Rank", "Word", "Weight"), path)


def write_predictions(df: DataFrame, path: str, model: str) -> str:
    """Predictions with the model name and the time of scoring in every row."""
    stamped = df.withColumn("model_used", F.lit(model)).withColumn("prediction_timestamp", F.current_timestamp())
    keep = [f.name for f in stamped.schema.fields if f.dataType.typeName() not in ("vectorudt", "udt")]
    return write_csv(stamped.select(*keep), path)


def write_history(df: DataFrame, path: str) -> str:
    return write_csv(df, path)


def save_stage(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write one pipeline stage and continue from the written table.

    The table is both the hand-off between jobs and the lineage cut: a lost executor re-reads it.
    """
    write_table(df, path, codec=codec)
    return df.sparkSession.read.parquet(path)


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
