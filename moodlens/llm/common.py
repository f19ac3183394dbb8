"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty if null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; plain ASCII texts take the fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def pieces(text: Column, separators: str) -> Column:
    """The parts between separators, without empty ones."""
    return F.array_remove(F.split(text, separators), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
