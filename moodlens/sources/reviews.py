"""Reading reviews from CSV or Parquet, with type coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlens import lexicons
from moodlens.sources import split_csv

NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DEFAULT_COLUMNS = ("Score", "Summary", "Text")
REQUIRED_COLUMNS = ("Score", "Summary")


def to_nullable_long(c: Column) -> Column:
    """Integral numbers as long; text that is no number, and fractions, become null."""
    text = c.cast("string")
    number = F.when(text.rlike(NUMERIC), text.try_cast("double"))
    return F.when(number == F.floor(number), number.try_cast("long"))


def coerce_types(df: DataFrame) -> DataFrame:
    """``Score`` to nullable long and epoch-second ``Time`` to timestamp, where present."""
    out = df
    if "Score" in df.columns:
        out = out.withColumn("Score", to_nullable_long(F.col("Score")))
    if "Time" in df.columns and not isinstance(df.schema["Time"].dataType, (T.TimestampType, T.TimestampNTZType)):
        text = F.col("Time").cast("string")
        out = out.withColumn("Time", F.timestamp_seconds(F.when(text.rlike(NUMERIC), text.try_cast("double"))))
    return out


#: Scan partitions from which an input is never dealt out again.
SMALL_SPLITS = 8


def spread_small_input(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work when the input is a few small files.

    Only inputs of fewer than ``SMALL_SPLITS`` scan partitions are shuffled, on a cluster of any size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SMALL_SPLITS):
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def _project(df: DataFrame, columns) -> DataFrame:
    if not columns:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*columns)


def read_csv(spark: SparkSession, path: str, columns=None, n_rows: int | None = None, multi_line: bool = True) -> DataFrame:
    """Header CSV in UTF-8; every column is read as text, large files by many tasks.

    Cells may span lines; ``multi_line=False`` says that none does, which saves a pass over the quotes. ``n_rows`` takes
    the first rows in the order of the files.
    """
    if multi_line or n_rows:
        return split_csv.read(spark, path, columns, n_rows)
    return _project(spark.read.options(header=True, escape='"', encoding="UTF-8").csv(path), columns)


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    return _project(spark.read.parquet(path), columns)


def read_reviews(spark: SparkSession, path: str, columns=None, n_rows: int | None = None,
                 uploaded: bool = False, multi_line: bool = True) -> DataFrame:
    """Pick the reader from the suffix, then coerce types.

    A plain path is CSV only when it ends in ``.csv``; an uploaded file is Parquet only when it
    ends in ``.parquet``. ``n_rows`` applies to CSV.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"path not found: {path}")
    name = path.lower()
    is_csv = not name.endswith(".parquet") if uploaded else name.endswith(".csv")
    df = read_csv(spark, path, columns, n_rows, multi_line) if is_csv else read_parquet(spark, path, columns)
    return coerce_types(df)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return found is not None and len(found) > 0


def first_rows(df: DataFrame, n: int, order: str = "review_id") -> DataFrame:
    """First n rows by the stable row identity (Spark files have no order of their own)."""
    return df.orderBy(order).limit(n)


def require_columns(df: DataFrame, columns=REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}; found: {df.columns}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df


def text_columns(df: DataFrame) -> list[str]:
    """Columns whose name hints at free text; all columns when none does."""
    hits = [c for c in df.columns if any(h in c.lower() for h in lexicons.TEXT_COLUMN_HINTS)]
    return hits or list(df.columns)
