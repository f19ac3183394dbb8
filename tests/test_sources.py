from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from moodlens.functions import labels
from moodlens.operators import cleaning
from moodlens.sources import reviews as src
from moodlens.sources import sinks


def test_coercion(spark):
    raw = ["5", "4.0", "3.5", "abc", "", None, "nan", "inf", "4d", "-1", "9", " 2 ", "1e0"]
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(zip(raw, ["1199145600", "x", None] + ["0"] * 10))], "i int, Score string, Time string")
    got = src.coerce_types(df).orderBy("i").collect()
    assert [r["Score"] for r in got] == [5, 4, None, None, None, None, None, None, None, -1, 9, 2, 1]
    assert [r["Time"] for r in got][:3] == [dt.datetime(2008, 1, 1), None, None]


def test_csv_with_quotes_commas_and_newlines(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('Score,Summary,Text,Time\n5,"said ""great"", twice","line one\nline two",1199145600\n2,,é,\n')
    df = src.read_reviews(spark, path)
    rows = df.collect()
    assert len(rows) == 2
    assert rows[0]["Summary"] == 'said "great", twice' and rows[0]["Text"] == "line one\nline two"
    assert rows[1]["Summary"] is None and rows[1]["Time"] is None
    assert src.read_reviews(spark, path, ["Score"], n_rows=1).collect() == [rows[0].__class__(Score=5)]


def test_dispatch_and_errors(spark, tmp_path):
    folder = str(tmp_path / "data")  # no suffix: a path is Parquet, an upload CSV
    spark.range(3).select(F.lit("4").alias("Score")).write.parquet(folder)
    assert src.read_reviews(spark, folder).count() == 3
    with pytest.raises(FileNotFoundError):
        src.read_reviews(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError, match="required columns"):
        src.require_columns(spark.range(1))
    with pytest.raises(ValueError, match="no rows"):
        src.require_rows(spark.range(0))
    with pytest.raises(ValueError, match="columns not found"):
        src.read_parquet(spark, folder, ["Nope"])


def test_text_column_detection(spark):
    df = spark.createDataFrame([("a", "b", 1)], "Review_Body string, Comment string, n int")
    assert src.text_columns(df) == ["Review_Body", "Comment"]
    assert src.text_columns(df.select("n")) == ["n"]


def test_source_text_modes(spark):
    df = spark.createDataFrame([(1, None, "T"), (2, " ", "T"), (3, "S", "T")], "review_id int, Summary string, Text string")
    pick = lambda **kw: [r["s"] for r in df.select("review_id", cleaning.source_text(df, **kw).alias("s")).orderBy("review_id").collect()]
    assert pick() == ["T", "T", "S"]
    assert pick(fallback=False) == [None, " ", "S"]
    assert pick(compat_nan=True) == ["nan", "T", "S"]
    assert pick(summary_only=False) == ["T", "T", "S T"]


def test_emotions(spark):
    df = spark.createDataFrame([(s,) for s in (None, -1, 0, 1, 2, 3, 4, 5, 9)], "s long")
    got = df.select(labels.emotion_default(F.col("s")).alias("a"), labels.emotion_mapped(F.col("s"), 1, 3, 5).alias("b")).collect()
    assert [r["a"] for r in got] == ["Unknown"] + ["Negative"] * 4 + ["Neutral"] + ["Positive"] * 3
    assert [r["b"] for r in got] == ["Unknown"] + ["Negative"] * 3 + ["Unknown", "Neutral", "Unknown", "Positive", "Positive"]


def test_written_csv_joins_arrays(spark, tmp_path):
    path = sinks.write_csv(spark.createDataFrame([(1, ["a", "b"])], "i int, w array<string>"), str(tmp_path / "o"))
    assert src.read_csv(spark, path).collect()[0]["w"] == "a,b"
    with pytest.raises(Exception, match="already exists"):
        sinks.write_csv(spark.range(1), path)


def test_stage_is_read_back(spark, tmp_path):
    df = sinks.save_stage(spark.range(5), str(tmp_path / "stage"))
    assert df.count() == 5 and df.inputFiles()
