"""CSV read in splits against Python's reader."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from moodlens.sources import reviews as src
from moodlens.sources import split_csv


def make(folder, files, rows, seed=1):
    """Files with cells over lines, doubled quotes, blank records, and one cell longer than several splits."""
    rng, want = random.Random(seed), []
    folder.mkdir()
    pieces = ["plain", "two\nlines", 'said ""so""', "a,b", "é日", "", "\n\n", "win\r\nline", "x" * 40]
    for f in range(files):
        with open(folder / f"part-{f}.csv", "w", encoding="utf-8", newline="") as out:
            end = "\r\n" if f % 2 else "\n"
            out.write("Score,Summary,Text" + end)
            for k in range(rows):
                text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
                if (f, k) == (0, rows // 2):
                    text = "long cell\n" * 1500
                cells = [str(k % 5), f"{f}-{k}", text.replace('""', '"')]
                want.append(cells)
                out.write(",".join(c if c and not set(c) & set(',"\r\n') else '"' + c.replace('"', '""') + '"' for c in cells) + end)
                if rng.random() < 0.05:
                    out.write(end)
    return want


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def rows_of(df):
    return [[c or "" for c in r] for r in df.collect()]


def test_same_rows_from_many_splits(spark, small_splits, tmp_path):
    want = make(tmp_path / "csv", 3, 300)
    python = []
    for f in range(3):
        with open(tmp_path / "csv" / f"part-{f}.csv", encoding="utf-8", newline="") as lines:
            python += [r for r in csv.reader(lines) if r][1:]
    assert python == want
    path = str(tmp_path / "csv")
    df = src.read_csv(spark, path)
    assert df.columns == ["Score", "Summary", "Text"]
    assert sorted(rows_of(df)) == sorted(want)
    # the long cell covers whole splits, and splits are read by tasks of their own
    state = split_csv.states(split_csv.lines(spark, path))
    assert state.count() > 20 and state.where("begins AND ends").count() > 3
    assert split_csv.lines(spark, path).rdd.getNumPartitions() > 8
    assert rows_of(src.read_csv(spark, path, ["Summary"])) != [] and src.read_csv(spark, path, ["Text", "Score"]).columns == ["Text", "Score"]


@pytest.mark.parametrize("n", [1, 149, 151, 305])
def test_first_rows_in_file_order(spark, small_splits, tmp_path, n):
    want = make(tmp_path / "csv", 2, 300, seed=n)
    assert rows_of(src.read_csv(spark, str(tmp_path / "csv"), n_rows=n)) == want[:n]


def test_empty_and_missing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("Score,Text\n")
    assert src.read_csv(spark, str(tmp_path / "empty.csv")).count() == 0
    with pytest.raises(ValueError, match="columns not found"):
        src.read_csv(spark, str(tmp_path / "empty.csv"), ["Nope"])
    (tmp_path / "plain.csv").write_text("Score,Text\n1,a\n2,\n")
    plain, split = (src.read_csv(spark, str(tmp_path / "plain.csv"), multi_line=m).collect() for m in (False, True))
    assert plain == split and split[1]["Text"] is None


def test_file_without_line_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Score,Text\n1,"x\ny"\n2,"z"')
    got = src.read_csv(spark, str(tmp_path / "a.csv")).orderBy("Score").select(F.col("Text")).collect()
    assert [r[0] for r in got] == ["x\ny", "z"]
