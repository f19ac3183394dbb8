"""The projection forest against exact neighbours, and the work it does."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moodlens.operators import neighbours, smote


def points(spark, n, inner=10, dim=40, seed=0):
    """Clusters in ``inner`` dimensions, turned into ``dim`` ones, two classes."""
    rng = np.random.default_rng(seed)
    z = rng.normal(size=(n, inner)) + 3 * rng.normal(size=(8, inner))[rng.integers(0, 8, n)]
    x = z @ rng.normal(size=(inner, dim)) + 0.1 * rng.normal(size=(n, dim))
    frame = pd.DataFrame({"id": np.arange(n) * 3 + (1 << 60), "label": (np.arange(n) % 5 == 0).astype(int), "features": list(x)})
    return spark.createDataFrame(frame).withColumn("label", F.col("label").cast("int")).repartition(4).cache()


def pairs(df):
    return df.groupBy(*neighbours.LEAF).count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]


def test_recall_against_the_exact_path(spark):
    df = points(spark, 4000)
    exact = smote.nearest_same_class(df, 5, 512)
    found = neighbours.nearest(df, 5, leaf_rows=256)
    same = found.join(exact, ["id", "neighbour"]).count()
    assert same >= 0.9 * exact.count() == 0.9 * 5 * 4000
    assert found.count() == 5 * 4000
    wrong = found.join(exact.select("id", "neighbour", F.col("distance").alias("d")), ["id", "neighbour"]).where("abs(d - distance) > 1e-4")
    assert wrong.count() == 0


def test_work_is_linear(spark):
    """Ten times the rows take about ten times the pairs; the exact path may take a hundred times."""
    small, large = (pairs(neighbours.leaves(points(spark, n), trees=4, leaf_rows=128)) / n for n in (1500, 15000))
    assert large < 1.5 * small and large < 2 * 128 * 5


def test_one_leaf_is_exact(spark):
    df = points(spark, 300)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in neighbours.nearest(df, 4).collect()}
    rows = df.collect()
    for label in (0, 1):
        mine = [r for r in rows if r["label"] == label]
        x = np.array([r["features"] for r in mine])
        for i, r in enumerate(mine):
            d = ((x - x[i]) ** 2).sum(axis=1)
            order = [j for j in np.argsort(d) if j != i][:4]
            assert [got[r["id"], k + 1] for k in range(4)] == [mine[j]["id"] for j in order]


@pytest.mark.parametrize("rows", [1, 2, 900])
def test_copies_and_small_classes(spark, rows):
    """Copies of one point fill leaves that no cut splits; they are dealt into bounded blocks."""
    df = spark.range(rows).select("id", F.lit(0).alias("label"), F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    found = neighbours.nearest(df, 3, trees=2, leaf_rows=64)
    assert found.where("distance > 0").count() == 0 and found.where("id = neighbour").count() == 0
    assert found.count() == rows * min(3, rows - 1)
    sizes = neighbours.leaves(df, 2, 64).groupBy(*neighbours.LEAF).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 64


def test_smote_by_forest_and_exactly(spark):
    df = points(spark, 600)
    for exact in (False, True):
        out = smote.smote(df, block_rows=64, exact=exact)
        assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 480, 1: 480}
    with pytest.raises(ValueError, match="without an id"):
        smote.smote(df.withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id"))))
