from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlens.operators import evaluation, joins, ranking, rows, splits


def order(ids, seed):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}:{seed}".encode()).hexdigest())


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds almost everything."""
    return spark.range(5000).select(F.col("id").alias("review_id"), F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("Emotion")).cache()


def test_split_is_exact(spark, skewed):
    got = splits.stratified_split(skewed, test_size=0.2, seed=3).filter("split = 'test'").collect()
    for name, ids in (("rare", range(0, 5000, 50)), ("hot", [i for i in range(5000) if i % 50])):
        want = order(ids, 3)[: round(len(ids) * 0.2)]
        assert {r["review_id"] for r in got if r["Emotion"] == name} == set(want)


def test_split_rejects_tiny_class(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "review_id long, Emotion string")
    with pytest.raises(Exception, match="at least two rows"):
        splits.stratified_split(df).collect()


def test_folds_differ_by_at_most_one(skewed):
    sizes = splits.stratified_folds(skewed, k=7).groupBy("Emotion", "fold").count().collect()
    for name in ("rare", "hot"):
        n = [r["count"] for r in sizes if r["Emotion"] == name]
        assert len(n) == 7 and max(n) - min(n) <= 1


def test_rank_is_total_order(skewed):
    got = {r["review_id"]: r["class_rank"] for r in ranking.hash_rank(skewed, ["Emotion"], seed=9).filter("Emotion = 'rare'").collect()}
    assert sorted(got, key=got.get) == order(range(0, 5000, 50), 9)


@pytest.mark.parametrize("n", [0, 1, 777, 5000, 9999])
def test_sample_has_exact_size(skewed, n):
    ids = [r["review_id"] for r in rows.random_sample(skewed, n, seed=1).collect()]
    assert set(ids) == set(order(range(5000), 1)[:n]) and len(ids) == min(n, 5000)


@pytest.mark.parametrize("shape", ["spread", "clustered", "few"])
def test_running_totals(spark, shape):
    key = {"spread": F.col("id") * 0.37, "clustered": F.when(F.col("id") < 5, F.col("id") * 1.0).otherwise(10 + F.col("id") * 1e-9), "few": F.col("id") % 3 * 1.0}[shape]
    df = spark.range(3000).select(F.lit("a").alias("p"), key.alias("x"), F.lit(1).cast("long").alias("v")).groupBy("p", "x").agg(F.sum("v").alias("v"))
    got = [(r["x"], r["v"], r["cum_v"]) for r in ranking.running_totals(df, ["p"], "x", ["v"]).orderBy("x").collect()]
    total = 0
    for _, v, cum in got:
        total += v
        assert cum == total
    assert total == 3000


def test_keep_first_and_flags(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, None), (4, None), (5, "y")], "review_id long, clean_text string")
    assert {r["review_id"] for r in rows.drop_text_duplicates(df).collect()} == {1, 2, 5}
    assert {r["review_id"] for r in rows.exact_text_duplicates(df).filter("is_duplicate").collect()} == {3, 4}
    assert {r["review_id"] for r in rows.drop_hash_duplicates(df).collect()} == {1, 2, 5}


def test_salted_join_equals_plain_join(spark):
    # one key holds a third of all rows
    big = spark.range(6000).select(F.col("id").alias("review_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 200)).alias("token"))
    small = big.select("token").distinct().filter("token != 'k1'").withColumn("v", F.length("token"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(tuple, big.join(small, "token", how).collect()), key=repr)
        salted = sorted(map(tuple, joins.salted_join(big, small, "token", F.col("review_id"), how).select(*big.join(small, "token", how).columns).collect()), key=repr)
        assert plain == salted


def test_hot_keys_are_spread_in_proportion(spark):
    """Keys with 30 and 2 % of the rows; no part holds more than about a thousandth."""
    kind = F.when(F.col("id") % 100 < 30, "first").when(F.col("id") % 100 < 32, "second").otherwise(F.concat(F.lit("k"), F.col("id")))
    big = spark.range(60_000).select(F.col("id").alias("review_id"), kind.alias("token"))
    hot = {r["token"]: r["salts"] for r in joins.hot_keys(big, "token").collect()}
    assert set(hot) == {"first", "second"} and 290 <= hot["first"] <= 310 and 19 <= hot["second"] <= 22
    parts = joins.salted(big, F.broadcast(joins.hot_keys(big, "token")), "token", F.col("review_id")).groupBy("token", "_salt").count()
    sizes = {t: [r["count"] for r in parts.where(F.col("token") == t).collect()] for t in hot}
    assert max(sizes["first"] + sizes["second"]) < 2 * 60 and len(sizes["first"]) == hot["first"]
    # and in the tasks of a shuffle by key and salt
    salted = joins.salted(big, F.broadcast(joins.hot_keys(big, "token")), "token", F.col("review_id"))
    tasks = salted.repartition(16, "token", "_salt").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert tasks < 1.5 * 60_000 / 16


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(50).select(F.col("id").cast("string").alias("token"), F.array_repeat(F.lit(0.5), 1000).alias("vector"))
    assert joins.fits_broadcast(wide, 100)[1] and not joins.fits_broadcast(wide, 100, 50_000)[1]


def test_lookup_beyond_broadcast_limit(spark):
    big = spark.range(100).select(F.col("id").alias("review_id"), (F.col("id") % 10).cast("string").alias("token"))
    small = big.select("token").distinct().withColumn("v", F.lit(1))
    assert joins.token_lookup(big, small, "token", F.col("review_id"), max_rows=3).count() == 100
    assert not joins.fits_broadcast(small, 3)[1] and joins.fits_broadcast(small, 10)[1]


def test_class_weights(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b") for i in range(8)], "review_id long, Emotion string")
    got = {r["Emotion"]: r["weight"] for r in splits.class_weights(df).collect()}
    assert math.isclose(got["a"], 8 / (2 * 6)) and math.isclose(got["b"], 8 / (2 * 2))


def test_corners_keep_the_area(spark):
    rng = np.random.default_rng(2)
    rows = [(int(y), [1 - float(s), float(s)]) for y, s in zip(rng.integers(0, 2, 900), np.round(rng.random(900), 3))]
    df = spark.createDataFrame(rows, "label int, probability array<double>")
    area = {}
    for corners in (False, True):
        points = sorted(((r["fpr"], r["tpr"]) for r in evaluation.roc_micro(df, corners).collect()))
        area[corners] = (sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:])), len(points))
    assert abs(area[True][0] - area[False][0]) < 1e-12 and area[True][1] < area[False][1]
    two = spark.createDataFrame([(1, [0.1, 0.9]), (1, [0.2, 0.8]), (0, [0.7, 0.3]), (0, [0.6, 0.4])], "label int, probability array<double>")
    assert sorted((r["fpr"], r["tpr"]) for r in evaluation.roc_micro(two, True).collect()) == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
