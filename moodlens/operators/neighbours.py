"""Nearest neighbours of every row within its class, by a forest of random projections.

Each tree cuts a class at medians along random directions until its parts hold at most ``leaf_rows`` rows, and a row
looks for neighbours among the rows of its leaves. A leaf is bounded, so the pairs compared grow in proportion to
the rows, whatever the vectors look like; how many true neighbours are found is measured in the tests (0.9 or more of
the exact ones). Classes that fit into one leaf get exact answers.

Directions are drawn from the spread of a bounded sample, so that trees cut across the directions in which rows
differ most. They are shared by all nodes of a depth, and a row is projected once. After that only the projections
move: a stage finds the nodes that are still too large, takes a bounded sample of each, makes the medians of the next
``STAGE`` depths from it, and sends rows down by column expressions. Copies cannot be cut by medians: what is left of
a leaf beyond twice its size is dealt into blocks by hash, where copies still find each other.

One more tree deals rows at random, so that a row whose leaves are small still meets enough others.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from moodlens.session import cut_lineage

TREES = 10
LEAF_ROWS = 1024
#: Depths that a stage cuts; rows of a node that its medians are taken from; rows that the directions are drawn from.
STAGE = 6
NODE_SAMPLE = 4096
SPREAD_SAMPLE = 4096
#: Nodes whose medians are sent to every executor (at most 0.6 KB each); beyond that they are joined by a shuffle.
BROADCAST_NODES = 20_000
#: Depths that a tree has beyond the least number, for uneven cuts.
SPARE_DEPTHS = 4
NODE = ["label", "tree", "node"]
LEAF = [*NODE, "block"]


def _uniform(*key: object) -> F.Column:
    """A number in [0, 1) that depends on the key alone, the same when a task is repeated."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)


def directions(rows: DataFrame, count: int, seed: int) -> np.ndarray:
    """``count`` unit vectors, drawn so that directions of large spread are likelier."""
    drawn = rows.select("features").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SPREAD_SAMPLE).collect()
    x = np.array([r["features"] for r in drawn], np.float64)
    x -= x.mean(axis=0)
    rng = np.random.default_rng(seed)
    out = rng.normal(size=(count, len(x))) @ x / math.sqrt(len(x))
    out = np.where(np.abs(out).max(axis=1, keepdims=True) > 0, out, rng.normal(size=out.shape))
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _projected(rows: DataFrame, trees: int, depth: int, seed: int) -> DataFrame:
    """``(id, label, tree, path, node)``: a row's projections for each tree, all rows at the root."""
    lines = directions(rows, trees * depth, seed) if depth else np.zeros((0, 0))
    schema = StructType([*rows.select("id", "label").schema.fields, StructField("paths", ArrayType(ArrayType(DoubleType())))])

    def project(parts):
        for part in parts:
            lists = part.column("features")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            found = x @ lines.T if depth else np.zeros((len(x), 0))
            inner = pa.ListArray.from_arrays(np.arange(len(x) * trees + 1, dtype=np.int32) * depth, found.ravel())
            outer = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * trees, inner)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), outer], names=["id", "label", "paths"])

    return rows.select("id", "label", "features").mapInArrow(project, schema).select(
        "id", "label", F.posexplode("paths").alias("tree", "path"), F.lit(1).cast("long").alias("node"))


def _medians(offset: int):
    """The cuts of a node's next depths, from a sample of its rows, numbered like a heap."""

    def build(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        depths = int(sample["depths"].iloc[0])
        x = np.stack(sample["path"].to_numpy())[:, offset : offset + depths]
        cuts, place = np.zeros((1 << depths) - 1), np.ones(len(x), np.int64)
        for d in range(depths):
            for k in range(1 << d, 1 << (d + 1)):
                mine = x[place == k, d]
                cuts[k - 1] = np.median(mine) if len(mine) else 0.0
            place = 2 * place + (x[:, d] > cuts[place - 1])
        return pd.DataFrame({"label": [key[0]], "tree": [key[1]], "node": [key[2]], "depths": [depths], "cuts": [cuts]})

    return build


def _send(rows: DataFrame, table: DataFrame, count: int, how: str) -> DataFrame:
    return rows.join(F.broadcast(table) if count <= BROADCAST_NODES else table, NODE, how)


def leaves(rows: DataFrame, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 42) -> DataFrame:
    """``(id, label, tree, node, block)``: the leaf of every row in every tree."""
    sizes = [r["count"] for r in rows.groupBy("label").count().collect()]  # one row per class
    depth = math.ceil(math.log2(max(max(sizes, default=1) / leaf_rows, 1)))
    depth = depth and -(-(depth + SPARE_DEPTHS) // STAGE) * STAGE
    placed = cut_lineage(_projected(rows, trees, depth, seed))
    for offset in range(0, depth, STAGE):
        large = cut_lineage(placed.groupBy(*NODE).agg(F.count("*").alias("n")).where(F.col("n") > leaf_rows).withColumn(
            "depths", F.least(F.lit(STAGE), F.ceil(F.log2(F.col("n") / leaf_rows)).cast("int"))))
        count = large.count()
        if not count:
            break
        drawn = _send(placed, large, count, "inner").where(_uniform("id", "tree", F.lit(offset + seed)) * F.col("n") < NODE_SAMPLE)
        cuts = cut_lineage(drawn.groupBy(*NODE).applyInPandas(_medians(offset), "label int, tree int, node long, depths int, cuts array<double>"))
        below = F.reduce(
            F.sequence(F.lit(0), F.col("depths") - 1), F.lit(1),
            lambda at, d: at * 2 + (F.get("path", d + offset) > F.get("cuts", at - 1)).cast("int"),
        )
        routed = _send(placed, cuts, count, "left")
        # a node's number holds the way to it: a stage adds a heap place below 2^STAGE+1
        node = F.when(F.col("cuts").isNull(), F.col("node")).otherwise(F.col("node") * (2 << STAGE) + below)
        placed = cut_lineage(routed.select("id", "label", "tree", "path", node.alias("node")))
    full = placed.groupBy(*NODE).agg(F.ceil(F.count("*") / leaf_rows).cast("int").alias("blocks")).where("blocks > 2")
    full = cut_lineage(full)
    dealt = F.pmod(F.xxhash64("id", "tree", F.lit(seed)), F.coalesce("blocks", F.lit(1))).cast("int")
    found = _send(placed, full, full.count(), "left").select("id", "label", "tree", "node", dealt.alias("block"))
    spread = max(leaf_rows, 64)
    counts = rows.groupBy("label").agg(F.greatest(F.floor(F.count("*") / spread), F.lit(1)).alias("blocks"))
    mixed = rows.join(F.broadcast(counts), "label").select(
        "id", "label", F.lit(trees).alias("tree"), F.lit(0).cast("long").alias("node"), F.pmod(F.xxhash64("id", F.lit(~seed)), F.col("blocks")).cast("int").alias("block"))
    return found.unionByName(mixed)


def _nearest(k: int):
    """The ``k`` nearest other rows of a leaf for each of its rows."""

    def search(leaf: pa.Table) -> pa.Table:
        ids = leaf["id"].to_numpy()
        x = leaf["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        kept = min(k, len(ids) - 1)
        if kept < 1:
            return pa.table({"id": pa.array([], pa.int64()), "neighbour": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        square = (x * x).sum(axis=1)
        near = square[:, None] + square[None, :] - 2 * (x @ x.T)
        np.fill_diagonal(near, np.inf)
        pick = np.argpartition(near, kept - 1, axis=1)[:, :kept]
        # the same pair has the same distance in every leaf, to the last bit
        gap = x[np.repeat(np.arange(len(x)), kept)] - x[pick.ravel()]
        return pa.table({"id": np.repeat(ids, kept), "neighbour": ids[pick.ravel()], "distance": np.sqrt((gap * gap).sum(axis=1))})

    return search


def nearest(df: DataFrame, k: int = 5, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 42) -> DataFrame:
    """The nearest rows of the same class that the forest finds: ``id, label, rank, neighbour, distance``.

    Input: ``id, label int, features array<double>`` of one length. Ids must be unique and not null. Ties go to the
    smaller id. A class of one row has no neighbours.
    """
    rows = df.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), F.col("features").cast("array<double>").alias("features"))
    placed = leaves(rows, trees, leaf_rows, seed)
    blocks = placed.join(rows.select("id", "features"), "id").groupBy(*LEAF)
    pairs = blocks.applyInArrow(_nearest(k), "id long, neighbour long, distance double")
    # at most (trees + 1) * k candidates a row
    best = pairs.groupBy("id").agg(F.slice(F.array_sort(F.collect_set(F.struct("distance", "neighbour"))), 1, k).alias("best"))
    ranked = best.select("id", F.posexplode("best").alias("place", "b"))
    return ranked.join(rows.select("id", "label"), "id").select(
        "id", "label", (F.col("place") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), F.col("b.distance").alias("distance"))
