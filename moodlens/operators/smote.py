"""Synthetic minority oversampling, with neighbours from a projection forest or, on request, exact ones.

The forest of ``neighbours`` compares each row with a bounded number of others, so its work is linear in the rows.

Exact neighbours are found without comparing all pairs where vectors cluster. Every class is cut into cells around pivot rows and
large cells into blocks, so no task holds more than a block however uneven the data. A row first looks
in its own block; the distance found there bounds which other blocks can hold a closer row (triangle
inequality and bisecting hyperplane), and only those are visited. Where vectors do not cluster, all blocks are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlens.operators import neighbours, ranking
from moodlens.session import cut_lineage

BLOCK_ROWS = 2048
PIVOTS = 64


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by one matrix product. Rounding can push a square below zero."""
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype("float64")


def _smallest(dist: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    k = min(k, dist.shape[1])
    pick = np.argpartition(dist, k - 1, axis=1)[:, :k]
    return np.take_along_axis(dist, pick, 1), ids[pick]


def _pivots(rows: DataFrame, n: int, seed: int) -> dict[int, np.ndarray]:
    """At most n rows per class, by hash order: a bounded table that every task gets."""
    cut = ranking.hash_cutoffs(rows.select("id", "label"), ["label"], lambda total: F.least(total, F.lit(n)), "id", seed)
    chosen = rows.join(F.broadcast(cut.select("label", "cutoff")), "label").filter(
        ranking.hash_key("id", seed) <= F.col("cutoff"))
    found: dict[int, list] = {}
    for r in chosen.select("label", "features").collect():
        found.setdefault(r["label"], []).append(r["features"])
    return {label: np.unique(np.asarray(v, dtype="float64"), axis=0) for label, v in found.items()}


def _assign(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    def run(batches):
        for pdf in batches:
            for label, g in pdf.groupby("label"):
                d = _distances(_matrix(g["features"]), pivots[label])
                cell = d.argmin(1)
                yield g.assign(cell=cell.astype("int32"), dist=d[np.arange(len(g)), cell])

    return rows.mapInPandas(run, "id long, label int, features array<double>, cell int, dist double")


def nearest_same_class(df: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, n_pivots: int = PIVOTS, seed: int = 42) -> DataFrame:
    """The k nearest other rows of the same class: ``id, label, rank, neighbour, distance``.

    Input: ``id long, label int, features array<double>``.
    """
    rows = df.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), "features")
    pivots = _pivots(rows, n_pivots, seed)
    placed = cut_lineage(_assign(rows, pivots))
    # at most n_pivots rows per class
    stats = placed.groupBy("label", "cell").agg(
        F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"),
    ).withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    cells = {(r["label"], r["cell"]): (r["lo"], r["hi"]) for r in stats.collect()}
    blocked = placed.join(F.broadcast(stats.select("label", "cell", "blocks")), ["label", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def own_block(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = _matrix(pdf["features"]), pdf["id"].to_numpy()
        d = _distances(x, x)
        np.fill_diagonal(d, np.inf)
        if len(ids) == 1:
            near, who = np.empty((1, 0)), np.empty((1, 0), dtype="int64")
        else:
            near, who = _smallest(d, ids, min(k, len(ids) - 1))
        bound = near.max(1) if near.shape[1] == k else np.full(len(ids), np.inf)
        return pd.DataFrame({
            "id": ids, "label": pdf["label"].to_numpy(), "features": list(x), "cell": pdf["cell"].to_numpy(),
            "block": pdf["block"].to_numpy(), "bound": bound, "near": list(near), "who": list(who),
        })

    first = cut_lineage(blocked.groupBy("label", "cell", "block").applyInPandas(
        own_block,
        "id long, label int, features array<double>, cell int, block int, bound double, near array<double>, who array<long>",
    ))

    def route(batches):
        for pdf in batches:
            for label, g in pdf.groupby("label"):
                p = pivots[label]
                d, own, bound = _distances(_matrix(g["features"]), p), g["cell"].to_numpy(), g["bound"].to_numpy()
                lo = np.array([cells.get((label, c), (np.inf, -np.inf))[0] for c in range(len(p))])
                hi = np.array([cells.get((label, c), (np.inf, -np.inf))[1] for c in range(len(p))])
                apart = _distances(p, p)[own]
                mine = d[np.arange(len(g)), own][:, None]
                plane = np.divide(d * d - mine * mine, 2 * apart, out=np.zeros_like(d), where=apart > 0)
                least = np.maximum.reduce([d - hi, lo - d, plane, np.zeros_like(d)])
                # a hair of slack, so that rounding never hides a neighbour; empty cells have no rows
                open_ = (least * (1 - 1e-9) - 1e-9 < bound[:, None]) & np.isfinite(lo)[None, :]
                # a bound of zero means k copies are known already: nothing can be closer
                open_ &= (bound > 0)[:, None]
                yield pd.DataFrame({"id": g["id"].to_numpy(), "label": label, "features": g["features"].to_numpy(),
                                    "bound": bound, "own_cell": own, "own_block": g["block"].to_numpy(),
                                    "targets": [np.flatnonzero(o).astype("int32") for o in open_]})

    asked = first.select("id", "label", "features", "cell", "block", "bound").mapInPandas(
        route,
        "id long, label int, features array<double>, bound double, own_cell int, own_block int, targets array<int>",
    ).withColumn("cell", F.explode_outer("targets")).filter(F.col("cell").isNotNull()).drop("targets")
    asked = asked.join(F.broadcast(stats.select("label", "cell", "blocks")), ["label", "cell"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = asked.filter((F.col("cell") != F.col("own_cell")) | (F.col("block") != F.col("own_block")))
    key = ["label", "cell", "block"]
    # a popular block is asked by many rows: its questions are cut into chunks and the block is repeated per chunk
    load = asked.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("chunks"))
    queries = asked.join(load, key).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    data = first.select("id", "label", "features", "cell", "block").join(load, key).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def other_block(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if q.empty or b.empty:
            return pd.DataFrame({"id": [], "label": [], "neighbour": [], "distance": []})
        d = _distances(_matrix(q["features"]), _matrix(b["features"]))
        near, who = _smallest(d, b["id"].to_numpy(), k)
        keep = near <= q["bound"].to_numpy()[:, None]
        at = np.nonzero(keep)
        return pd.DataFrame({"id": q["id"].to_numpy()[at[0]], "label": q["label"].to_numpy()[at[0]],
                             "neighbour": who[at], "distance": near[at]})

    chunk_key = [*key, "chunk"]
    data = data.toDF(*data.columns)  # fresh column identities: both sides descend from the same tables
    found = queries.groupBy(*chunk_key).cogroup(data.groupBy(*chunk_key)).applyInPandas(
        other_block, "id long, label int, neighbour long, distance double")
    pairs = first.select("id", "label", F.explode_outer(F.arrays_zip("who", "near")).alias("z")).filter(F.col("z").isNotNull())
    pairs = pairs.select("id", "label", F.col("z.who").alias("neighbour"), F.col("z.near").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    return pairs.unionByName(found).withColumn("rank", rank).filter(F.col("rank") <= k)


def _unit(seed: int, purpose: str):
    """Uniform number in [0, 1) from a hash, the same one when a task is retried."""
    key = F.concat_ws(":", F.col("label").cast("string"), F.col("j").cast("string"), F.lit(f"{purpose}:{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def smote(df: DataFrame, k: int = 5, seed: int = 42, block_rows: int = BLOCK_ROWS, exact: bool = False) -> DataFrame:
    """Raise every class to the size of the largest one: ``id, label, features, synthetic``.

    Each synthetic row lies between a random row of the class and one of its k nearest neighbours there, as found by
    the projection forest with leaves of ``block_rows`` rows, or exactly with ``exact``. Its ``id`` is null; ``base`` and
    ``neighbour`` name the two rows it comes from. Ids must be unique; null ids are an error.
    """
    rows = df.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), "features")
    found = rows.groupBy("label").agg(F.count("*").alias("n"), F.count("id").alias("named")).collect()  # one row per class
    counts = {r["label"]: r["n"] for r in found}
    if not counts:
        raise ValueError("no rows to rebalance")
    if any(r["named"] < r["n"] for r in found):
        raise ValueError("rows without an id cannot be rebalanced")
    largest = max(counts.values())
    need = {label: largest - n for label, n in counts.items() if n < largest}
    small = [label for label in need if counts[label] <= k]
    if small:
        raise ValueError(f"classes {sorted(small)} have no more than {k} rows, too few for {k} neighbours")
    real = rows.select("id", "label", "features", F.lit(False).alias("synthetic"),
                       F.lit(None).cast("long").alias("base"), F.lit(None).cast("long").alias("neighbour"))
    if not need:
        return real
    spark = df.sparkSession
    minority = cut_lineage(rows.filter(F.col("label").isin(*need)))
    search = nearest_same_class(minority, k, block_rows, seed=seed) if exact else neighbours.nearest(minority, k, leaf_rows=block_rows, seed=seed)
    in_order = F.array_sort(F.collect_list(F.struct("rank", "neighbour")))
    near = cut_lineage(search.groupBy("id").agg(F.transform(in_order, lambda x: x["neighbour"]).alias("near")))
    ranked = ranking.hash_rank(minority.select("id", "label"), ["label"], "id", seed)
    wanted = None
    for label, n in need.items():  # one entry per class
        part = spark.range(n).select(
            F.lit(label).alias("label"), F.col("id").alias("j"), F.lit(counts[label]).cast("long").alias("size"))
        wanted = part if wanted is None else wanted.unionByName(part)
    wanted = wanted.select(
        "label", "j", (F.floor(_unit(seed, "base") * F.col("size")) + 1).cast("long").alias("class_rank"),
        _unit(seed, "neighbour").alias("choice"), _unit(seed, "gap").alias("gap"),
    )
    feats = minority.select("id", "features")
    chosen = F.get("near", F.floor(F.col("choice") * F.size("near")).cast("int"))
    base = wanted.join(ranked, ["label", "class_rank"]).join(near, "id").withColumn("neighbour", chosen).drop("near", "choice")
    base = base.join(feats, "id").withColumnRenamed("id", "base").withColumnRenamed("features", "x")
    other = feats.select(F.col("id").alias("neighbour"), F.col("features").alias("y"))
    made = base.join(other, "neighbour").select(
        F.lit(None).cast("long").alias("id"), "label",
        F.zip_with("x", F.zip_with("y", F.array_repeat("gap", F.size("y")), lambda y, u: F.struct(y.alias("y"), u.alias("u"))),
                   lambda x, p: x + p["u"] * (p["y"] - x)).alias("features"),
        F.lit(True).alias("synthetic"), "base", "neighbour",
    )
    return real.unionByName(made)

