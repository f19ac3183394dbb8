"""Gradient boosting of all classes together: one softmax over the classes, second-order leaves with an L2 penalty.

Features are cut into at most ``bins`` quantile bins once, and the rows are packed into blocks of bin codes that are
written to the shared folder. A round grows one tree per class. Every level of these trees is one aggregate: tasks
sum gradients and hessians per (class, node, feature, bin) over their blocks, the sums meet per (class, node), and
there the best cut is chosen; only the cuts, one row per node, come to the driver. So what is shuffled depends on the
number of tasks and the size of the trees, never on the rows.

Blocks carry the margins of their rows. Trees that are newer than the margins are applied on the fly; every
``REFRESH`` rounds the blocks are rewritten with fresh margins and the old ones are dropped, so a lost executor costs
some tasks, not the run.

Held-out rows take no part in the sums. Their log loss is summed in the pass that starts the next round, so the
number of rounds is found while fitting: it stops ``patience`` rounds after the least loss and keeps the trees up
to it.

Rows and features are sampled by hashes of row, round and class, so a repeated task draws the same ones. Null
labels or features are an error of the input; a feature with one value is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from moodlens.operators import evaluation
from moodlens.session import drop_path, scratch_path

#: Rows of a block; rounds after which margins are written anew; tasks whose sums are added up first.
BLOCK_ROWS = 16_384
REFRESH = 10
GROUP = 32
BLOCK = "rows int, codes binary, labels binary, weights binary, held binary, draws binary, margins binary"
SUMS = "class int, node int, part int, sums binary"
CUTS = "class int, node int, feature int, code int, gain double, left_g double, left_h double, g double, h double"


@dataclass(frozen=True)
class BoostOptions:
    """Rounds, shrinkage, sampling and penalties of the boosting.

    With validation rows the rounds up to the least validation loss are kept, if ``patience`` rounds without a gain of
    more than ``tolerance`` follow.
    """

    rounds: int = 600
    step: float = 0.1
    max_depth: int = 6
    row_share: float = 0.8
    feature_share: float = 0.8
    seed: int = 42
    tolerance: float = 0.0
    patience: int = 30
    l2: float = 1.0
    min_child: float = 1.0
    bins: int = 64


@dataclass
class Tree:
    """A binary tree as a heap: the children of node i are 2i + 1 and 2i + 2. ``feature`` is -1 at leaves.

    ``code`` is the last bin that goes left, ``cut`` its upper edge.
    """

    depth: int
    feature: np.ndarray
    code: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (2 << depth) - 1
        return Tree(depth, np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.zeros(n))

    def nodes(self, x: np.ndarray, by_code: bool, levels: int) -> np.ndarray:
        """The node that each row has reached after so many levels."""
        at, every = np.zeros(len(x), np.int64), np.arange(len(x))
        bound = self.code if by_code else self.cut
        for _ in range(levels):
            feature = self.feature[at]
            live = feature >= 0
            if not live.any():
                break
            right = x[every, np.maximum(feature, 0)] > bound[at]
            at = np.where(live, 2 * at + 1 + right, at)
        return at


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Boosting:
    """Rounds of one tree per class; ``losses`` holds the validation log loss after each round that was fitted."""

    classes: int
    features: int
    step: float
    trees: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def margins(self, x: np.ndarray, by_code: bool = False) -> np.ndarray:
        out = np.zeros((len(x), self.classes))
        for group in self.trees:
            for c, tree in enumerate(group):
                out[:, c] += tree.value[tree.nodes(x, by_code, tree.depth)]
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability``, ``prediction`` and ``confidence``."""

        @F.pandas_udf(ArrayType(DoubleType()))
        def probability(features: pd.Series) -> pd.Series:
            return pd.Series(list(softmax(self.margins(np.stack(features.to_numpy())))) if len(features) else [])

        return evaluation.with_prediction(df.withColumn("probability", probability("features")))

    def importances(self) -> list[float]:
        """The mean gain of the cuts on each feature, scaled to sum to one."""
        total, count = np.zeros(self.features), np.zeros(self.features)
        for tree in (t for group in self.trees for t in group):
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(count, tree.feature[inner], 1)
        mean = total / np.maximum(count, 1)
        return [float(v) for v in (mean / mean.sum() if mean.sum() > 0 else mean)]

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        rows = [
            (r, c, t.depth, *(x.tolist() for x in (t.feature, t.code, t.cut, t.value, t.gain)))
            for r, group in enumerate(self.trees) for c, t in enumerate(group)
        ]
        kinds = "round int, class int, depth int, feature array<int>, code array<int>, cut array<double>, value array<double>, gain array<double>"
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        head = [(self.classes, self.features, self.step, self.losses)]
        spark.createDataFrame(head, "classes int, features int, step double, losses array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @staticmethod
    def load(path: str) -> Boosting:
        spark = SparkSession.getActiveSession()
        h = spark.read.parquet(f"{path}/head").first()
        out = Boosting(h["classes"], h["features"], h["step"], losses=list(h["losses"]))
        for r in spark.read.parquet(f"{path}/trees").orderBy("round", "class").collect():  # rounds x classes rows
            if r["class"] == 0:
                out.trees.append([])
            out.trees[-1].append(Tree(r["depth"], np.array(r["feature"], np.int32), np.array(r["code"], np.int32), *(np.array(r[c]) for c in ("cut", "value", "gain"))))
        return out


def bin_edges(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Upper edges of all but the last quantile bin of every feature, in one pass; a bounded row to the driver."""
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.get("features", F.lit(i)), shares, 50 * bins).alias(f"f{i}") for i in range(features)]).first()
    return [np.unique(np.array(found[f"f{i}"], np.float64)) for i in range(features)]


def _pack(edges: list[np.ndarray], classes: int):
    """Rows as blocks of bin codes with zero margins."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for k in range(0, len(whole), BLOCK_ROWS):
                part = whole.slice(k, BLOCK_ROWS)
                x = part.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(part), len(edges))
                codes = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.uint8)
                labels = part.column("label").to_numpy().astype(np.int32)
                weights = part.column("weight").to_numpy().astype(np.float64)
                held = part.column("held").to_numpy(zero_copy_only=False).astype(np.uint8)
                draws = part.column("draw").to_numpy().astype(np.int64)
                margins = np.zeros((len(part), classes))
                yield _block(codes, labels, weights, held, draws, margins)

    return pack


def _block(*arrays: np.ndarray) -> pa.RecordBatch:
    names = [c.split()[0] for c in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([len(arrays[0])], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], names=names)


def _unpacked(parts: Iterator[pa.RecordBatch], features: int, classes: int) -> Iterator[list[np.ndarray]]:
    kinds = (np.uint8, np.int32, np.float64, np.uint8, np.int64, np.float64)
    for part in parts:
        for row in part.to_pylist():
            arrays = [np.frombuffer(v, k) for v, k in zip(list(row.values())[1:], kinds, strict=True)]
            arrays[0], arrays[5] = arrays[0].reshape(-1, features), arrays[5].reshape(-1, classes)
            yield arrays


def _chosen(draws: np.ndarray, number: int, share: float, seed: int) -> np.ndarray:
    """The rows that a round draws, by a hash of row and round."""
    x = draws.astype(np.uint64) + np.uint64((number * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(share * 2.0**64), 2**64 - 1))


def _columns(features: int, number: int, c: int, o: BoostOptions) -> np.ndarray:
    """The features that a tree may cut."""
    kept = max(1, round(features * o.feature_share))
    return np.sort(np.random.default_rng([o.seed, number, c]).permutation(features)[:kept])


def _newest(model: Boosting, since: int) -> Boosting:
    """The rounds that the margins do not hold yet."""
    return Boosting(model.classes, model.features, model.step, model.trees[since:])


def _level_sums(newest: Boosting, number: int, growing: list[Tree], level: int, o: BoostOptions, features: int, lossy: bool):
    """Sums of a task's blocks for the open nodes of one level, and the held-out loss when a round starts."""
    classes, bins = newest.classes, o.bins

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << level
        columns = [_columns(features, number, c, o) for c in range(classes)]
        sums = [np.zeros((2, size * len(k) * bins)) for k in columns]
        loss = np.zeros(2)
        for codes, labels, weights, held, draws, margins in _unpacked(parts, features, classes):
            p = softmax(margins + newest.margins(codes, True))
            out = held.astype(bool)
            if lossy and out.any():
                loss += [-np.log(np.maximum(p[out, labels[out]], 1e-15)).sum(), out.sum()]
            rows = np.flatnonzero(~out & _chosen(draws, number, o.row_share, o.seed))
            for c, tree in enumerate(growing):
                place = tree.nodes(codes[rows], True, level) - (size - 1)
                # rows that stopped at a leaf above are below the level's first node
                open_ = rows[place >= 0]
                place = place[place >= 0]
                g = weights[open_] * (p[open_, c] - (labels[open_] == c))
                h = weights[open_] * np.maximum(2 * p[open_, c] * (1 - p[open_, c]), 1e-16)
                kept = len(columns[c])
                key = ((place[:, None] * kept + np.arange(kept)) * bins + codes[open_][:, columns[c]]).ravel()
                for k, v in enumerate((g, h)):
                    sums[c][k] += np.bincount(key, np.repeat(v, kept), size * kept * bins)
        part = TaskContext.get().partitionId()
        found = [(-1, 0, part, loss.tobytes())] if lossy else []
        for c, kept in enumerate(columns):
            shaped = sums[c].reshape(2, size, len(kept), bins)
            found += [(c, node, part, np.ascontiguousarray(shaped[:, node]).tobytes()) for node in range(size) if shaped[1, node].any()]
        columns_ = list(zip(*found)) if found else [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns_, kinds)], names=["class", "node", "part", "sums"])

    return run


def _added(part: pa.Table) -> np.ndarray:
    return np.sum([np.frombuffer(x, np.float64) for x in part["sums"].to_pylist()], axis=0)


def _add(part: pa.Table) -> pa.Table:
    return part.slice(0, 1).drop_columns(["sums"]).append_column("sums", pa.array([_added(part.sort_by("part")).tobytes()], pa.binary()))


def _best_cut(number: int, o: BoostOptions, features: int, bins: int):
    """The cut of a node with the largest gain, ties by the smaller feature, then bin."""

    def choose(key: tuple, part: pa.Table) -> pa.Table:
        c, node = key[0].as_py(), key[1].as_py()
        total = _added(part.sort_by("part"))
        row = [c, node, -1, 0, 0.0, 0.0, 0.0, *total[:2]]
        if c >= 0:
            kept = _columns(features, number, c, o)
            g, h = total.reshape(2, len(kept), bins)
            sum_g, sum_h = g[0].sum(), h[0].sum()
            left_g, left_h = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
            right_g, right_h = sum_g - left_g, sum_h - left_h
            with np.errstate(all="ignore"):
                gain = left_g**2 / (left_h + o.l2) + right_g**2 / (right_h + o.l2) - sum_g**2 / (sum_h + o.l2)
            gain[(left_h < o.min_child) | (right_h < o.min_child) | (np.minimum(left_h, right_h) <= 0)] = -np.inf
            at = int(gain.argmax()) if gain.size else 0
            row[7:] = [sum_g, sum_h]
            if gain.size and gain.flat[at] > 1e-12:
                f, b = divmod(at, bins - 1)
                row[2:7] = [int(kept[f]), b, float(gain.flat[at]) / 2, left_g[f, b], left_h[f, b]]
        names = [x.split()[0] for x in CUTS.split(", ")]
        kinds = [pa.int32()] * 4 + [pa.float64()] * 5
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    return choose


def _refresh(newest: Boosting, features: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrays in _unpacked(parts, features, newest.classes):
            yield _block(*arrays[:5], arrays[5] + newest.margins(arrays[0], True))

    return run


def _grow(tree: Tree, level: int, cuts: list, edges: list[np.ndarray], o: BoostOptions) -> None:
    """Open the nodes of one level that were cut; the others and all children get their leaf values."""
    first = (1 << level) - 1
    for r in cuts:
        at = first + r["node"]
        if r["feature"] < 0:
            tree.value[at] = -o.step * r["g"] / (r["h"] + o.l2)
            continue
        tree.feature[at], tree.code[at], tree.gain[at] = r["feature"], r["code"], r["gain"]
        tree.cut[at] = edges[r["feature"]][r["code"]]
        for child, g, h in ((2 * at + 1, r["left_g"], r["left_h"]), (2 * at + 2, r["g"] - r["left_g"], r["h"] - r["left_h"])):
            tree.value[child] = -o.step * g / (h + o.l2)


def best_round(losses: list[float], patience: int, tolerance: float = 0.0) -> int:
    """The number of rounds to keep: up to the least loss, looking ``patience`` rounds ahead of the best so far."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best] - tolerance:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def fit_boosting(
    train: DataFrame, n_classes: int, options: BoostOptions = BoostOptions(), weight: str | None = None, validation: str | None = None,
) -> Boosting:
    """Fit on rows with ``label`` (0 to ``n_classes`` - 1) and ``features``, both not null.

    ``validation`` names a boolean column; its rows choose the number of rounds instead of being fitted.
    """
    o, spark = options, train.sparkSession
    if not 2 <= o.bins <= 256:
        raise ValueError("bins must be from 2 to 256")
    id_ = F.coalesce(F.col("review_id").cast("string"), F.lit("")) if "review_id" in train.columns else F.lit("")
    rows = train.select(
        F.col("label").cast("int").alias("label"), F.col("features").cast("array<double>").alias("features"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        (F.col(validation) if validation else F.lit(False)).alias("held"),
        F.xxhash64(id_, "features").alias("draw"),  # oversampled rows have no id
    )
    head = rows.select(F.size("features").alias("n")).first()
    if head is None or n_classes < 2:
        raise ValueError("boosting needs rows of two classes or more")
    features = head["n"]
    edges = bin_edges(rows.where(~F.col("held")), features, o.bins)
    model, since, path = Boosting(n_classes, features, o.step), 0, scratch_path(spark, "boosting")
    rows.mapInArrow(_pack(edges, n_classes), BLOCK).write.parquet(path)
    blocks = spark.read.schema(BLOCK).parquet(path)

    def sums(growing: list[Tree], level: int, lossy: bool) -> list:
        found = blocks.mapInArrow(_level_sums(_newest(model, since), model.rounds, growing, level, o, features, lossy), SUMS)
        if blocks.rdd.getNumPartitions() > GROUP:  # two steps, so that no task gets the sums of all others
            grouped = found.withColumn("part", F.floor(F.col("part") / GROUP).cast("int"))
            found = grouped.groupBy("class", "node", "part").applyInArrow(_add, SUMS)
        return found.groupBy("class", "node").applyInArrow(_best_cut(model.rounds, o, features, o.bins), CUTS).collect()

    def finished() -> bool:
        late = bool(model.losses) and len(model.losses) - best_round(model.losses, o.patience, o.tolerance) >= o.patience
        return late or model.rounds == o.rounds

    while validation or model.rounds < o.rounds:
        growing = [Tree.empty(o.max_depth) for _ in range(n_classes)]
        found = sums(growing, 0, bool(validation) and model.rounds > 0)
        model.losses += [r["g"] / r["h"] for r in found if r["class"] < 0 and r["h"] > 0]
        if finished():
            break
        for level in range(o.max_depth):
            found = found if level == 0 else sums(growing, level, False)
            for c, tree in enumerate(growing):
                _grow(tree, level, [r for r in found if r["class"] == c], edges, o)
            if not any((t.feature[(1 << level) - 1 : (2 << level) - 1] >= 0).any() for t in growing):
                break
        model.trees.append(growing)
        if model.rounds - since == REFRESH:
            fresh = scratch_path(spark, "boosting")
            blocks.mapInArrow(_refresh(_newest(model, since), features), BLOCK).write.parquet(fresh)
            drop_path(spark, path)
            path, since = fresh, model.rounds
            blocks = spark.read.schema(BLOCK).parquet(path)
    drop_path(spark, path)
    if model.losses:
        del model.trees[best_round(model.losses, o.patience, o.tolerance) :]
    return model
