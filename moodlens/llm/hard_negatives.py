"""Hard negatives for training pairs, by a secondary-sort shuffle.

An anchor's positives are its best rows of the same label. The negatives of a positive are the best rows of another
label whose score lies in the positive's window, from ``LOW`` to 100 percent of its score. Scores are inner products
of the scaled and floored components, as whole numbers; higher ones come first, ties by the smaller id.

Pairs of an anchor and a row are packed into one key of (anchor, falling score, positives first, id) and go through
``repartitionAndSortWithinPartitions``. The iterator over a sorted partition opens a window at each positive and gives
out negatives as they come by; it holds the open windows of one anchor and nothing else.

Anchors meet all rows in blocks of bounded bytes: a pair of blocks is one matrix product. Before the shuffle each pair
of blocks keeps only pairs that can be in the result: first the best positives of each anchor; then, when these are
known over all rows, the best negatives of each window. The best of all rows are among the best of their blocks, so
nothing is lost, and an anchor never gets more than a bounded number of pairs from a block.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Of rows with one id, equal
or not, the one with the smallest label, then vector, counts. Vectors of different lengths do not meet. Further columns
are ignored. Tables without anchors, or without rows, give no rows. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlens.llm.common import stored

POSITIVES = NEGATIVES = 5
#: Percent of the positive's score that a negative has at least.
LOW = 80
SCALE = 256
#: Every row whose id is divisible by this is an anchor.
EVERY = 100
#: Bytes of the components of a block, at eight each, and scores that are computed at once.
BLOCK_BYTES = 8 << 20
STRIP = 2 << 20
#: Scores below this are exact in double precision, with room for the percentages.
EXACT = float(1 << 45)

BLOCK = "block int, size int, kind string, ids binary, labels binary, vectors binary, limits binary"
PAIRS = "anchor_id bigint, other_id bigint, score bigint, negative boolean"
FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
KEY = ">QQ?Q"
ZERO = 1 << 63


def clean(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(vec_id, label, vector)``: the rows that take part, one for each id."""
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = rows.where(usable & ~bad).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).alias("vector"))
    return found.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")


def _pack(scale: int):
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        size = key[1].as_py()
        values = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        whole = np.floor(values * scale)
        most = float(np.abs(whole).max(initial=0))
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
        ids, labels = (rows[c].to_numpy().astype("<i8") for c in ("vec_id", "label"))
        limits = np.array([[*x, *[-1] * (POSITIVES - len(x))] for x in rows["limits"].to_pylist()], "<i8")
        row = [key[0].as_py(), size, kind, *(x.tobytes() for x in (ids, labels, whole.astype(kind), limits))]
        return pa.table({n: [v] for n, v in zip([c.split()[0] for c in BLOCK.split(", ")], row)}, schema=_arrow(BLOCK))

    return pack


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def blocks(rows: DataFrame, count: int, scale: int = SCALE) -> DataFrame:
    """The rows packed in ``count`` blocks by the hash of the id; ``limits`` holds the scores of their positives."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    return rows.withColumns({"block": block, "size": F.size("vector")}).groupBy("block", "size").applyInArrow(_pack(scale), BLOCK)


class _Block:
    def __init__(self, table: pa.Table) -> None:
        row = {c: table[c][0].as_py() for c in ("size", "kind", "ids", "labels", "vectors", "limits")}
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(len(self.ids), row["size"]).astype(np.float64)
        self.limits = np.frombuffer(row["limits"], "<i8").reshape(len(self.ids), POSITIVES)
        self.most = float(np.abs(self.vectors).max(initial=0))


def _strips(anchors: _Block, rows: _Block) -> Iterator[tuple[slice, np.ndarray]]:
    """The exact scores of some anchors with all rows, strip by strip."""
    a, b = anchors.vectors, rows.vectors
    if anchors.most * rows.most * max(a.shape[1], 1) >= EXACT:
        a, b = (np.array([[int(x) for x in v] for v in m], object).reshape(m.shape) for m in (a, b))
    step = max(STRIP // max(len(b), 1), 1)
    for k in range(0, len(a), step):
        yield slice(k, k + step), a[k : k + step] @ b.T


def _best(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (anchor, row) of the ``most`` best allowed scores of each anchor, ties by the earlier row."""
    live = np.flatnonzero(allowed.any(axis=1))
    scores, allowed = scores[live], allowed[live]
    if scores.shape[1] > most:
        shown = np.where(allowed, scores, -np.inf)
        least = -np.partition(-shown, most - 1, axis=1)[:, most - 1 : most]
        allowed = allowed & (shown >= least)
    a, r = np.nonzero(allowed)
    order = np.lexsort((r, -scores[a, r], a))
    a, r = a[order], r[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return live[a[rank < most]], r[rank < most]


def _pairs(parts: list[tuple], negative: bool) -> pa.Table:
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    # whole numbers beyond 64 bits are refused here
    arrays = [pa.array([int(v) for v in x] if x.dtype == object else x.astype(np.int64), pa.int64()) for x in columns]
    return pa.Table.from_arrays([*arrays, pa.array(np.full(len(columns[0]), negative))], schema=_arrow(PAIRS))


def _positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    out = []
    if len(rows) and len(anchors):
        row, anchor = _Block(rows), _Block(anchors)
        for at, scores in _strips(anchor, row):
            allowed = (anchor.labels[at, None] == row.labels) & (anchor.ids[at, None] != row.ids)
            a, r = _best(scores, allowed, POSITIVES)
            out.append((anchor.ids[at][a], row.ids[r], scores[a, r]))
    return _pairs(out, False)


def _negatives(low: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(anchors):
            row, anchor = _Block(rows), _Block(anchors)
            for at, scores in _strips(anchor, row):
                other = anchor.labels[at, None] != row.labels
                found = []
                for top in anchor.limits[at].T:
                    top = top.astype(scores.dtype)[:, None]
                    a, r = _best(scores, other & (scores <= top) & (100 * scores >= low * top) & (top >= 0), NEGATIVES)
                    found.append(a * len(row.ids) + r)
                a, r = np.divmod(np.unique(np.concatenate(found)), len(row.ids))
                out.append((anchor.ids[at][a], row.ids[r], scores[a, r]))
        return _pairs(out, True)

    return find


def _met(rows: DataFrame, n_rows: int, anchors: DataFrame, n_anchors: int, find) -> DataFrame:
    """``find`` applied to every block of anchors with every block of rows."""
    left = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))
    right = anchors.withColumnRenamed("block", "other").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    keys = ["block", "other", "size"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, PAIRS)


def _key(row: tuple) -> tuple[bytes, None]:
    anchor, other, score, negative = row
    return struct.pack(KEY, anchor + ZERO, ZERO - 1 - score, negative, other + ZERO), None


def _anchor_of(key: bytes) -> int:
    return hash(struct.unpack(KEY, key)[0])


def _emit(low: int):
    def stream(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        now, windows = None, []
        for key, _ in keys:
            anchor, score, negative, other = struct.unpack(KEY, key)
            anchor, score, other = anchor - ZERO, ZERO - 1 - score, other - ZERO
            if anchor != now:
                now, windows = anchor, []
            if not negative:
                if len(windows) < POSITIVES:
                    windows.append([other, score, 0])
                continue
            for window in windows:
                # keys fall, so no negative comes before a positive that it exceeds
                if window[2] < NEGATIVES and low * window[1] <= 100 * score:
                    window[2] += 1
                    yield anchor, window[0], window[2], other, window[1], score

    return stream


def mine(rows: DataFrame, vector: str = "embedding", every: int = EVERY, low: int = LOW, scale: int = SCALE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, ranks from 1 in each window."""
    spark = rows.sparkSession
    rows = clean(rows, vector).withColumn("limits", F.array().cast("array<bigint>"))
    rows = stored(rows, "vectors")
    anchor = F.col("vec_id") % every == 0
    size = 8 * F.size("vector")
    total, chosen = rows.agg(F.sum(size), F.sum(F.when(anchor, size))).first()
    n_rows, n_anchors = ((x or 0) // block_bytes + 1 for x in (total, chosen))
    packed = stored(blocks(rows, n_rows, scale), "blocks")
    anchors = rows.where(anchor)

    best = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id"))
    positives = _met(packed, n_rows, blocks(anchors, n_anchors, scale), n_anchors, _positives)
    positives = stored(positives.withColumn("place", best).where(F.col("place") <= POSITIVES).drop("place"), "positives")
    limits = positives.groupBy("anchor_id").agg(F.collect_list("score").alias("limits"))
    limited = anchors.drop("limits").join(limits, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    negatives = _met(packed, n_rows, blocks(limited, n_anchors, scale), n_anchors, _negatives(low))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = positives.unionByName(negatives).rdd.map(_key)
    found = keys.repartitionAndSortWithinPartitions(parts, _anchor_of).mapPartitions(_emit(low))
    return spark.createDataFrame(found, FOUND, verifySchema=False)
