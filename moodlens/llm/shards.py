"""Sharding by a k-d tree over document metadata, with leaves of near equal bytes (law ``bytes``).

A node is split along its widest dimension, relative to the dimension's range over all documents, at the weighted
median of its bytes; a node of k leaves gives k // 2 to the left. All nodes of a level are split together. A median
is found by histograms: each round sums bytes in at most ``BINS`` bins per node, and only the bin that the median
falls in is looked into again, so the driver sees bounded sums and no rows.

Metadata are size, share of multi-byte characters, language and source, each as a number from 0 to 4095. Rows with
the same text take language and source of the one with the smallest id: they stand at one point, next to each
other in the order (dimension, text hash, id), and only a group with more than ``TOLERANCE`` of a leaf's bytes is
cut between its ids. Copies are so kept together as far as the law allows, and a group that holds a third of all
rows is shared out.

Slots number the rows of a shard by id, text hash; they come from one range sort and the counts of its partitions.
Null texts have no bytes, null ids sort before all others, null languages and sources count as empty. Repeated rows
each get a slot. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlens.llm.common import stored, whole

BINS = 4096
DIMENSIONS = 4
#: Share of a leaf's bytes that a cut may miss the median by.
TOLERANCE = 0.005
#: Rows of a range when slots are numbered.
SLOT_ROWS = 200_000
KEY_RANGE = 1 << 60
LEAST = -(1 << 62)


def _code(value: str) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(value).cast("string"), F.lit(""))), F.lit(BINS)).cast("int")


def points(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, key, id, at)``: the tree's rows, without texts."""
    text = whole(F.col("text"))
    octets = F.octet_length(text)
    rows = docs.select(
        "doc_id", (octets + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(KEY_RANGE)).alias("key"),
        F.greatest(F.lit(LEAST + 1), F.least(F.lit(-LEAST - 1), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST + 1)))).alias("id"),
        F.least(F.lit(BINS - 1), F.floor(F.log2(octets + 1) * 100)).cast("int").alias("d0"),
        F.floor((octets - F.char_length(text)) * (BINS - 1) / F.greatest(octets, F.lit(1))).cast("int").alias("d1"),
        _code("lang").alias("d2"), _code("source").alias("d3"),
    )
    rows = stored(rows, "points")
    same = ["key", "text_crc32", "size"]
    # stored, so that both sides of the join are dealt out and a hot group can be split
    first = stored(rows.groupBy(*same).agg(F.min(F.struct("id", "d2", "d3")).alias("first")), "groups")
    return rows.join(first, same).select("doc_id", *same, "id", F.array("d0", "d1", "first.d2", "first.d3").alias("at"))


@dataclass
class _Search:
    """Where a node's median is looked for: digits fixed so far, then an interval of the next."""

    node: int
    dim: int
    goal: float
    leaf: float
    low: int
    high: int
    below: float = 0.0
    fixed: list[int] = field(default_factory=list)
    cut: tuple[int, int, int] | None = None

    @property
    def width(self) -> int:
        return max(1, -(-(self.high - self.low) // BINS))

    def narrow(self, sums: dict[int, int], ids: tuple[int, int]) -> None:
        """Take the bytes of each bin and go on to the bin of the median, or cut at one of its edges."""
        total = self.below
        at, weight = max(sums, default=0), 0
        for k in sorted(sums):
            if total + sums[k] >= self.goal:
                at, weight = k, sums[k]
                break
            total += sums[k]
        start = self.low + at * self.width
        if weight > TOLERANCE * self.leaf and (self.width > 1 or len(self.fixed) < 2):
            self.below = total
            if self.width > 1:
                self.low, self.high = start, min(start + self.width, self.high)
            else:
                self.fixed.append(start)
                self.low, self.high = (0, KEY_RANGE) if len(self.fixed) == 1 else (ids[0], ids[1] + 1)
            return
        edge = start if self.goal - total < total + weight - self.goal else start + self.width
        self.cut = tuple([*self.fixed, edge, LEAST, LEAST][:3])


def _with_node(rows: DataFrame, levels: list[list[tuple]]) -> DataFrame:
    """Add ``node``, by walking down the cuts of each level."""
    rows = rows.withColumn("node", F.lit(1))
    for cuts in levels:
        table = F.broadcast(rows.sparkSession.createDataFrame(cuts, "node int, dim int, c0 bigint, c1 bigint, c2 bigint"))
        place = F.struct(F.get("at", F.col("dim")).cast("long"), F.col("key"), F.col("id"))
        left = place < F.struct("c0", "c1", "c2")
        rows = rows.join(table, "node", "left").withColumn(
            "node", F.when(F.col("dim").isNull(), F.col("node")).when(left, F.col("node") * 2).otherwise(F.col("node") * 2 + 1)
        ).drop("dim", "c0", "c1", "c2")
    return rows


def tree(rows: DataFrame, shards: int) -> tuple[list[list[tuple]], dict[int, int]]:
    """The cuts of each level, and the shard number of each leaf node."""
    ends = [F.min("id"), F.max("id"), F.sum("size")]
    ends += [f(F.get("at", F.lit(k))) for k in range(DIMENSIONS) for f in (F.min, F.max)]
    lowest, highest, total, *spans = rows.agg(*ends).first()
    leaf = (total or 0) / shards
    overall = [max(1, (spans[2 * k + 1] or 0) - (spans[2 * k] or 0)) for k in range(DIMENSIONS)]
    levels, leaves, numbers = [], {1: shards}, {}
    while any(n > 1 for n in leaves.values()):
        placed = _with_node(rows, levels)
        parts = [f(F.get("at", F.lit(k))) for k in range(DIMENSIONS) for f in (F.min, F.max)]
        found = {r[0]: r[1:] for r in placed.groupBy("node").agg(F.sum("size"), *parts).collect()}
        searches = []
        for node, n in leaves.items():
            if n > 1:
                weight, *span = found.get(node, (0, *[0] * (2 * DIMENSIONS)))
                dim = max(range(DIMENSIONS), key=lambda k: ((span[2 * k + 1] - span[2 * k]) / overall[k], -k))
                searches.append(_Search(node, dim, weight * (n // 2) / n, leaf, 0, BINS))
        while active := [s for s in searches if s.cut is None]:
            known = rows.sparkSession.createDataFrame(
                [(s.node, s.dim, len(s.fixed), *[*s.fixed, 0, 0][:2], s.low, s.high, s.width) for s in active],
                "node int, dim int, depth int, f0 bigint, f1 bigint, low bigint, high bigint, width bigint",
            )
            first = F.get("at", F.col("dim")).cast("long")
            digit = F.when(F.col("depth") == 0, first).when(F.col("depth") == 1, F.col("key")).otherwise(F.col("id"))
            inside = ((F.col("depth") < 1) | (first == F.col("f0"))) & ((F.col("depth") < 2) | (F.col("key") == F.col("f1")))
            near = placed.join(F.broadcast(known), "node").withColumn("digit", digit)
            near = near.where(inside & (F.col("digit") >= F.col("low")) & (F.col("digit") < F.col("high")))
            bins = near.groupBy("node", F.expr("(digit - low) div width").alias("bin")).agg(F.sum("size").alias("bytes"))
            sums: dict[int, dict[int, int]] = {}
            for node, k, size in bins.collect():
                sums.setdefault(node, {})[k] = size
            for s in active:
                s.narrow(sums.get(s.node, {}), (lowest or 0, highest or 0))
        levels.append([(s.node, s.dim, *s.cut) for s in searches])
        leaves = {k: v for node, n in leaves.items() for k, v in (((2 * node, n // 2), (2 * node + 1, n - n // 2)) if n > 1 else ((node, n),))}
    for number, node in enumerate(sorted(leaves, key=lambda x: bin(x)[2:])):
        numbers[node] = number
    return levels, numbers


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: the place of a row in its shard, from 0 and without gaps."""
    n = rows.count() // SLOT_ROWS + 1
    order = ["shard", "id", "key"]
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("range", F.shiftright("place", 33)).withColumn("local", F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range and each shard that begins in it
    parts = ranged.groupBy("range", "shard").agg(F.count("*").alias("n"), F.min("local").alias("first"))
    parts = parts.select("range", "shard", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    joined = ranged.join(F.broadcast(parts), ["range", "shard"])
    return joined.withColumn("slot", F.col("local") - F.col("first") + F.col("earlier")).drop("range", "local", "place", "first", "earlier")


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row of ``docs``.

    Give the number of shards, or the bytes that a leaf should have.
    """
    rows = stored(points(docs), "points")
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    levels, numbers = tree(rows, shards)
    names = F.broadcast(docs.sparkSession.createDataFrame(list(numbers.items()), "node int, shard int"))
    placed = with_slots(_with_node(rows, levels).join(names, "node"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
