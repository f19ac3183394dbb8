"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Every bit position is given a non-zero vector of ``radius + 1`` bits. The mask of a table, one for each non-zero
vector v, holds the positions whose vector has an odd product with v. For any ``radius`` positions there is a v
orthogonal to their vectors, so two fingerprints that differ at those positions agree under v's mask: every pair
within the radius meets in some table, without exception.

Only distinct fingerprints enter the tables, so copies cost nothing. Small buckets compare their members; in a
large one each fingerprint is joined to its 64 one-bit neighbours instead: two fingerprints within two bits share
a neighbour, and no neighbour has more than 65 members. No bucket is gathered or paired as a whole, and no link
is lost.

Null and empty texts have fingerprint zero and are linked like any other. Rows with equal ids or texts each get
their row; null ids never become the id of a component that has another. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.common import stored
from moodlens.llm.components import components
from moodlens.llm.cuts import slices

BITS = 64
SHINGLE = 3
SEED = 42
RADIUS = 2
#: Members up to which a bucket compares all of them.
SMALL_BUCKET = 32
#: Shingles whose bits are counted at once.
BLOCK = 16_384


def fingerprint(text: str | None) -> int:
    """Unsigned SimHash of the shingles of the lower-cased words; zero without words."""
    words = (text or "").encode().lower().split()
    n = max(len(words) - SHINGLE + 1, min(len(words), 1))
    if not n:
        return 0
    shingles = zip(*(words[k:] for k in range(SHINGLE))) if len(words) >= SHINGLE else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, n, BLOCK):
        octets = hashes[k : k + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, fp)``: the fingerprint as a signed long, and a hash of the text to tell rows apart."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, "text"):
                fp = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(fp)], names=["doc_id", "text_key", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, text_key bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The table masks as signed longs. Positions take the non-zero vectors in turn, so the masks are even."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + k % size for k in range(bits)]
    masks = [sum(1 << k for k, x in enumerate(vectors) if (x & v).bit_count() & 1) for v in range(1, size + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame) -> DataFrame:
    """``(a, b)`` of different fingerprints: links whose components are those of all pairs within the radius.

    Every link is itself within the radius. Takes a table ``(fp)`` of distinct fingerprints.
    """
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(covering_masks())])
    keyed = distinct.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes, ["t", "key"])

    members = shared.where(F.col("n") <= SMALL_BUCKET).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("m"))
    first = members.select("m", F.posexplode("m").alias("i", "a"))
    pairs = first.select("a", F.explode(F.slice("m", F.col("i") + 2, SMALL_BUCKET)).alias("b")).where(_distance(F.col("a"), F.col("b")) <= RADIUS)

    crowded = shared.where(F.col("n") > SMALL_BUCKET).select("fp").distinct()
    flips = [F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64) if k == 63 else 1 << k)) for k in range(BITS)]
    near = crowded.select("fp", F.explode(F.array("fp", *flips)).alias("middle"))
    stars = near.groupBy("middle").agg(F.sort_array(F.collect_list("fp")).alias("m")).where(F.size("m") > 1)
    spokes = stars.select(F.get("m", F.lit(0)).alias("a"), F.explode(F.slice("m", 2, BITS)).alias("b"))
    return pairs.unionByName(spokes).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, fp, component_id, keep)``: one row per document.

    ``component_id`` is the smallest id reachable over links. ``keep`` marks the one row of each component that a
    filter should keep: that of the smallest id, then of the smallest text hash; identical rows are all marked.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    classes = stored(rows.groupBy("fp").agg(F.min(order).alias("first")), "classes")
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.select("fp", "root").join(firsts, "root").select("fp", "least")
    return rows.join(named, "fp").select(
        "doc_id", "text_key", "fp", F.col("least.id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("least.id")) & (F.col("text_key") == F.col("least.key"))).alias("keep"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, all columns unchanged."""
    kept = near_duplicates(docs).where("keep").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.withColumn("_text_key", F.xxhash64("text"))
    found = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_id"]) & (keyed["_text_key"] == kept["_key"]), "left_semi")
    return found.dropDuplicates(["doc_id", "_text_key"]).drop("_text_key")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
