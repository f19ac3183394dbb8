"""Token lookups. Hot tokens are common: one word may occur in every document."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.session import cut_lineage

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 256 << 20
HOT_FRACTION = 1e-3
TRACKED = 10_000  # keys that the sketch of frequent ones keeps
MEASURED = 1_000  # rows that the size of a row is taken from


def fits_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Persist a candidate build side and count it up to the limit; true when it may be broadcast.

    The limit is a number of rows, or less if rows are so wide that they would exceed ``max_bytes``.
    """
    kept = small.persist(StorageLevel.MEMORY_AND_DISK)
    width = kept.limit(MEASURED).agg(F.avg(F.octet_length(F.to_json(F.struct(*small.columns))))).first()[0] or 1
    limit = min(max_rows, int(max_bytes / width))
    return kept, kept.limit(limit + 1).count() <= limit


def hot_keys(big: DataFrame, key: str, fraction: float = HOT_FRACTION) -> DataFrame:
    """``(key, salts)`` of keys that hold more than ``fraction`` of the rows: fewer than ``1 / fraction`` of them.

    A sketch of frequent items finds them in one pass without a shuffle by the key. ``salts`` is a key's share in units
    of ``fraction``, so that a key is spread in proportion and no salt has more than about one unit.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {int(1 / fraction)}, {TRACKED})")
    found = big.where(F.col(key).isNotNull()).agg(sketch.alias("top"), F.count("*").alias("total"))
    each = found.select("total", F.explode("top").alias("t")).select(F.col("t.item").alias(key), (F.col("t.count") / (F.col("total") * fraction)).alias("units"))
    return each.where("units > 1").select(key, F.ceil("units").cast("int").alias("salts"))


def salted(big: DataFrame, hot: DataFrame, key: str, spread_by: Column) -> DataFrame:
    """``big`` with ``_salt``, which splits every hot key into as many parts as ``hot`` says."""
    salt = F.pmod(F.xxhash64(spread_by), F.coalesce("salts", F.lit(1))).cast("int")
    return big.join(hot, key, "left").withColumn("_salt", salt).drop("salts")


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_by: Column, how: str = "inner") -> DataFrame:
    """Shuffle join in which every hot key of ``big`` is spread over many tasks.

    Only the rows of hot keys are repeated on the small side, fewer than ``2 / HOT_FRACTION`` copies in all. The list of hot
    keys is broadcast; its length is bounded by ``1 / HOT_FRACTION``.
    """
    hot = F.broadcast(cut_lineage(hot_keys(big, key)))
    copies = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("salts")
    return salted(big, hot, key, spread_by).join(right, [key, "_salt"], how).drop("_salt")


def token_lookup(
    big: DataFrame, small: DataFrame, key: str, spread_by: Column, how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Broadcast the small side when its counted size allows it, else join with hot keys salted."""
    kept, fits = fits_broadcast(small, max_rows)
    if fits:
        return big.join(F.broadcast(kept), key, how)
    return salted_join(big, kept, key, spread_by, how)
