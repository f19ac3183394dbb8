"""Exact ranks and running totals without a single-task sort.

A window over a class puts all rows of that class in one task, and one class may hold a third or more
of the data. The operators here cut each class into ordered buckets first. Counts per bucket are a
small table of known size; only inside a bucket are rows sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlens.session import cut_lineage

HASH_DIGITS = 4  # hex digits per bucket: at most 65,536 buckets per class


def hash_key(row_id: str | Column, seed: int) -> Column:
    """Portable random order: MD5 of ``id:seed``. Ids are unique, so the order is total."""
    col = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(col.cast("string"), F.lit(f":{seed}")))


def _bucket(h: Column) -> Column:
    return F.substring(h, 1, HASH_DIGITS)


def _histogram(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*by)
    return (
        hashed.groupBy(*by, _bucket(F.col("_h")).alias("_b"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_cum", F.sum("_n").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_n").over(w))
    )


def hash_cutoffs(
    df: DataFrame, by: Sequence[str], quota: Callable[[Column], Column], row_id: str = "review_id", seed: int = 42
) -> DataFrame:
    """Per class, the hash of the last of the ``quota(class size)`` rows with the smallest hashes.

    Only rows of the one bucket where the quota is reached are sorted. The result has one row per
    class, so it can always be broadcast: columns ``by``, ``class_size``, ``cutoff``.
    """
    hashed = df.select(*by, hash_key(row_id, seed).alias("_h"))
    hist = _histogram(hashed, by).withColumn("_quota", quota(F.col("_total")))
    edge = hist.filter((F.col("_cum") >= F.col("_quota")) & (F.col("_cum") - F.col("_n") < F.col("_quota"))).select(
        *by, "_b", "_total", (F.col("_quota") - F.col("_cum") + F.col("_n")).alias("_need")
    )
    inside = hashed.withColumn("_b", _bucket(F.col("_h"))).join(F.broadcast(edge), [*by, "_b"])
    rank = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h"))
    return (
        inside.withColumn("_r", rank)
        .filter(F.col("_r") == F.col("_need"))
        .select(*by, F.col("_total").alias("class_size"), F.col("_h").alias("cutoff"))
    )


def smallest_hashes(df: DataFrame, n: int, row_id: str = "review_id", seed: int = 42) -> DataFrame:
    """Exactly n rows (all if there are fewer), chosen by hash order."""
    marked = df.withColumn("_all", F.lit(0))
    cut = hash_cutoffs(marked, ["_all"], lambda total: F.least(total, F.lit(n)), row_id, seed)
    return (
        marked.join(F.broadcast(cut.select("_all", "cutoff")), "_all")
        .filter(hash_key(row_id, seed) <= F.col("cutoff"))
        .drop("_all", "cutoff")
    )


def hash_rank(df: DataFrame, by: Sequence[str], row_id: str = "review_id", seed: int = 42) -> DataFrame:
    """Adds ``class_rank``: 1-based position of each row in its class by hash order."""
    hashed = df.withColumn("_h", hash_key(row_id, seed)).withColumn("_b", _bucket(F.col("_h")))
    hist = _histogram(df.select(*by, hash_key(row_id, seed).alias("_h")), by)
    before = hist.select(*by, "_b", (F.col("_cum") - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h"))
    # at most 65,536 rows per class
    return (
        hashed.join(F.broadcast(before), [*by, "_b"])
        .withColumn("class_rank", F.col("_before") + inside)
        .drop("_h", "_b", "_before")
    )


def running_totals(g: DataFrame, part: Sequence[str], order: str, sums: Sequence[str], following: bool = False) -> DataFrame:
    """Adds ``cum_<s>`` for each summed column: running total within ``part`` by ``order``.

    ``g`` holds one row per ``(part, order)``. It is dealt out by ranges, as many as the session has shuffle partitions,
    and only inside a range are rows sorted; totals of the ranges before are a small table. ``following`` adds
    ``next_<s>``, the column of the next row, null at the end of a part.
    """
    ranged = g.repartitionByRange(*part, order).withColumn("_b", F.spark_partition_id())
    b = cut_lineage(ranged)  # written: the numbers of the ranges must not change between the passes
    # one row for each part and range
    places = Window.partitionBy(*part).orderBy("_b")
    first = [F.min_by(s, order).alias(f"_f_{s}") for s in sums]
    before = b.groupBy(*part, "_b").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums], *first).select(
        *part, "_b",
        *[F.coalesce(F.sum(f"_t_{s}").over(places.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_p_{s}") for s in sums],
        *[F.lead(f"_f_{s}").over(places).alias(f"_n_{s}") for s in sums],
    )
    inside = Window.partitionBy(*part, "_b").orderBy(order)
    out = b.join(F.broadcast(before), [*part, "_b"])
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.col(f"_p_{s}") + F.sum(s).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        if following:
            out = out.withColumn(f"next_{s}", F.coalesce(F.lead(s).over(inside), F.col(f"_n_{s}")))
    return out.drop("_b", *[f"_{k}_{s}" for k in "pn" for s in sums])
