"""Removal of word windows that an earlier document already has, by level-wise doubling.

Windows grow by doubling: 1, 2, 4, 7 and 13 words for the default length, each hash made from two hashes of the
level below. Only windows repeated at one level are extended to the next:

* Level one looks at windows of half the length. Of all half windows inside a full window only the one with the
  least hash is sent: equal full windows have the same least half, so nothing is lost, and a quarter of the
  positions is shuffled.
* Level two extends the halves that occur in two documents or more to the full length, and finds the smallest
  document of every full window. Identity is 96 bits of two independent half hashes; words are not compared, so two
  windows in 2^96 may be taken for equal.

Shorter levels are steps of the hash alone: almost every window of 1, 2 or 4 words repeats, so nothing would be left out.

The work is done on chunks, sets of documents chosen by the hash of their id. A chunk sends each hash once, with
the smallest and largest document id that has it there, so a passage shared by a third of all documents costs one
entry per chunk, and the smallest id of all returns to the chunks. Hash buckets and chunks are bounded by their bytes.

Null texts have no words. A null id counts as the largest one, 2^63 - 1. Rows with equal ids do not remove each
other's words. All input columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

WINDOW = 13
#: Text bytes of a chunk of documents.
CHUNK_BYTES = 2 << 20
#: Text bytes for each hash bucket.
BUCKET_BYTES = 32 << 20
NO_ID = np.iinfo(np.int64).max


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, with multiply-and-shift rounds."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _grown(level: np.ndarray, size: int, target: int) -> np.ndarray:
    """Hashes of windows of ``target`` words from those of ``size`` words, by doubling; the last step overlaps."""
    while size < target:
        step = min(size, target - size)
        level = _mix(level[: max(len(level) - step, 0)], level[step:])
        size += step
    return level


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        step = min(size, width - size)
        x = np.minimum(x[: max(len(x) - step, 0)], x[step:])
        size += step
    return x


class Chunk:
    """The words of some documents, and the hashes of their windows."""

    def __init__(self, docs: pa.Table, window: int) -> None:
        self.words = [(t or "").encode().split() for t in docs["text"].to_pylist()]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(self.sizes)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(self.words)), np.uint64, int(self.sizes.sum()))
        self.half = (window + 1) // 2
        self.halves = _grown(hashes, 1, self.half)
        row = np.repeat(np.arange(len(self.words)), self.sizes)
        count = max(len(row) - window + 1, 0)
        #: starts of the full windows that lie in one document
        self.starts = np.flatnonzero(row[:count] == row[window - 1 :][:count])
        self.least = _sliding_min(self.halves, window - self.half + 1)[self.starts]
        #: the document id of each full window
        self.ids = pc.fill_null(docs["doc_id"].cast(pa.int64()), NO_ID).to_numpy()[row[self.starts]]
        self.shift = window - self.half

    def keys(self, at: np.ndarray) -> np.ndarray:
        """Identity of the full windows at ``at``: their first half's hash and 32 bits of the second's."""
        out = np.empty(len(at), KEY)
        out["a"], out["b"] = self.halves[at], self.halves[at + self.shift] >> np.uint64(32)
        return out


KEY = np.dtype([("a", "<u8"), ("b", "<u4")])
LEVEL1 = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("many", pa.binary())])
VERDICT1 = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary())])
LEVEL2 = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
VERDICT2 = pa.schema([("chunk", pa.int64()), ("keys", pa.binary()), ("firsts", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, schema.types, strict=True)], schema=schema)


def _by_bucket(values: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of ``values`` by bucket, then by value, and each bucket's slice of it."""
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((values, bucket))
    found, first = np.unique(bucket[order], return_index=True)
    return order, [(int(b), slice(i, j)) for b, i, j in zip(found, first, [*first, len(order)][1:], strict=False)]


def _level1(window: int, buckets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def send(key: tuple, docs: pa.Table) -> pa.Table:
        chunk = Chunk(docs, window)
        values, ids = chunk.least, chunk.ids
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (ids[1:] != ids[:-1])
        values, ids = values[fresh], ids[fresh]
        order = np.argsort(values)
        values, ids = values[order], ids[order]
        first = np.flatnonzero(np.diff(values, prepend=~values[:1]))
        many = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first) if len(first) else np.zeros(0, bool)
        values = values[first]
        order, parts = _by_bucket(values, buckets)
        return _rows([(b, key[0].as_py(), values[order[s]].tobytes(), np.packbits(many[order[s]]).tobytes()) for b, s in parts], LEVEL1)

    return send


def _arrays(column: pa.ChunkedArray, kind: object) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _repeated(part: pa.Table) -> pa.Table:
    """For each chunk, the hashes of a bucket that two documents or more have."""
    lists = _arrays(part["hashes"], np.uint64)
    marks = [np.unpackbits(x, count=len(v)).astype(bool) for x, v in zip(_arrays(part["many"], np.uint8), lists, strict=True)]
    every, count = np.unique(np.concatenate(lists), return_counts=True)
    some = every[count > 1]
    out = []
    for chunk, values, many in zip(part["chunk"].to_pylist(), lists, marks, strict=True):
        hit = values[many | _within(values, some)]
        if len(hit):
            out.append((chunk, hit.tobytes()))
    return _rows(out, VERDICT1)


def _within(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which values are in ``found``, which is sorted."""
    if not len(found):
        return np.zeros(len(values), bool)
    return found[np.minimum(np.searchsorted(found, values), len(found) - 1)] == values


def _level2(window: int, buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def send(key: tuple, docs: pa.Table, verdict: pa.Table) -> pa.Table:
        if not len(docs) or not len(verdict):
            return _rows([], LEVEL2)
        chunk = Chunk(docs, window)
        found = np.sort(np.concatenate(_arrays(verdict["hashes"], np.uint64)))
        at = np.flatnonzero(_within(chunk.least, found))
        keys, ids = chunk.keys(chunk.starts[at]), chunk.ids[at]
        order = np.lexsort((keys["b"], keys["a"]))
        keys, ids = keys[order], ids[order]
        first = np.flatnonzero(_changes(keys))
        if not len(first):
            return _rows([], LEVEL2)
        low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
        keys = keys[first]
        order, parts = _by_bucket(keys["a"], buckets)
        return _rows([(b, key[0].as_py(), *(x[order[s]].tobytes() for x in (keys, low, high))) for b, s in parts], LEVEL2)

    return send


def _changes(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = (keys["a"][1:] != keys["a"][:-1]) | (keys["b"][1:] != keys["b"][:-1])
    return new


def _earlier(part: pa.Table) -> pa.Table:
    """For each chunk, the full windows that a smaller document has, and the smallest of these."""
    keys = _arrays(part["keys"], KEY)
    every, lows, highs = np.concatenate(keys), *(np.concatenate(_arrays(part[n], np.int64)) for n in ("low", "high"))
    order = np.lexsort((every["b"], every["a"]))
    new = _changes(every[order])
    smallest = np.empty_like(lows)
    smallest[order] = np.minimum.reduceat(lows[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    lost = smallest < highs
    out, bounds = [], np.cumsum([0, *map(len, keys)])
    for chunk, a, b in zip(part["chunk"].to_pylist(), bounds, bounds[1:]):
        hit = np.flatnonzero(lost[a:b]) + a
        if len(hit):
            out.append((chunk, every[hit].tobytes(), smallest[hit].tobytes()))
    return _rows(out, VERDICT2)


def _cut(window: int, columns: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def cut(docs: pa.Table, verdict: pa.Table) -> pa.Table:
        chunk = Chunk(docs, window)
        total = int(chunk.sizes.sum())
        gone = np.zeros(total + 1, np.int64)
        if len(verdict):
            keys, firsts = np.concatenate(_arrays(verdict["keys"], KEY)), np.concatenate(_arrays(verdict["firsts"], np.int64))
            order = np.lexsort((keys["b"], keys["a"]))
            keys, firsts = keys[order], firsts[order]
            mine = chunk.keys(chunk.starts)
            # keys with the same first half are rare: step through them until all are compared
            at = np.searchsorted(keys["a"], mine["a"])
            lost = np.zeros(len(mine), bool)
            live = np.arange(len(mine))
            while len(live):
                live = live[at[live] < len(keys)]
                live = live[keys["a"][at[live]] == mine["a"][live]]
                same = keys["b"][at[live]] == mine["b"][live]
                lost[live[same]] = chunk.ids[live[same]] > firsts[at[live[same]]]
                live = live[~same]
                at[live] += 1
            starts = chunk.starts[lost]
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + window, -1)
        kept = np.cumsum(gone[:total]) == 0
        texts, removed = [], []
        for words, end in zip(chunk.words, chunk.ends, strict=True):
            keep = kept[end - len(words) : end]
            left = int(keep.sum())
            removed.append(len(words) - left)
            chosen = words if left == len(words) else [w for w, k in zip(words, keep, strict=True) if k]
            texts.append(b" ".join(chosen).decode())
        out = docs.select(columns)
        for name, values in (("n_words", chunk.sizes), ("n_removed", np.array(removed, np.int64)), ("kept_text", pa.array(texts, pa.string()))):
            out = out.append_column(name, pa.array(values))
        return out

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, the words left, joined by one space.

    A word is removed if a window of ``window`` words that covers it also starts in a document with a smaller id.
    Windows are judged on the input.
    """
    outputs = {"n_words": LongType(), "n_removed": LongType(), "kept_text": StringType()}
    columns = [c for c in docs.columns if c not in outputs and c != "_chunk"]
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = total // CHUNK_BYTES + 1, int(total // BUCKET_BYTES + 1)
    chunk = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), "text")), F.lit(chunks))
    # dealt out once: all three passes take the same columns, so the plan reuses this exchange
    dealt = docs.select(*columns, chunk.alias("_chunk")).repartition("_chunk")
    half = dealt.groupBy("_chunk").applyInArrow(_level1(window, buckets), from_arrow_schema(LEVEL1))
    found = half.groupBy("bucket").applyInArrow(_repeated, from_arrow_schema(VERDICT1))
    full = dealt.groupBy("_chunk").cogroup(found.groupBy("chunk")).applyInArrow(_level2(window, buckets), from_arrow_schema(LEVEL2))
    lost = full.groupBy("bucket").applyInArrow(_earlier, from_arrow_schema(VERDICT2))
    schema = StructType([docs.schema[c] for c in columns] + [StructField(n, k) for n, k in outputs.items()])
    return dealt.groupBy("_chunk").cogroup(lost.groupBy("chunk")).applyInArrow(_cut(window, columns), schema)
