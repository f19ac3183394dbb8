"""A quality classifier that reads bytes: a small convolutional network in numpy.

Filters of four bytes run over the whole text. Their responses are max-pooled over overlapping chunks that cover
it; mean, largest and smallest pooled response of each filter over all chunks go into one logistic unit. Filters
and unit are learned together with Adam from labelled rows, ``FIT_ROWS`` at most, chosen by the hash of their id;
of each such text up to ``FIT_CHUNKS`` evenly spaced chunks are learned from. Scoring has no such bound: it reads
every byte of every text, in pieces, so a text of any length needs the same memory.

Since each filter is a sum of one table entry per byte, a response is two look-ups in tables of byte pairs.

Null and empty texts are scored like a single zero byte. Rows are scored one by one, so repeated rows get equal
scores, and further columns pass through unless named ``score``. Without labels of both kinds, every row gets the
share of good labels (one half without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from moodlens.llm.cuts import slices

WIDTH = 4
FILTERS = 24
#: Responses of a block; a chunk is ``CHUNK`` blocks and begins ``STEP`` blocks after the one before.
BLOCK, CHUNK, STEP = 64, 4, 3
#: Labelled rows that are learned from, at most, and chunks of each.
FIT_ROWS, FIT_CHUNKS = 1_600, 8
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.03, 7
#: Weight of a bad row relative to a good one.
BAD_WEIGHT = 3.0
#: Bytes whose responses are held at once.
PIECE = 1 << 15


@dataclass
class Network:
    """Filter tables (byte place, byte, filter), filter offsets, weights of the pooled values, and offset."""

    tables: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    offset: float

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        t = self.tables
        return tuple((t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65_536, -1).astype(np.float32) for k in (0, 2))

    def pooled(self, text: str | None, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Pooled responses of each chunk."""
        data = np.frombuffer((text or "").encode().ljust(WIDTH, b"\0"), np.uint8).astype(np.int32)
        codes = data[:-1] << 8 | data[1:]
        n, blocks = len(data) - WIDTH + 1, []
        for a in range(0, n, PIECE):
            b = min(a + PIECE, n)
            found = pairs[0][codes[a:b]]
            found += pairs[1][codes[a + 2 : b + 2]]
            blocks.append(np.maximum.reduceat(found, np.arange(0, b - a, BLOCK), axis=0))
        block = np.concatenate(blocks)
        starts = np.arange(0, max(1, len(block) - CHUNK + STEP), STEP)
        chunks = np.stack([block[np.minimum(starts + k, len(block) - 1)] for k in range(CHUNK)]).max(axis=0)
        return np.maximum(chunks + self.offsets, 0)

    def score(self, text: str | None, pairs: tuple[np.ndarray, np.ndarray]) -> float:
        m = self.pooled(text, pairs)
        z = float(np.concatenate([m.mean(axis=0), m.max(axis=0), m.min(axis=0)]) @ self.weights + self.offset)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _training_chunks(text: str | None) -> np.ndarray:
    """Evenly spaced chunks of a text, as rows of bytes; short texts are repeated to fill theirs."""
    size = BLOCK * CHUNK + WIDTH - 1
    data = (text or "").encode() or b"\0"
    if len(data) < size:
        data = (data * (size // len(data) + 1))[:size]
    x = np.frombuffer(data, np.uint8)
    n = min(FIT_CHUNKS, -(-len(x) // size))
    return np.stack([x[int(s) : int(s) + size] for s in np.linspace(0, len(x) - size, n)])


def fit(texts: list[str | None], good: list[int]) -> Network:
    """Learn from labelled texts; the same rows in the same order give the same network."""
    rng = np.random.default_rng(SEED)
    tables = rng.normal(0, 0.3, (WIDTH, 256, FILTERS))
    net = {"t": tables, "o": np.zeros(FILTERS), "w": rng.normal(0, 0.1, 3 * FILTERS), "c": np.zeros(1)}
    y = np.array(good, float)
    if len(set(good)) < 2:
        share = y.mean() if len(y) else 0.5
        return Network(tables, net["o"], np.zeros(3 * FILTERS), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    chunks = [_training_chunks(t) for t in texts]
    mean, square = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    step, span = 0, BLOCK * CHUNK
    for epoch in range(EPOCHS):
        order = rng.permutation(len(chunks))
        rate = RATE * (1 - epoch / EPOCHS)
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            x = np.concatenate([chunks[r] for r in rows])
            sizes = np.array([len(chunks[r]) for r in rows])
            first = np.cumsum(sizes) - sizes
            small = net["t"].astype(np.float32)
            found = small[0][x[:, :span]]
            for k in range(1, WIDTH):
                found += small[k][x[:, k : k + span]]
            at = found.argmax(axis=1)
            raw = np.take_along_axis(found, at[:, None, :], axis=1)[:, 0, :] + net["o"]
            m = np.maximum(raw, 0)
            most, least = np.maximum.reduceat(m, first), np.minimum.reduceat(m, first)
            pooled = np.concatenate([np.add.reduceat(m, first) / sizes[:, None], most, least], axis=1)
            p = 1 / (1 + np.exp(-np.clip(pooled @ net["w"] + net["c"][0], -30, 30)))
            g = (p - y[rows]) * np.where(y[rows] > 0, 1.0, BAD_WEIGHT) / len(rows)
            back = g[:, None] * net["w"][None, :]
            doc = np.repeat(np.arange(len(rows)), sizes)
            gm = back[doc, :FILTERS] / sizes[doc][:, None]
            gm += back[doc, FILTERS : 2 * FILTERS] * (m == most[doc]) + back[doc, 2 * FILTERS :] * (m == least[doc])
            gm *= raw > 0
            grad = {"t": np.zeros_like(net["t"]), "o": gm.sum(axis=0), "w": pooled.T @ g + 1e-4 * net["w"], "c": np.array([g.sum()])}
            filters = np.broadcast_to(np.arange(FILTERS), at.shape)
            for k in range(WIDTH):
                np.add.at(grad["t"][k], (x[np.arange(len(x))[:, None], at + k], filters), gm)
            step += 1
            for name, value in grad.items():
                mean[name] = 0.9 * mean[name] + 0.1 * value
                square[name] = 0.999 * square[name] + 0.001 * value**2
                net[name] = net[name] - rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
    return Network(net["t"], net["o"].astype(np.float32), net["w"], float(net["c"][0]))


def held_out(doc_id: Column) -> Column:
    """Whether a row is never learned from: its id's crc32 is a multiple of five. Null ids count as the text ``null``."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("null")), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Network:
    """A network from at most ``rows`` labelled rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("quality").alias("quality"))
    # a bounded part of each text leaves the executors: the fit reads evenly spaced chunks, not more
    size = BLOCK * CHUNK + WIDTH
    length = F.char_length("text")
    parts = [F.substring("text", (length * k / FIT_CHUNKS).cast("int") + 1, F.lit(size)) for k in range(FIT_CHUNKS)]
    brief = F.when(length > size * FIT_CHUNKS, F.concat(*parts)).otherwise(F.col("text"))
    got = sorted(found.select("doc_id", brief.alias("text"), "quality").collect())
    return fit([r["text"] for r in got], [int(r["quality"]) for r in got])


def score(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of a good label. The network travels with the tasks."""
    kept = docs.drop("score")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = network.pairs()
        for whole in parts:
            for part in slices(whole, text):
                found = pa.array([network.score(t, pairs) for t in part.column(text).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, "score"])

    return kept.mapInArrow(batches, StructType([*kept.schema.fields, StructField("score", DoubleType())]))
