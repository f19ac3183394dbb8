"""Word and document vectors by negative sampling: skip-gram, CBOW and document context.

MLlib trains skip-gram with hierarchical softmax only. Here documents are hashed into large chunks; in every round
each chunk receives the vectors of its own words by a join, updates them in NumPy, and sends back what changed, which
is averaged per word. No table of all vectors is held by the driver or sent to every task.

What moves in a round is four half-precision vectors for every distinct word of a chunk, two each way: 8 bytes a
dimension, 1,600 bytes a word at 200 dimensions. The words of a chunk grow far slower than its tokens, so chunks are
large: at ``chunk_tokens`` of four million that is some 100 MB for 26 MB of English text, four times the text
(:func:`round_bytes` states it for a given corpus). ``chunk_tokens`` is the least size of a chunk: a corpus of more than
``SPREAD`` chunks gets larger ones, up to ``MOST_TOKENS``, or small chunks would move the vocabulary thousands of times.
The vectors kept between rounds are in single precision, and only changes are added to them, so rounding does not pile up.

Reviews without a vector of their own travel to their chunk packed, see :mod:`moodlens.operators.packing`.

What is kept between rounds is written below the shared folder as Parquet and dropped as soon as the next round is written.

Negative words come from the whole corpus: every word is dealt to chunks at random, in proportion to its count to
the power 0.75, and a chunk draws its negatives from what it was dealt. A batch shares its negatives, each weighted
so that a pair meets ``negative`` of them on average.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.operators import packing
from moodlens.session import cut_lineage, drop_path, scratch_path
from moodlens.sources import sinks

NOISE_BLOCK = 100_000
PART_CHUNKS = 1_000  # chunks of a word that share one copy of its vectors
MERGE_BYTES = 16 << 20  # changes that one task adds up; adding needs some six times as much
STEADY = 8  # pairs of one word in a batch that move it in full; more would overshoot, as they all see the same vectors
SPREAD = 64  # chunks beyond which they become larger instead of more
MOST_TOKENS = 2_000_000  # tokens of a chunk, if more were not asked for
BLOCK_TOKENS = 100_000  # tokens whose contexts are laid out at once
ARCHITECTURES = ("skipgram", "cbow", "document")


@dataclass(frozen=True)
class SamplingOptions:
    architecture: str = "cbow"
    size: int = 200
    window: int = 5
    min_count: int = 5
    rounds: int = 10
    negative: int = 10
    step: float = 0.025
    seed: int = 42
    chunk_tokens: int = 4_000_000
    batch: int = 512
    shared: int = 64  # negatives that a batch shares
    noise_words: int = 20_000  # negatives dealt to a chunk, on average


def _start_vector(key: Column, size: int, seed: int) -> Column:
    """Small random numbers that depend on key and seed only."""
    draw = lambda i: F.pmod(F.xxhash64(key, F.lit(seed), i), F.lit(1_000_003)).cast("double") / 1_000_003.0
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: (draw(i) - 0.5) / size)


def _pairs(ids: np.ndarray, doc: np.ndarray, window: int, rng: np.random.Generator):
    """Context positions of every word within its document, window shrunk at random: a padded matrix."""
    n, reach = len(ids), rng.integers(1, window + 1, len(ids))
    offsets = np.array([o for o in range(-window, window + 1) if o])
    at = np.arange(n)[:, None] + offsets[None, :]
    ok = (at >= 0) & (at < n) & (np.abs(offsets)[None, :] <= reach[:, None])
    at = np.clip(at, 0, n - 1)
    return ids[at], ok & (doc[at] == doc[:, None])


def _add(x: np.ndarray, rows: np.ndarray, change: np.ndarray, pairs: np.ndarray) -> None:
    """``x[rows] += change`` where rows may repeat. A row that stands for more than ``STEADY`` pairs moves as if by so many."""
    bits = len(rows).bit_length()
    order = np.sort((rows.astype(np.int64) << bits) | np.arange(len(rows)))  # numbers are sorted faster than places
    rows, order = order >> bits, order & ((1 << bits) - 1)
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    damped = np.maximum(np.add.reduceat(pairs[order], first) / STEADY, 1).astype(np.float32)
    x[rows[first]] += np.add.reduceat(change[order], first) / damped[:, None]


def _update(inp: np.ndarray, out: np.ndarray, rows, row_mask, target, target_mask, noise, o: SamplingOptions, step: float, drawn: np.ndarray) -> None:
    """One mini-batch: predict the masked targets from the mean of the masked input rows, against shared noise words.

    ``drawn`` is scratch space, a false value for each row of ``out``.
    """
    size = np.maximum(row_mask.sum(1, keepdims=True), 1)
    hidden = (inp[rows] * row_mask[:, :, None]).sum(1) / size
    known, negative = out[target], out[noise]
    true = step * target_mask / (1 + np.exp(np.clip(np.einsum("bd,bcd->bc", hidden, known), -30, 30)))
    weight = target_mask.sum(1, keepdims=True) * np.float32(step * o.negative / len(noise))
    false = -weight / (1 + np.exp(-np.clip(hidden @ negative.T, -30, 30)))
    drawn[noise] = True
    row, column = np.nonzero(drawn[target])
    drawn[noise] = False
    same, at = np.nonzero(target[row, column][:, None] == noise)  # a target is no negative of its own
    false[row[same], at] = 0
    back = np.einsum("bc,bcd->bd", true, known) + false @ negative
    live, used = np.nonzero(target_mask > 0), np.nonzero(row_mask > 0)
    each = target_mask.sum(1, keepdims=True)
    change = np.concatenate([true[live][:, None] * hidden[live[0]], false.T @ hidden])
    met = np.concatenate([np.ones(len(live[0])), np.full(len(noise), each.sum() * o.negative / len(noise))])
    _add(out, np.concatenate([target[live], noise]), change, met)
    _add(inp, rows[used], row_mask[used][:, None] * (back / size)[used[0]], (row_mask * (each / size))[used])


def _places(docs: pa.Table, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a chunk's reviews, packed or in order, as places in ``vocab``, and how many each review has."""
    if "block" in docs.column_names:
        _, sizes, at = packing.coded(docs["block"], vocab)
        return at, sizes
    lists = docs["tokens"].combine_chunks()
    found = pc.fill_null(pc.index_in(lists.flatten(), value_set=vocab), len(vocab)).to_numpy()
    return found.astype(np.int32, copy=False), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def _train_chunk(docs: pa.Table, params: pa.Table, dvec: np.ndarray, o: SamplingOptions, step: float, seed: int):
    """Updated ``(word input, word output, document vectors)`` of one chunk."""
    inp, out = (_matrix(params[c], np.float16).astype(np.float32) for c in ("vin", "vout"))
    ids, sizes = _places(docs, params["token"].combine_chunks())
    known = ids < len(params)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[known]
    ids = ids[known]
    dvec = dvec.copy()
    if len(ids) == 0:
        return inp, out, dvec
    rng = np.random.default_rng(seed)
    probs = params["noise"].to_numpy().astype("float64")
    if probs.sum() == 0:  # a chunk that was dealt nothing
        probs = np.bincount(ids, minlength=len(inp)) ** 0.75
    upto = np.cumsum(probs / probs.sum())
    if o.architecture == "document":  # the document's own vector joins the context words
        inp = np.vstack([inp, dvec])
    drawn = np.zeros(len(out), bool)
    for a in range(0, len(ids), BLOCK_TOKENS):
        # contexts at the edge of a block reach into its neighbours
        low, high = max(a - o.window, 0), min(a + BLOCK_TOKENS + o.window, len(ids))
        ctx, ok = _pairs(ids[low:high], doc[low:high], o.window, rng)
        mine = np.arange(a, min(a + BLOCK_TOKENS, len(ids)))
        ctx, ok = ctx[mine - low], ok[mine - low].astype(np.float32)
        if o.architecture == "document":
            ctx = np.concatenate([ctx, (len(inp) - len(dvec) + doc[mine])[:, None]], 1)
            ok = np.concatenate([ok, np.ones((len(mine), 1), np.float32)], 1)
        some = np.flatnonzero(ok.any(1))
        own, one = ids[mine][:, None], np.ones((len(mine), 1), np.float32)
        rows, row_mask, target, target_mask = (own, one, ctx, ok) if o.architecture == "skipgram" else (ctx, ok, own, one)
        for batch in np.array_split(rng.permutation(some), -(-len(some) // o.batch)) if len(some) else []:
            noise = np.minimum(np.searchsorted(upto, rng.random(o.shared), side="right"), len(upto) - 1)
            _update(inp, out, rows[batch], row_mask[batch], target[batch], target_mask[batch], noise, o, step, drawn)
    return inp[: len(params)], out, inp[len(params):] if o.architecture == "document" else dvec


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Vectors packed as bytes, one below the other."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(values) or values.null_count:
        return np.frombuffer(b"".join(values.to_pylist()), kind).reshape(len(values), -1)
    _, offsets, data = values.buffers()
    low, high = np.frombuffer(offsets, np.int32)[[values.offset, values.offset + len(values)]]
    return np.frombuffer(data[low:high], kind).reshape(len(values), -1)


def _packed(x: np.ndarray) -> pa.Array:
    """Rows as bytes. The bytes of a column stay below 2 GB, as :data:`MERGE_BYTES` and the size of a chunk see to."""
    x = np.ascontiguousarray(x)
    offsets = np.arange(len(x) + 1, dtype=np.int32) * (x.itemsize * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)])


CHANGES = pa.schema([
    ("kind", pa.string()), ("token", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()), ("review_id", pa.int64()),
    ("vin", pa.binary()), ("vout", pa.binary()),
])


def _round(docs: DataFrame, needed: DataFrame, params: DataFrame, o: SamplingOptions, number: int) -> DataFrame:
    """What every chunk changes: rows of kind ``word`` in half precision and, for documents, of kind ``doc``."""
    step = o.step * max(1e-2, 1.0 - number / max(o.rounds, 1))
    document = o.architecture == "document"

    def run(key: tuple, d: pa.Table, p: pa.Table) -> pa.Table:
        chunk, out = key[0].as_py(), []
        if len(d):
            d, p = d.sort_by("review_id") if document else d, p.sort_by("token")
            before = _matrix(d["dvec"], np.float32) if document else np.zeros((0, o.size), np.float32)
            dvec = before
            if len(p):
                vin, vout, dvec = _train_chunk(d, p, before, o, step, o.seed * 1_000_003 + number * 1009 + chunk)
                change = (x - _matrix(p[c], np.float16) for c, x in (("vin", vin), ("vout", vout)))
                out.append(("word", p["token"], p["part"], [None] * len(p), *(_packed(x.astype(np.float16)) for x in change)))
            if document:
                none = [None] * len(d)
                out.append(("doc", none, none, d["review_id"], _packed(dvec), none))
        tables = [
            pa.Table.from_arrays([pa.array([kind] * len(token)), *(x if isinstance(x, pa.ChunkedArray) else pa.array(x, t) for x, t in zip(
                (token, part, [chunk] * len(token), ids, vin, vout), CHANGES.types[1:]))], schema=CHANGES)
            for kind, token, part, ids, vin, vout in out
        ]
        return pa.concat_tables(tables) if tables else CHANGES.empty_table()

    # a word in very many chunks is split into parts, each with a copy of its vectors
    spread = params.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = needed.join(_halved(spread), ["token", "part"]).select("chunk", "token", "part", "noise", "vin", "vout")
    sent = sent.toDF(*sent.columns)
    kinds = "kind string, token string, part int, chunk long, review_id long, vin binary, vout binary"
    return docs.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(run, kinds)


def _halved(df: DataFrame) -> DataFrame:
    """The packed vectors in half precision."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            half = {c: _packed(_matrix(part.column(c), np.float32).astype(np.float16)) if len(part) else part.column(c) for c in ("vin", "vout")}
            yield pa.RecordBatch.from_arrays([half.get(n, c) for n, c in zip(part.schema.names, part.columns)], names=part.schema.names)

    return df.mapInArrow(batches, df.schema)


def _merged(changes: DataFrame, keys: list[str], buckets: int, kind: type) -> DataFrame:
    """The sums of changes and their number for each of ``keys``, added up in buckets of bounded bytes."""

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(k, "ascending") for k in (*keys, "chunk")])
        whole = pc.binary_join_element_wise(*(rows[k].cast(pa.string()) for k in keys), "\0") if len(keys) > 1 else rows[keys[0]]
        at = whole.combine_chunks().dictionary_encode().indices.to_numpy()
        first = np.flatnonzero(np.diff(at, prepend=-1))
        head = rows.take(pa.array(first))
        sums = [_packed(np.add.reduceat(_matrix(rows[c], kind).astype(np.float64), first)) for c in ("vin", "vout")]
        n = np.add.reduceat(rows["n"].to_numpy(), first)
        return pa.table({"token": head["token"], "part": head["part"], "chunk": head["chunk"], "n": n, "vin": sums[0], "vout": sums[1]})

    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    return changes.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(add, "token string, part int, chunk long, n long, vin binary, vout binary")


def _applied(params: DataFrame, sums: DataFrame) -> DataFrame:
    """``params`` moved by the mean change of each word."""
    both = params.join(sums.select("token", "n", F.col("vin").alias("din"), F.col("vout").alias("dout")), "token", "left")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            moved = {}
            for c, d in (("vin", "din"), ("vout", "dout")):
                x = _matrix(part.column(c), np.float32).copy() if len(part) else np.zeros((0, 1), np.float32)
                some = np.flatnonzero(part.column("n").is_valid().to_numpy(zero_copy_only=False))
                if len(some):
                    change = _matrix(part.column(d).take(pa.array(some)), np.float64)
                    x[some] += change / part.column("n").take(pa.array(some)).to_numpy()[:, None]
                moved[c] = _packed(x)
            yield pa.RecordBatch.from_arrays([part.column("token"), part.column("parts"), moved["vin"], moved["vout"]], names=["token", "parts", "vin", "vout"])

    return both.mapInArrow(batches, params.schema)


def _pack_vectors(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays of numbers as packed single-precision bytes."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            packed = {c: _packed(np.asarray(part.column(c).flatten(), np.float32).reshape(len(part), -1)) if len(part) else pa.array([], pa.binary()) for c in columns}
            yield pa.RecordBatch.from_arrays([packed.get(n, c) for n, c in zip(part.schema.names, part.columns)], names=part.schema.names)

    return df.mapInArrow(batches, ", ".join(f"{f.name} {'binary' if f.name in columns else f.dataType.simpleString()}" for f in df.schema.fields))


def _unpack_vector(df: DataFrame, column: str, out: str) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if len(part):
                x = _matrix(part.column(column), np.float32).astype(np.float64)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[part.schema.names[0], out])

    key = next(c for c in df.columns if c != column)
    return df.select(key, column).mapInArrow(batches, f"{key} {df.schema[key].dataType.simpleString()}, {out} array<double>")


def round_bytes(needed: DataFrame, size: int) -> int:
    """Bytes of vectors that a round moves to the chunks and back."""
    return needed.count() * 8 * size


def _dealt(vocab: DataFrame, chunks: int, o: SamplingOptions) -> DataFrame:
    """``(chunk, token, noise)``: how often each chunk was dealt each word as a negative.

    A word's copies over all chunks are its share of counts to the power 0.75, rounded at random; copies are
    unrolled in blocks, so that a very common word is no long array.
    """
    power = F.pow("n", F.lit(0.75))
    total = vocab.agg(F.sum(power)).scalar()
    draw = F.pmod(F.xxhash64("token", F.lit(o.seed), F.lit("noise")), F.lit(1_000_003)).cast("double") / 1_000_003.0
    copies = F.floor(power / F.col("total") * (chunks * o.noise_words) + draw).cast("long")
    rows = vocab.withColumn("total", total).select("token", copies.alias("copies")).filter("copies > 0")
    blocks = rows.select("token", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / NOISE_BLOCK))).alias("block"))
    last = F.least(F.col("copies") - F.col("block") * NOISE_BLOCK, F.lit(NOISE_BLOCK).cast("long"))
    each = blocks.select("token", F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("i"), "block")
    chunk = F.pmod(F.xxhash64("token", "block", "i", F.lit(o.seed)), F.lit(chunks)).cast("long")
    return each.select(chunk.alias("chunk"), "token").groupBy("chunk", "token").agg(F.count("*").alias("noise"))


def fit_vectors(df: DataFrame, options: SamplingOptions = SamplingOptions()) -> tuple[DataFrame, DataFrame | None]:
    """``(token, vector)`` and, for the document architecture, ``(review_id, vector)``.

    Input: ``review_id`` and ``tokens``. Both results are tables in the shared folder.
    """
    o = options
    if o.architecture not in ARCHITECTURES:
        raise ValueError(f"architecture must be one of {ARCHITECTURES}")
    if o.negative < 1:
        raise ValueError("without negative words use fit_word2vec, which trains by hierarchical softmax")
    rows = df.select("review_id", "tokens").filter(F.size("tokens") > 0)
    total = rows.agg(F.sum(F.size("tokens")).alias("n")).first()["n"] or 0
    if total == 0:
        raise ValueError("no tokens to train on")
    chunks = chunk_count(total, o)
    docs = rows.withColumn("chunk", F.pmod(F.xxhash64("review_id", F.lit(o.seed)), F.lit(chunks)).cast("long"))
    if o.architecture == "document":
        docs, at = _written(_pack_vectors(docs.withColumn("dvec", _start_vector(F.col("review_id").cast("string"), o.size, o.seed)), "dvec"))
    else:  # no vector belongs to a review, and its tokens stay as they are
        docs, at = _written(packing.packed(docs))
    needed, vocab = words_of_chunks(docs, chunks, o)
    parts = needed.groupBy("token").agg(F.ceil(F.count("*") / PART_CHUNKS).cast("int").alias("parts"))
    start = parts.select("token", "parts", _start_vector(F.col("token"), o.size, o.seed).alias("vin"), F.array_repeat(F.lit(0.0), o.size).alias("vout"))
    params, params_at = _written(_pack_vectors(start, "vin", "vout"))
    needed, needed_at = _written(needed.join(parts, "token").withColumn("part", F.pmod("chunk", "parts").cast("int")).drop("parts"))
    moved, most = needed.agg(F.count("*"), F.max("part")).first()
    buckets = moved * 4 * o.size // MERGE_BYTES + 1
    for number in range(o.rounds):
        result, result_at = _round(docs, needed, params, o, number), None
        if o.architecture == "document":  # read twice
            result, result_at = _written(result)
        words = result.filter(F.col("kind") == "word").select("token", "part", "chunk", F.lit(1).cast("long").alias("n"), "vin", "vout")
        sums = _merged(words, ["token", "part"], buckets, np.float16)
        if most:  # a word has several parts
            sums = _merged(sums, ["token"], buckets, np.float64)
        old = [params_at]
        params, params_at = _written(_applied(params, sums))
        if result_at:
            changed = result.filter(F.col("kind") == "doc").select("review_id", F.col("vin").alias("dvec"))
            old += [result_at, at]
            docs, at = _written(docs.drop("dvec").join(changed, "review_id"))
        for path in old:
            drop_path(df.sparkSession, path)
    vectors = cut_lineage(_unpack_vector(params.select("token", "vin"), "vin", "vector"))
    for path in (params_at, needed_at):
        drop_path(df.sparkSession, path)
    if o.architecture != "document":
        drop_path(df.sparkSession, at)
        return vectors, None
    return vectors, _unpack_vector(docs.select("review_id", "dvec"), "dvec", "vector")


def chunk_count(total: int, o: SamplingOptions) -> int:
    """Chunks of ``chunk_tokens``, larger where there would be more than ``SPREAD``."""
    return -(-total // max(o.chunk_tokens, min(MOST_TOKENS, -(-total // SPREAD))))


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table of the shared folder, and its path."""
    path = scratch_path(df.sparkSession, "vectors")
    return sinks.save_stage(df, path), path


def _counted(rows: pa.Table) -> pa.Table:
    """``chunk, token, n`` of one chunk, packed or not."""
    if "block" in rows.column_names:
        token, n = packing.counts(rows["block"])
    else:
        found = pc.value_counts(pc.drop_null(rows["tokens"].combine_chunks().flatten()))
        token, n = found.field("values"), found.field("counts")
    return pa.table({"chunk": pa.array(np.full(len(token), rows["chunk"][0].as_py(), np.int64)), "token": token, "n": pa.array(n, pa.int64())})


def words_of_chunks(docs: DataFrame, chunks: int, o: SamplingOptions) -> tuple[DataFrame, DataFrame]:
    """``(chunk, token, noise)`` of the words that each chunk has or was dealt, and the vocabulary ``(token, n)``."""
    per = cut_lineage(docs.select("chunk", "tokens" if "tokens" in docs.columns else "block").groupBy("chunk").applyInArrow(_counted, "chunk long, token string, n long"))
    vocab = cut_lineage(per.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= o.min_count))
    own = per.select("chunk", "token").join(vocab.select("token"), "token", "left_semi").withColumn("noise", F.lit(0).cast("long"))
    needed = own.unionByName(_dealt(vocab, chunks, o)).groupBy("chunk", "token").agg(F.sum("noise").alias("noise"))
    return cut_lineage(needed), vocab
