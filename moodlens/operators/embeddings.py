"""Review vectors from word vectors.

Word vectors are a ``token, vector`` table and review vectors a ``review_id, features`` table, both
with array<double> columns.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlens.functions import vectors as V
from moodlens.operators import joins, packing
from moodlens.operators.cleaning import tokens_long
from moodlens.session import scratch_path
from moodlens.sources import sinks

CHUNK_TOKENS = 4_000_000  # tokens of a chunk of reviews, less for wide vectors
CHUNK_NUMBERS = 64_000_000  # tokens of a chunk times the size of their vectors, down to an eighth of CHUNK_TOKENS
BROADCAST_NUMBERS = 400_000  # numbers of a vector table up to which reviews look their tokens up in a broadcast
CHUNK_SUMS = 4_000_000  # numbers of the sums of a chunk's reviews
BLOCK_TOKENS = 100_000  # tokens whose vectors are laid out at once, fewer for wide vectors
BLOCK_NUMBERS = 2_000_000  # numbers of the vectors that are laid out at once


def token_counts(df: DataFrame, *keep: str) -> DataFrame:
    """``review_id, token, c``: occurrences are summed before anything is joined to them."""
    cols = ["review_id", *keep]
    return tokens_long(df, *cols).groupBy(*cols, "token").agg(F.count("*").alias("c"))


def lookup_tokens(df: DataFrame, table: DataFrame, how: str = "inner", max_rows: int = joins.MAX_BROADCAST_ROWS) -> DataFrame:
    """``review_id, token, c`` joined with a token table.

    When the table may be broadcast, the tokens of a review never leave their task before they are
    aggregated again. Otherwise repeated tokens are summed first and hot tokens salted.
    """
    kept, fits = joins.fits_broadcast(table, max_rows)
    if fits:
        return tokens_long(df, "review_id").withColumn("c", F.lit(1).cast("long")).join(F.broadcast(kept), "token", how)
    return joins.salted_join(token_counts(df), kept, "token", F.col("review_id"), how)


def vector_size(vectors: DataFrame, column: str = "vector") -> int:
    row = vectors.select(F.size(column).alias("d")).first()
    if row is None:
        raise ValueError("the vector table has no rows")
    return row["d"]


def weighted_sum(vector: str, weight: Column, dim: int) -> Column:
    """Aggregate: component-wise sum of ``weight * vector``; partial sums are made before the shuffle.

    One aggregate holds the whole vector, at any size. Rows without a vector add nothing.
    """
    scaled = F.transform(F.coalesce(F.col(vector), F.array_repeat(F.lit(0.0), dim)), lambda x: x * F.coalesce(weight, F.lit(0.0)))
    return vector_to_array(Summarizer.sum(array_to_vector(scaled)))


def chunked(df: DataFrame, tokens: int, written: bool = False, reviews: int = CHUNK_SUMS) -> DataFrame:
    """``chunk, block``: packed rows, written first unless ``df`` is ``written``; a chunk has all rows of its reviews.

    On average it has so many ``tokens``, or less where that would be more than so many ``reviews``. Rows without an id are
    left out, as they meet nothing.
    """
    rows = df.select("review_id", "tokens").filter(F.col("review_id").isNotNull())
    stage = rows if written else sinks.save_stage(rows, scratch_path(df.sparkSession, "tokens"), "zstd")
    total, n = stage.agg(F.sum(F.size("tokens")), F.count("*")).first()
    chunks = max(1, -(-(total or 0) // tokens), -(-n // reviews))
    return packing.packed(stage.withColumn("chunk", F.pmod(F.xxhash64("review_id"), F.lit(chunks)).cast("int")))


def words_of(docs: DataFrame) -> DataFrame:
    """``chunk, token``: the distinct words of every chunk."""

    def distinct(rows: pa.Table) -> pa.Table:
        words = packing.words(rows["block"])
        return pa.table({"chunk": pa.array(np.full(len(words), rows["chunk"][0].as_py(), np.int32)), "token": words})

    return docs.groupBy("chunk").applyInArrow(distinct, "chunk int, token string")


def token_sums(df: DataFrame, table: DataFrame, dim: int, written: bool = False) -> DataFrame:
    """``review_id, sums, n_tokens, n_in_vocab, n_types``: ``weight * vector`` added up over the tokens of each review.

    Reviews are dealt to chunks, and each chunk gets the vectors of its own words: a word travels once for each chunk
    that has it, not once for each of its tokens. ``table`` has ``token, vector, weight``; tokens that it repeats count as
    often in all numbers, as in a left join, and ``n_types`` counts the distinct tokens that it has.
    """
    docs = chunked(df, max(CHUNK_TOKENS // 8, min(CHUNK_TOKENS, CHUNK_NUMBERS // dim)), written, max(1, CHUNK_SUMS // dim))
    sent = words_of(docs).join(table.select("token", "vector", "weight"), "token").select("chunk", "token", "vector", "weight")
    id_type = df.schema["review_id"].dataType.simpleString()
    laid_out = max(1, min(BLOCK_TOKENS, BLOCK_NUMBERS // dim))

    def known(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """The words with their sums of weighted vectors, and how many rows and how many vectors each has; a last entry stands for all others."""
        words = rows["token"].combine_chunks().dictionary_encode()
        at, k = words.indices.to_numpy(), len(words.dictionary)
        has = rows["vector"].is_valid().to_numpy()
        x = np.zeros((k + 1, dim))
        for low in range(0, len(rows), laid_out):
            part, own = rows.slice(low, laid_out), has[low : low + laid_out]
            weight = pc.fill_null(part["weight"], 0.0).to_numpy()
            vectors = pc.list_flatten(part["vector"]).to_numpy().reshape(-1, dim)
            np.add.at(x, at[low : low + laid_out][own], vectors * weight[own, None])
        return words.dictionary, x, np.bincount(at, minlength=k + 1), np.bincount(at[has], minlength=k + 1)

    def add(rows: pa.Table, words: pa.Table) -> pa.Table:
        vocab, x, n_rows, n_vectors = known(words)
        ids, sizes, at = packing.coded(rows["block"], vocab)
        codes = ids.dictionary_encode()
        n = len(codes.dictionary)
        each = np.bincount(codes.indices.to_numpy(), sizes, n).astype(np.int64)
        sums, counts, ends = np.zeros((n, dim)), np.zeros((3, n), np.int64), np.cumsum(each)
        low = a = 0
        while low < n:  # whole reviews of so many tokens, or one of more
            high = max(low + 1, int(np.searchsorted(ends, a + laid_out, side="right")))
            b = int(ends[high - 1])
            word, who = at[a:b], np.repeat(np.arange(high - low), each[low:high])
            if b > a:
                first = np.flatnonzero(np.diff(who, prepend=-1))
                for c in range(a, b, laid_out):  # a long review goes in pieces
                    part = np.unique(np.concatenate([[c - a], first[(first > c - a) & (first < c - a + laid_out)]]))
                    piece = np.add.reduceat(x[word[c - a : c - a + laid_out]], part - (c - a))
                    sums[low + who[part]] += piece
                counts[0, low:high] = np.bincount(who, np.maximum(n_rows[word], 1), high - low)
                counts[1, low:high] = np.bincount(who, n_vectors[word], high - low)
                pairs = np.unique(who * len(x) + word)
                counts[2, low:high] = np.bincount(pairs // len(x), n_rows[pairs % len(x)], high - low)
            low, a = high, b
        lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dim, sums.ravel())
        return pa.table([codes.dictionary, lists, *(pa.array(c) for c in counts)], names=names)

    names = ["review_id", "sums", "n_tokens", "n_in_vocab", "n_types"]
    kinds = f"review_id {id_type}, sums array<double>, n_tokens long, n_in_vocab long, n_types long"
    return docs.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(add, kinds).filter("n_tokens > 0")


# --- training ------------------------------------------------------------------------------------


def fit_word2vec(
    train: DataFrame, size: int = 200, window: int = 5, min_count: int = 5, epochs: int = 10, seed: int = 42,
    partitions: int = 1, step: float = 0.025,
):
    """Skip-gram on the train rows. More partitions train faster and average more."""
    w2v = Word2Vec(
        vectorSize=size, windowSize=window, minCount=min_count, maxIter=epochs, seed=seed, numPartitions=partitions,
        stepSize=step, inputCol="tokens", outputCol="_w2v",
    )
    return w2v.fit(train.select("tokens"))


def word_vectors(model) -> DataFrame:
    return model.getVectors().select(F.col("word").alias("token"), vector_to_array("vector").alias("vector"))


def subsample_frequent(tokens: DataFrame, threshold: float = 1e-3, seed: int = 42) -> DataFrame:
    """Drop occurrences of frequent words at random: keep with probability ``sqrt(t/f) + t/f``.

    The random number is a hash of row, position and seed, so a retried task drops the same ones.
    """
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    share = F.col("n") / counts.agg(F.sum("n")).scalar()
    rate = counts.withColumn("keep", F.sqrt(F.lit(threshold) / share) + F.lit(threshold) / share)
    # only words above the threshold can lose occurrences, and at most 1 / threshold words can be above it
    frequent = rate.filter(F.col("keep") < 1).select("token", "keep")
    key = F.concat_ws(":", F.col("review_id").cast("string"), F.col("pos").cast("string"), F.lit(str(seed)))
    u = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return tokens.join(F.broadcast(frequent), "token", "left").filter(F.col("keep").isNull() | (u < F.col("keep"))).drop("keep")


def subsample_rows(df: DataFrame, threshold: float = 1e-3, seed: int = 42) -> DataFrame:
    """``df`` with frequent words dropped from ``tokens`` by the rule of :func:`subsample_frequent`, each review in place.

    The frequent words, at most 1 / threshold of them, travel with the tasks, so no token is shuffled but for the counts.
    Null tokens are dropped; a review that loses all its words, or has none, keeps an empty list.
    """
    counts = df.select(F.explode("tokens").alias("token")).filter(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("n"))
    share = F.col("n") / counts.agg(F.sum("n")).scalar()
    rate = counts.select("token", (F.sqrt(F.lit(threshold) / share) + F.lit(threshold) / share).alias("keep")).filter(F.col("keep") < 1)
    keep = dict(sorted((r["token"], r["keep"]) for r in rate.collect()))  # at most 1 / threshold rows

    def batches(parts):
        frequent, limit = pa.array(list(keep), pa.string()), np.array([*keep.values(), 1.0])
        for part in parts:
            lists = part.column("tokens")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            ends, flat = np.cumsum(sizes), lists.flatten()
            word = pc.fill_null(pc.index_in(flat, value_set=frequent), len(keep)).to_numpy()
            left = flat.is_valid().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(left & (word < len(keep)))
            owner = np.searchsorted(ends, at, side="right")
            ids = part.column("review_id").to_pylist()
            places = (at - (ends - sizes)[owner]).tolist()
            draws = b"".join([md5(f"{ids[o]}:{p}:{seed}".encode()).digest()[:4] for o, p in zip(owner.tolist(), places)])
            left[at] = np.frombuffer(draws, ">u4") / 4294967296.0 < limit[word[at]]
            bounds = np.concatenate([[0], np.cumsum(left)])[np.concatenate([[0], ends])]
            kept = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat.filter(pa.array(left)))
            yield pa.RecordBatch.from_arrays([kept if n == "tokens" else c for n, c in zip(part.schema.names, part.columns)], names=part.schema.names)

    return df.mapInArrow(batches, df.schema)


def regroup_tokens(tokens: DataFrame) -> DataFrame:
    """Back to one row per review with its tokens in order."""
    return tokens.groupBy("review_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens")
    )


# --- review vectors ------------------------------------------------------------------------------


def sif_weights(train_freq: DataFrame, a: float = 1e-3) -> DataFrame:
    """``token, weight``; tokens not seen in training weigh 1. The counts are kept, as their sum is read beside them."""
    train_freq = train_freq.persist(StorageLevel.MEMORY_AND_DISK)
    total = train_freq.agg(F.sum("n")).scalar()
    return train_freq.withColumn("_total", total).select("token", "n", V.sif_weight(F.col("n"), F.col("_total"), a).alias("weight"))


def frequent_sif_weights(train_freq: DataFrame, k: int = 30) -> DataFrame:
    """The ``k`` most frequent tokens with their weights and ranks."""
    top = sif_weights(train_freq).orderBy(F.desc("n"), "token").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "token")))


def sif_buckets(ranked: DataFrame) -> DataFrame:
    bucket = F.when(F.col("rank") <= 10, "high").when(F.col("rank") <= 20, "mid").when(F.col("rank") <= 30, "low")
    return ranked.withColumn("bucket", bucket).filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(
        F.avg("weight").alias("mean_weight"))


def document_vectors(
    df: DataFrame, vectors: DataFrame, dim: int, weights: DataFrame | None = None, l2: bool = False, written: bool = False
) -> DataFrame:
    """Mean of ``weight * vector`` over the in-vocabulary tokens of each review; zeros if there are none.

    The mean divides by the number of in-vocabulary tokens, not by the sum of weights. The tokens of a ``written`` table are
    not written again.
    """
    table = vectors.select("token", "vector")
    if weights is not None:
        table = table.join(weights.select("token", "weight"), "token", "left").select(
            "token", "vector", F.coalesce("weight", F.lit(1.0)).alias("weight"))
    else:
        table = table.withColumn("weight", F.lit(1.0))
    # a broadcast multiplies a vector for every token in the JVM, so it is for small tables only
    table, fits = joins.fits_broadcast(table, max(1, BROADCAST_NUMBERS // dim))
    if fits:
        hits = tokens_long(df, "review_id").withColumn("c", F.lit(1).cast("long")).join(F.broadcast(table), "token", "left")
        known = F.col("vector").isNotNull()
        sums = hits.groupBy("review_id").agg(
            weighted_sum("vector", F.col("c") * F.col("weight"), dim).alias("_s"),
            F.sum("c").alias("n_tokens"), F.sum(F.when(known, F.col("c")).otherwise(0)).alias("n_in_vocab"),
        )
    else:
        sums = token_sums(df, table, dim, written).select("review_id", F.col("sums").alias("_s"), "n_tokens", "n_in_vocab")
    zeros = F.array_repeat(F.lit(0.0), dim)
    # reviews without any token come back through their ids, so texts are cleaned once
    out = df.select("review_id").join(sums, "review_id", "left").select(
        "review_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("n_in_vocab", F.lit(0)).alias("n_in_vocab"),
        F.when(F.col("n_in_vocab") > 0, V.scale(F.col("_s"), 1 / F.nullif("n_in_vocab", F.lit(0)))).otherwise(zeros).alias("features"),
    )
    if l2:
        out = out.withColumn("features", V.l2_normalise(F.col("features")))
    return out.withColumn("zero_vector", F.col("n_in_vocab") == 0)


def l2_normalise(df: DataFrame) -> DataFrame:
    return df.withColumn("features", V.l2_normalise(F.col("features")))


def principal_direction(train: DataFrame) -> list[float]:
    """First right singular vector of the uncentred train matrix: one vector of the embedding size."""
    vecs = train.select(array_to_vector("features").alias("v"))
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vecs, "v"))
    return [float(x) for x in matrix.computeSVD(1).V.toArray()[:, 0]]


def remove_direction(df: DataFrame, u: list[float]) -> DataFrame:
    """``x - (x.u) u`` for every row."""
    uc = F.array(*[F.lit(x) for x in u])
    along = V.scale(uc, V.dot(F.col("features"), uc))
    return df.withColumn("features", F.zip_with("features", along, lambda x, p: x - p))


def remove_principal_component(df: DataFrame, split: str = "split") -> DataFrame:
    """Fit the direction on the train rows only and remove it from all rows."""
    train = df.filter(F.col(split) == "train")
    if train.limit(3).count() <= 2:
        return df
    return remove_direction(df, principal_direction(train))


def describe(sif: bool, remove_pc: bool, l2: bool) -> str:
    return f"Word2Vec({'SIF' if sif else 'mean'}{'-PCrm' if sif and remove_pc else ''}{'-L2' if l2 else ''})"


# --- checks --------------------------------------------------------------------------------------


def embedding_quality(df: DataFrame, dim: int) -> DataFrame:
    feats = F.col("features")
    per = df.select(
        V.norm(feats).alias("norm"), V.is_zero(feats).alias("zero"),
        F.size(F.filter(feats, lambda v: v != 0.0)).alias("nz"),
    )
    n, zero = F.count("*"), F.count_if("zero")
    return per.agg(
        n.alias("n_rows"), zero.alias("zero_vectors"), (zero * 100.0 / n).alias("zero_pct"),
        F.avg("norm").alias("mean_norm"), F.stddev_pop("norm").alias("std_norm"),
        F.avg("nz").alias("mean_nonzero_dims"), (F.avg("nz") / dim).alias("utilisation"),
        (zero > n * 0.1).alias("many_zero_vectors"),
    )


def token_coverage(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """In-vocabulary share per emotion and overall; below 70 % is flagged."""
    per = tokens_long(df, "Emotion").groupBy("Emotion", "token").agg(F.count("*").alias("c"))
    hit = per.join(vocab.select("token", F.lit(True).alias("_in")), "token", "left")
    return (
        hit.select(F.explode(F.array("Emotion", F.lit("(all)"))).alias("Emotion"), "c", "_in")
        .groupBy("Emotion")
        .agg(F.coalesce(F.sum(F.when(F.col("_in"), F.col("c"))), F.lit(0)).alias("in_vocab"), F.sum("c").alias("total"))
        .withColumn("coverage", F.col("in_vocab") / F.greatest("total", F.lit(1)))
        .withColumn("low", F.col("coverage") < 0.7)
    )


def word_cosines(vectors: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Cosine of each word pair; null when a word has no vector."""
    words = sorted({w for p in pairs for w in p})
    # one row: the vectors of the listed words
    pick = vectors.filter(F.col("token").isin(*words)).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "vector"))).alias("m")
    )
    listed = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    rows = pick.select("m", F.explode(listed).alias("p")).select("p.a", "p.b", F.col("m")[F.col("p.a")].alias("va"), F.col("m")[F.col("p.b")].alias("vb"))
    return rows.select("a", "b", V.cosine(F.col("va"), F.col("vb")).alias("cosine"))


def nearest_words(vectors: DataFrame, probes: list[str], topn: int = 6) -> DataFrame:
    """The ``topn`` words most similar to each probe word. The probes travel as one array value."""
    picked = vectors.filter(F.col("token").isin(*probes)).agg(F.collect_list(F.struct("token", "vector")))
    paired = vectors.withColumn("_p", F.explode(picked.scalar())).filter(F.col("_p.token") != F.col("token"))
    sims = paired.select(F.col("_p.token").alias("probe"), "token", V.cosine(F.col("_p.vector"), F.col("vector")).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc(F.round("similarity", 9)), "token"))
    return sims.withColumn("rank", rank).filter(F.col("rank") <= topn)
