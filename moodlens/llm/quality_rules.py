"""Quality rules: counting rules and a hashed n-gram log-likelihood ratio, with column functions only.

The ratio compares two multinomials over hashed word unigrams and bigrams: one of trusted target documents,
one of the whole raw corpus. A document's score is the mean log ratio of its n-grams, so its length does not
matter, and a fixed threshold decides every document. The target of labelled documents is smoothed by the raw
distribution: ``PRIOR`` n-grams dealt out as the raw corpus has them stand beside the counted ones. So ratios of few
labels stay near 0 and keep documents; without labels every ratio is 0 and only the counting rules reject.

All good labels count, however many there are: their ids meet the documents in a shuffle join. Besides that, only
bucket counts are shuffled: a row of ``BUCKETS`` sums for each task. The ratios reach the rows as one bounded
array, by a scalar subquery.

Null texts have no words. Rows are judged one by one, so repeated rows and ties give repeated results, and
further columns of the input pass through untouched. A text without n-grams scores 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.common import SPACES, pieces, whole

#: Hash buckets of the multinomials.
BUCKETS = 32_768
#: Added to every bucket's count.
SMOOTHING = 1.0
#: N-grams of the raw distribution that the counts of labelled documents are smoothed by.
PRIOR = 300_000.0
#: Mean log ratio below which a document is rejected.
THRESHOLD = -0.07
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _doubled(hashes: Column, step: int) -> Column:
    """Hashes of each two stretches that start ``step`` words apart."""
    left = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, left), F.slice(hashes, step + 1, left), lambda a, b: F.xxhash64(a, b))


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id, quality`` of all documents labelled good."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING, prior: float = PRIOR) -> DataFrame:
    """One row with ``ratios``: log p(bucket | trusted) - log p(bucket | raw), an array of ``buckets`` doubles.

    ``trusted`` holds the distinct ids of the target documents and may be of any size. Ids with their ``quality``, as
    ``trusted_ids`` gives them, are a sample of the target, which may be thin or empty: ``prior`` raw n-grams smooth it. Ids alone are the target as it stands, with ``smoothing`` added to each bucket as on the raw side.
    """
    sampled = "quality" in trusted.columns
    mark = trusted.select(F.col("doc_id").alias("_trusted_id"), F.lit(0).cast("long").alias("_trusted_deal")).hint("shuffle_hash")
    # null ids meet nothing and are dealt out by their text, so that they do not go to one task
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(0).alias("_deal")
    marked = docs.select("doc_id", "text", deal).join(mark, (F.col("doc_id") == F.col("_trusted_id")) & (F.col("_deal") == F.col("_trusted_deal")), "left")
    hashed = marked.withColumn("_wh", _hashes(pieces(whole(F.col("text")), SPACES)))
    grams = hashed.select(F.col("_trusted_id").isNotNull().cast("long").alias("in_target"), F.explode(F.concat("_wh", _doubled(F.col("_wh"), 1))).alias("gram"))
    # buckets are taken of the exploded rows, in generated code
    sums = grams.withColumn("bucket", _bucket(F.col("gram"), buckets)).groupBy("bucket").agg(F.sum("in_target").alias("target"), F.count("*").alias("raw"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(sums, "bucket", "left").select("bucket", F.coalesce("target", F.lit(0)).alias("target"), F.coalesce("raw", F.lit(0)).alias("raw"))
    one = full.agg(
        F.sum("target").alias("n_target"), F.sum("raw").alias("n_raw"),
        F.array_sort(F.collect_list(F.struct("bucket", "target", "raw"))).alias("cells"),
    )

    def share(count: Column, total: Column) -> Column:
        return (count + F.lit(smoothing)) / (total + F.lit(smoothing * buckets))

    def ratio(c: Column) -> Column:
        raw = share(c["raw"], F.col("n_raw"))
        if not sampled:
            return F.log(share(c["target"], F.col("n_target"))) - F.log(raw)
        return F.log((c["target"] / raw + F.lit(prior)) / (F.col("n_target") + F.lit(prior)))

    return one.select(F.transform("cells", ratio).alias("ratios"))


def with_repeats(df: DataFrame, words: str, out: str, window: int = WINDOW) -> DataFrame:
    """Add ``out``: the words inside windows of ``window`` words that are found twice or more in the text.

    Window hashes tell texts without repeats; only the others compare the windows themselves. The hashes of the words
    and of all two consecutive ones stay as ``_wh`` and ``_bh``.
    """
    w, n = F.col(words), F.size(words) - window
    starts = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_wh", _hashes(w))
    df = df.withColumn("_bh", _doubled(F.col("_wh"), 1))
    df = df.withColumn("_hw", F.col("_bh" if window > 1 else "_wh"))
    width = min(window, 2)
    while width < window:  # hashes of stretches twice as long, the last ones overlapping
        step = min(width, window - width)
        df = df.withColumn("_hw", _doubled(F.col("_hw"), step))
        width += step
    repeats = F.size(F.array_distinct("_hw")) < F.size("_hw")
    sorted_windows = F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(w, i + 1, window), " ").alias("w"), i.alias("i"))))
    df = df.withColumn("_sw", F.when(repeats, sorted_windows))
    twice = F.filter("_sw", lambda x, j: (F.get("_sw", j - 1)["w"] == x["w"]) | (F.get("_sw", j + 1)["w"] == x["w"]))
    df = df.withColumn("_rp", F.array_sort(F.transform(twice, lambda x: x["i"])))
    spans = F.transform("_rp", lambda p, k: F.least(F.lit(window), F.coalesce(F.get("_rp", k + 1) - p, F.lit(window))))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return df.withColumn(out, F.coalesce(total, F.lit(0).cast("long"))).drop("_hw", "_sw", "_rp")


def judge(docs: DataFrame, ratios: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept``.

    Input columns of these names are replaced. Store the result before filtering on its columns: the optimizer
    pushes filters below a projection and would repeat its work.
    """
    text = whole(F.col("text"))
    df = docs.withColumn("_words", pieces(text, SPACES))
    df = with_repeats(df, "_words", "n_repeat_words")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.when(text.rlike(SYMBOLS), F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))).otherwise(0)
    df = df.withColumn("_lines", lines).withColumn("_f", F.concat("_wh", "_bh"))
    # used once, so the optimizer reads the subquery's one value in place and copies no array into the rows
    df = df.withColumn("_ratios", ratios.select("ratios").scalar())
    mean = F.aggregate("_f", F.lit(0.0), lambda a, gram: a + F.get("_ratios", _bucket(gram, buckets))) / F.size("_f")
    n_words = F.size("_words").cast("long")
    df = df.withColumns({
        "n_words": n_words,
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "score": F.when(F.size("_f") > 0, mean).otherwise(0.0),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    return df.drop("_words", "_wh", "_bh", "_lines", "_f", "_ratios")
