"""Corpus diagnostics on the cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions import text
from moodlens.operators.cleaning import tokens_long


def length_counts(df: DataFrame) -> DataFrame:
    """Reviews per token count. Later steps work on this small table, not on the rows."""
    return df.groupBy("n_tokens").agg(F.count("*").alias("n"))


def _quantile(p) -> Column:
    return F.percentile("n_tokens", p, F.col("n"))


def text_length_stats(df: DataFrame) -> DataFrame:
    per = df.groupBy("Emotion", "n_tokens").agg(F.count("*").alias("n"))
    return per.agg(
        F.sum("n").alias("n_rows"),
        (F.sum(F.col("n_tokens") * F.col("n")) / F.sum("n")).alias("mean_tokens"),
        _quantile(F.lit(0.5)).alias("median_tokens"),
        F.countDistinct("Emotion").alias("n_emotions"),
    )


def corpus_shape(df: DataFrame) -> DataFrame:
    per = df.groupBy("n_tokens").agg(
        F.count("*").alias("n"), F.count("clean_text").alias("t"), F.count("Emotion").alias("e")
    )
    return per.agg(
        F.sum("n").alias("n_rows"),
        F.sum("t").alias("non_null_text"),
        F.sum("e").alias("non_null_emotion"),
        F.floor(_quantile(F.lit(0.5))).cast("long").alias("median_tokens"),
        (F.sum(F.col("n_tokens") * F.col("n")) / F.sum("n")).alias("mean_tokens"),
        F.max("n_tokens").cast("long").alias("max_tokens"),
    )


def length_quantiles(df: DataFrame, points: tuple[float, ...] = (0.1, 0.5, 0.9, 0.99)) -> DataFrame:
    """Exact quantiles with linear interpolation."""
    values = length_counts(df).agg(_quantile(F.array(*[F.lit(p) for p in points])).alias("v"))
    return values.select(F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in points]).alias("q"), "v")).alias("z")).select(
        F.col("z.q").alias("quantile"), F.col("z.v").alias("tokens")
    )


def length_histogram(df: DataFrame) -> DataFrame:
    """Equal-width bins between the shortest and the longest review: ten to eighty of them."""
    span = Window.partitionBy(F.lit(0))  # one row per distinct length
    hi = F.max("n_tokens").over(span)
    sized = length_counts(df).select(
        "n_tokens", "n", F.min("n_tokens").over(span).cast("double").alias("lo"), hi.cast("double").alias("hi"),
        F.least(F.lit(80), F.greatest(F.lit(10), hi)).cast("long").alias("bins"),
    )
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.col("bins")).otherwise(1.0 / F.col("bins"))
    return (
        sized.withColumn("width", width)
        .withColumn("bin", F.least(F.floor((F.col("n_tokens") - F.col("lo")) / F.col("width")), F.col("bins") - 1).cast("long"))
        .groupBy("bin")
        .agg(F.min(F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"), F.sum("n").alias("n"))
    )


def token_freq(df: DataFrame) -> DataFrame:
    return tokens_long(df).groupBy("token").agg(F.count("*").alias("n"))


def emotion_token_freq(df: DataFrame) -> DataFrame:
    return tokens_long(df, "Emotion").groupBy("Emotion", "token").agg(F.count("*").alias("n"))


def lexical_richness(freq: DataFrame) -> DataFrame:
    v, n = F.count("*"), F.sum("n")
    ttr = v / n
    return freq.agg(
        v.alias("vocabulary"),
        n.alias("tokens"),
        ttr.alias("ttr"),
        (F.log(v + 1) / F.log(n + 1)).alias("herdan_c"),
        (F.count_if(F.col("n") == 1) / F.greatest(v, F.lit(1))).alias("hapax_share"),
        F.when(ttr < 0.1, "low").when(ttr < 0.3, "moderate").otherwise("high").alias("tier"),
    )


def top_tokens(freq: DataFrame, k: int = 20) -> DataFrame:
    return freq.orderBy(F.desc("n"), "token").limit(k)


def top_tokens_per_emotion(freq: DataFrame, k: int = 15) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("Emotion").orderBy(F.desc("n"), "token"))
    return freq.withColumn("rank", rank).filter(F.col("rank") <= k)


def _term_counts(df: DataFrame) -> DataFrame:
    """``review_id, token, tf``, counted inside each review: sorted tokens are runs of equal ones."""
    tokens = F.sort_array(text.scikit_tokens(F.coalesce("clean_text", F.lit(""))))
    runs = df.select("review_id", tokens.alias("_t")).withColumn(
        "_first", F.filter(F.sequence(F.lit(0), F.size("_t") - 1), lambda i: (i == 0) | (F.get("_t", i) != F.get("_t", i - 1)))
    ).filter(F.size("_t") > 0)
    ends = F.concat(F.slice("_first", 2, F.size("_first")), F.array(F.size("_t")))
    pairs = F.zip_with("_first", ends, lambda a, b: F.struct(F.get("_t", a).alias("token"), (b - a).cast("long").alias("tf")))
    return runs.select("review_id", F.explode(pairs).alias("p")).select("review_id", "p.token", "p.tf")


def mean_tfidf(df: DataFrame, max_features: int | None = None) -> DataFrame:
    """Mean TF-IDF weight per token over all reviews.

    Smooth idf, raw term frequency, rows scaled to unit length. ``max_features`` keeps only so many of the most
    frequent tokens; by default all count.
    """
    tf = _term_counts(df)
    n_docs = df.agg(F.count("*")).scalar()
    vocab = tf.groupBy("token").agg(F.sum("tf").alias("n"), F.count("*").alias("n_docs"))
    if max_features is not None:
        vocab = vocab.orderBy(F.desc("n"), "token").limit(max_features)
    vocab = vocab.select("token", "n_docs").withColumn("total", n_docs).select(
        "token", "total", (F.log((1 + F.col("total")) / (1 + F.col("n_docs"))) + 1).alias("idf")
    )
    # only a limited vocabulary has a bounded size
    weighted = tf.join(vocab if max_features is None else F.broadcast(vocab), "token").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("review_id")))
    return weighted.withColumn("w", F.col("w") / norm).groupBy("token").agg(
        (F.sum("w") / F.max("total")).alias("mean_tfidf")
    )


def top_tfidf(df: DataFrame, k: int = 20, max_features: int | None = None) -> DataFrame:
    return mean_tfidf(df, max_features).orderBy(F.desc(F.round("mean_tfidf", 9)), "token").limit(k)


def diagnostic_summary(df: DataFrame, threshold: int = 2) -> DataFrame:
    """One row with the figures behind the verdict and the list of issues found."""
    n_rows = F.col("n_rows")
    texts = df.groupBy(text.row_key("clean_text")).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate")
    )
    per = df.groupBy("Emotion").agg(
        F.count("*").alias("n"), F.count("clean_text").alias("t"), F.count_if(F.col("n_tokens") <= threshold).alias("s")
    )
    ratio = F.max(F.when(F.col("Emotion").isNotNull(), F.col("n"))) / F.min(F.when(F.col("Emotion").isNotNull(), F.col("n")))
    base = per.agg(
        F.sum("n").alias("n_rows"),
        (F.sum("n") - F.sum("t")).alias("missing_text"),
        F.coalesce(F.sum(F.when(F.col("Emotion").isNull(), F.col("n"))), F.lit(0)).alias("missing_emotion"),
        F.sum("s").alias("n_short"),
        ratio.alias("imbalance_ratio"),
    ).withColumn("n_duplicate", texts.scalar())
    return base.withColumn(
        "issues",
        F.array_compact(F.array(
            F.when(F.col("missing_text") > 0, "missing text"),
            F.when(F.col("missing_emotion") > 0, "missing emotion"),
            F.when(F.col("n_short") > n_rows * 0.1, "many short reviews"),
            F.when(F.col("imbalance_ratio") > 10, "severe class imbalance"),
            F.when(F.col("n_duplicate") > n_rows * 0.05, "many duplicates"),
        )),
    )


def document_frequency(df: DataFrame, domain_stop: bool = True) -> DataFrame:
    """Reviews per qualifying token."""
    ok = F.filter("tokens", lambda t: text.keyword_token_ok(t, domain_stop))
    return (
        df.select(F.explode_outer(F.array_distinct(ok)).alias("token"))
        .filter(F.col("token").isNotNull())
        .groupBy("token").agg(F.count("*").alias("n_docs"))
    )


def preserved_words(df: DataFrame) -> DataFrame:
    """Which sentiment words and negators still occur (as substrings) after cleaning."""
    words = [(w, "sentiment") for w in lexicons.SENTIMENT_WORDS] + [(w, "negator") for w in lexicons.NEGATORS]
    hits = df.agg(*[F.bool_or(F.contains("clean_text", F.lit(w))).alias(f"w{i}") for i, (w, _) in enumerate(words)])
    rows = F.array(*[
        F.struct(F.lit(w).alias("word"), F.lit(kind).alias("kind"), F.coalesce(F.col(f"w{i}"), F.lit(False)).alias("found"))
        for i, (w, kind) in enumerate(words)
    ])
    return hits.select(F.explode(rows).alias("r")).select("r.*")


def lexicon_indicators(df: DataFrame) -> DataFrame:
    """Sentiment indicator words per category, their totals and the verdict."""
    out = df.withColumn("_low", F.lower("clean_text"))
    groups = {"positive": lexicons.POSITIVE_INDICATORS, "negative": lexicons.NEGATIVE_INDICATORS}
    for side, cats in groups.items():
        for cat, words in cats.items():
            out = out.withColumn(f"{side}_{cat}", text.found_words(F.col("_low"), words))
        total = sum((F.size(f"{side}_{c}") for c in cats), F.lit(0))
        out = out.withColumn(f"n_{side}", total)
    pos, neg = F.col("n_positive"), F.col("n_negative")
    verdict = (
        F.when((pos == 0) & (neg == 0), "neutral").when(pos > neg, "positive").when(neg > pos, "negative").otherwise("mixed")
    )
    return out.withColumn("verdict", verdict).drop("_low")
