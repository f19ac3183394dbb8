"""Words that distinguish each emotion: by contrastive log-odds or by similarity to a centroid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions import text
from moodlens.functions import vectors as V
from moodlens.operators import embeddings

CLOUD_CAP = 180
TABLE_CAP = 60


def emotion_counts(df: DataFrame, min_df: int = 20, domain_stop: bool = True) -> DataFrame:
    """``Emotion, token, n`` of the qualifying tokens found in at least ``min_df`` reviews.

    Occurrences and reviews are counted in one pass: inside a review the sorted tokens mark where a
    word appears first. Reviews without a known emotion count towards document frequency only.
    """
    ok = F.sort_array(F.filter("tokens", lambda t: text.keyword_token_ok(t, domain_stop)))
    prev = F.concat(F.array(F.lit("")), F.col("_t"))
    marked = F.filter(
        F.zip_with("_t", prev, lambda t, p: F.struct(t.alias("token"), (t != p).cast("long").alias("first"))),
        lambda x: x["token"].isNotNull(),
    )
    flat = df.select("Emotion", ok.alias("_t")).select("Emotion", F.explode_outer(marked).alias("m"))
    flat = flat.filter(F.col("m").isNotNull())
    per = flat.groupBy("Emotion", F.col("m.token").alias("token")).agg(F.count("*").alias("n"), F.sum("m.first").alias("_d"))
    docs = F.sum("_d").over(Window.partitionBy("token"))  # at most one row per emotion
    return per.withColumn("_docs", docs).filter((F.col("_docs") >= min_df) & F.col("Emotion").isin(*lexicons.EMOTIONS)).select(
        "Emotion", "token", "n")


def emotion_vocabulary(counts: DataFrame) -> DataFrame:
    v = F.count("*")
    return counts.groupBy("Emotion").agg(
        v.alias("vocabulary"), F.sum("n").alias("tokens"),
        F.when(v < 50, "poor").when(v < 200, "moderate").otherwise("good").alias("tier"),
    )


def log_odds(counts: DataFrame, min_freq: int = 10) -> DataFrame:
    """``ln((c+1)/(N_in-c+1)) - ln((o+1)/(N_out-o+1))`` against the other emotions, +1 smoothed."""
    totals = counts.groupBy("Emotion").agg(F.sum("n").alias("n_in"))
    totals = totals.withColumn("n_out", F.sum("n_in").over(Window.partitionBy(F.lit(0))) - F.col("n_in"))
    everywhere = F.sum("n").over(Window.partitionBy("token"))
    c, o = F.col("n"), F.greatest(F.col("_all") - F.col("n"), F.lit(0))
    score = F.log((c + 1) / (F.col("n_in") - c + 1)) - F.log((o + 1) / (F.col("n_out") - o + 1))
    # totals has at most three rows
    return (
        counts.withColumn("_all", everywhere)
        .join(F.broadcast(totals), "Emotion")
        .filter((F.col("n") >= min_freq) & (F.col("n_in") > 0) & (F.col("n_out") > 0))
        .select("Emotion", "token", "n", score.alias("score"))
    )


def polarity_gate(scores: DataFrame, lexicon: DataFrame, positive: float = 0.5, negative: float = -0.5, neutral: float = 0.2) -> DataFrame:
    """Keep words whose valence suits their emotion; an emotion whose gate is empty is not gated."""
    v = F.col("valence")
    rules = {"Positive": v >= positive, "Negative": v <= negative, "Neutral": F.abs(v) <= neutral}
    # one row of three flags
    open_gate = lexicon.agg(*[F.coalesce(F.bool_or(r), F.lit(False)).alias(e) for e, r in rules.items()])
    flags = {e: open_gate.select(e).scalar() for e in rules}
    joined = scores.join(lexicon.select("token", "valence"), "token", "left")
    for e, rule in rules.items():
        joined = joined.withColumn(f"_{e}", flags[e])
        fits = F.coalesce(rule, F.lit(False))
        joined = joined.filter((F.col("Emotion") != e) | ~F.col(f"_{e}") | fits).drop(f"_{e}")
    return joined.drop("valence")


def centroids(counts: DataFrame, vectors: DataFrame, dim: int, weights: DataFrame | None = None) -> DataFrame:
    """Per emotion ``sum(w v) / (sum w + eps)``, w = count or count times SIF weight."""
    hits = counts.join(vectors.select("token", "vector"), "token")
    w = F.col("n")
    if weights is not None:
        hits = hits.join(weights.select("token", "weight"), "token", "left")
        w = F.col("n") * F.coalesce("weight", F.lit(1.0))
    sums = hits.groupBy("Emotion").agg(embeddings.weighted_sum("vector", w, dim).alias("_s"), F.sum(w).alias("_w"))
    return sums.select("Emotion", V.scale(F.col("_s"), 1 / (F.col("_w") + V.EPS)).alias("centroid"))


def candidates(counts: DataFrame, vectors: DataFrame, min_freq: int = 10, max_vocab: int | None = None,
               emotion_only: bool = True, domain_stop: bool = True) -> DataFrame:
    """Words to compare with the centroid: the most frequent ones of the emotion that have a vector,
    or every word with a vector that passes the keyword test. ``max_vocab`` keeps so many per emotion."""
    if emotion_only:
        pool = counts.filter(F.col("n") >= min_freq).join(vectors.select("token"), "token", "left_semi")
    else:
        words = vectors.select("token").filter(text.keyword_token_ok(F.col("token"), domain_stop))
        emotions = counts.agg(F.collect_set("Emotion")).scalar()  # at most three
        pool = words.withColumn("Emotion", F.explode(emotions)).join(counts, ["Emotion", "token"], "left").fillna(0, ["n"])
    if max_vocab is None:
        return pool
    rank = F.row_number().over(Window.partitionBy("Emotion").orderBy(F.desc("n"), "token"))
    return pool.withColumn("_r", rank).filter(F.col("_r") <= max_vocab).drop("_r")


def centroid_similarity(cands: DataFrame, vectors: DataFrame, centers: DataFrame) -> DataFrame:
    """Cosine of each candidate word to its emotion's centroid (one row per emotion)."""
    rows = cands.join(vectors.select("token", "vector"), "token").join(F.broadcast(centers), "Emotion")
    c = V.l2_normalise(F.col("centroid"))
    return rows.select("Emotion", "token", "n", (V.dot(F.col("vector"), c) / (V.norm(F.col("vector")) + V.EPS)).alias("score"))


def cloud(scores: DataFrame, cap: int = CLOUD_CAP) -> DataFrame:
    """Top words per emotion, weights shifted to be positive: ``Emotion, Word, Weight, Rank``."""
    rank = F.row_number().over(Window.partitionBy("Emotion").orderBy(F.desc(F.round("score", 9)), "token"))
    top = scores.withColumn("Rank", rank).filter(F.col("Rank") <= cap)
    low = F.min("score").over(Window.partitionBy("Emotion"))  # at most cap rows
    shifted = F.when(F.col("_low") < 0, F.col("score") - F.col("_low") + 0.001).otherwise(F.col("score"))
    return top.withColumn("_low", low).select("Emotion", F.col("token").alias("Word"), shifted.alias("Weight"), "Rank")


def render_weights(weights: DataFrame, hidden: list[str] | None = None) -> DataFrame:
    """What a word cloud shows: no hidden words, positive weights only."""
    words = lexicons.hidden_words() if hidden is None else hidden
    return weights.filter(~F.lower("Word").isin(*words) & (F.col("Weight") > 0))


def keyword_table(weights: DataFrame, k: int = TABLE_CAP) -> DataFrame:
    return weights.filter(F.col("Rank") <= k).select("Emotion", "Rank", "Word", "Weight")


# --- analysis of the table (at most k rows per emotion) ----------------------------------------------


def table_stats(table: DataFrame) -> DataFrame:
    n, u = F.count("*"), F.countDistinct("Word")
    return table.agg(n.alias("total_words"), F.avg("Weight").alias("mean_weight"), u.alias("unique_words"),
                     ((1 - u / n) * 100).alias("overlap_pct"))


def word_emotions(table: DataFrame) -> DataFrame:
    return table.groupBy("Word").agg(F.count("*").alias("n_emotions"), F.sort_array(F.collect_set("Emotion")).alias("emotions"))


def overlapping_words(table: DataFrame, k: int = 20) -> DataFrame:
    return word_emotions(table).filter(F.col("n_emotions") > 1).orderBy(F.desc("n_emotions"), "Word").limit(k)


def discriminative_words(table: DataFrame, k: int = 5) -> DataFrame:
    """The k best ranked words per emotion that no other emotion has."""
    only = table.withColumn("_c", F.count("*").over(Window.partitionBy("Word"))).filter(F.col("_c") == 1)
    place = F.row_number().over(Window.partitionBy("Emotion").orderBy("Rank"))
    return only.withColumn("place", place).filter(F.col("place") <= k).select("Emotion", "place", "Word")


def quality_checks(table: DataFrame, weights: DataFrame) -> DataFrame:
    """Diversity, balance and overlap verdicts, and recommendations."""
    per = table.groupBy("Emotion").agg(F.count("*").alias("n"))
    sizes = per.agg((F.min("n") / F.max("n")).alias("balance")).scalar()
    cloud_sizes = weights.groupBy("Emotion").agg(F.count("*").alias("n"))
    large = F.coalesce(F.count_if(F.col("n") >= 20), F.lit(0))
    expected = F.countDistinct("Emotion")
    small = cloud_sizes.agg((expected - large).alias("n")).scalar()
    u, n = F.col("unique_words"), F.col("total_words")
    base = table_stats(table).withColumn("balance", sizes).withColumn("small_clouds", small)
    base = base.withColumn("overlap_rate", (n - u) / n)
    return base.select(
        "unique_words", "balance", "overlap_rate", "small_clouds",
        F.when(u > 100, "good").when(u > 50, "moderate").otherwise("low").alias("diversity"),
        F.when(F.col("balance") > 0.7, "good").when(F.col("balance") > 0.4, "moderate").otherwise("low").alias("balance_tier"),
        F.when(F.col("overlap_rate") < 0.2, "low").when(F.col("overlap_rate") < 0.4, "moderate").otherwise("high").alias("overlap_tier"),
        F.array_compact(F.array(
            F.when(u < 50, "reduce filtering"), F.when(u < 50, "check preprocessing"),
            F.when(F.col("overlap_rate") > 0.4, "try another method"),
            F.when(F.col("overlap_rate") > 0.4, "raise frequency thresholds"),
            F.when(F.col("small_clouds") > 0, "check class balance"),
            F.when(F.col("small_clouds") > 0, "verify preprocessing"),
        )).alias("recommendations"),
    )
