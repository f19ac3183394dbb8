"""Vocabulary tables and joins of tokens with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions.stemming import stem_words
from moodlens.operators import embeddings, joins
from moodlens.operators.cleaning import tokens_long


def word_table(spark: SparkSession, words, column: str = "token") -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], f"{column} string")


def stopword_table(spark: SparkSession, words: DataFrame | None = None) -> DataFrame:
    """Stop list minus sentiment words and negators; ``words`` is a user's list instead of the default."""
    source = word_table(spark, lexicons.STOPWORDS) if words is None else words.select("token")
    return source.distinct().exceptAll(word_table(spark, lexicons.PROTECTED_WORDS))


def drop_listed(tokens: DataFrame, words: DataFrame, spread_by: str = "review_id") -> DataFrame:
    """Anti join for stop lists too long for an expression."""
    return joins.token_lookup(tokens, words.select("token").distinct(), "token", F.col(spread_by), "left_anti")


def keep_listed(tokens: DataFrame, words: DataFrame, spread_by: str = "review_id") -> DataFrame:
    return joins.token_lookup(tokens, words.select("token").distinct(), "token", F.col(spread_by), "left_semi")


def lemmatise(df: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace tokens by their lemma from a user's ``token, lemma`` table; protected words stay.

    Reviews without tokens keep an empty array.
    """
    long = tokens_long(df, "review_id")
    usable = lemmas.filter(~F.col("token").isin(*lexicons.PROTECTED_WORDS)).select("token", "lemma").dropDuplicates(["token"])
    joined = joins.token_lookup(long, usable, "token", F.col("review_id"), "left")
    again = joined.groupBy("review_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("lemma", "token").alias("t")))).alias("s")
    )
    none = F.array().cast("array<string>")
    found = again.select("review_id", F.transform("s", lambda x: x["t"]).alias("tokens"))
    return df.select("review_id").join(found, "review_id", "left").select("review_id", F.coalesce("tokens", none).alias("tokens"))


def stem_tokens(df: DataFrame) -> DataFrame:
    """Stem every token except protected words; no shuffle."""
    return df.withColumn("tokens", stem_words("tokens"))


def reduce_words(df: DataFrame, lemmas: DataFrame | None = None, stem: bool = False) -> DataFrame:
    """``df`` with its ``tokens`` lemmatised, then stemmed, as asked for; ``n_tokens`` and ``clean_text`` follow where present.

    Lemmas need a unique ``review_id``; a table without one of them is left as it is by ``stem`` alone.
    """
    out = df
    if lemmas is not None:
        out = out.drop("tokens").join(lemmatise(df.select("review_id", "tokens"), lemmas), "review_id")
    if stem:
        out = stem_tokens(out)
    if "n_tokens" in df.columns:
        out = out.withColumn("n_tokens", F.size("tokens"))
    if "clean_text" in df.columns:
        out = out.withColumn("clean_text", F.array_join("tokens", " "))
    return out


def stem_vocabulary(freq: DataFrame) -> DataFrame:
    """Each distinct token with its stem and count."""
    return freq.withColumn("stem", F.element_at(stem_words(F.array("token")), 1))


def label_codes(counts: DataFrame, label: str = "Emotion") -> DataFrame:
    """Alphabetical integer codes; ``counts`` has one row per class."""
    return counts.withColumn("label", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(label)) - 1)


def in_vocabulary_counts(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens per review and how many of them are in the vocabulary."""
    hit = embeddings.lookup_tokens(df, vocab.select("token", F.lit(1).alias("_in")), "left")
    return hit.groupBy("review_id").agg(
        F.sum("c").alias("n_all"), F.sum(F.when(F.col("_in").isNotNull(), F.col("c")).otherwise(0)).alias("n_in_vocab")
    )


def text_stats(df: DataFrame, vocab: DataFrame) -> DataFrame:
    counts = in_vocabulary_counts(df, vocab).select("review_id", "n_in_vocab")
    out = df.select("review_id", F.col("n_tokens").alias("words"), F.length("clean_text").alias("chars")).join(counts, "review_id", "left")
    out = out.withColumn("n_in_vocab", F.coalesce("n_in_vocab", F.lit(0)))
    out = out.withColumn("coverage", F.col("n_in_vocab") / F.nullif("words", F.lit(0)))
    tier = F.when(F.col("coverage") < 0.3, "very low").when(F.col("coverage") < 0.5, "moderate").otherwise("good")
    return out.withColumn("tier", tier)


def probe(freq: DataFrame, words=lexicons.PROBE_WORDS) -> DataFrame:
    """Which of the probe words are in the vocabulary, and how often they occur."""
    spark = freq.sparkSession
    listed = word_table(spark, words)
    hits = freq.filter(F.col("token").isin(*words))
    return listed.join(hits, "token", "left").select(
        "token", F.col("n").isNotNull().alias("found"), F.coalesce("n", F.lit(0)).alias("n")
    )
