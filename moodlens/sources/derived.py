"""Review-shaped tables that Spark derives from the driver's tables.

The given documents carry no stars, dates, apostrophes or English sentiment words, so every row gets
a phrase that depends on its class. Whole texts are kept, and every row of ``documents`` is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.functions import labels, text
from moodlens.sources import reviews as src

PHRASES = {
    "Negative": (
        "I don't love it, terrible taste and 3 broken bags.",
        "Worst <b>coffee</b> ever, can't drink it!",
        "It ain't good, price was awful. Won't buy again_ever",
        "Disappointing quality; wasn't fresh. Horrible packaging.",
    ),
    "Neutral": (
        "It's okay. Package arrived in 5 days.",
        "Standard delivery, y'all. Gonna reorder maybe.",
        "Average texture. Dos and don'ts on the label.",
        "The price is fair. I don’t mind it",
    ),
    "Positive": (
        "Great taste, delicious! I love this tea.",
        "Excellent quality <br/> wouldn't change a thing",
        "Amazing aroma. I wanna buy 2 more.",
        "Perfect service. Café crème was wonderful",
    ),
    "None": (
        "Shouldn't be rated. good bad",
        "no score 10/10",
        "Never seen. Couldn't say",
        "a I 1 ?",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_id, Score, Summary, Text, Time``: one row per document."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = src.spread_small_input(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    marks = table(spark, sf_dir, "labels")
    k = F.pmod(F.floor(F.col("doc_id") / 2).cast("long"), F.lit(4)).cast("int") + 1
    cls = (
        F.when(F.col("toxic") == 1, "Negative")
        .when(F.col("quality") == 0, "Neutral")
        .when(F.col("quality") == 1, "Positive")
        .otherwise("None")
    )
    odd = F.pmod(F.col("doc_id"), F.lit(2))
    score = (
        F.when(F.col("toxic") == 1, 1 + odd).when(F.col("quality") == 0, F.lit(3)).when(F.col("quality") == 1, 4 + odd)
    )
    phrase = F.coalesce(*[
        F.when(F.col("cls") == c, F.element_at(F.array(*[F.lit(p) for p in ps]), k)) for c, ps in PHRASES.items()
    ])
    slot = F.pmod(F.col("doc_id"), F.lit(50))
    summary = (
        F.when(slot == 0, F.lit(None).cast("string"))
        .when(slot == 1, "   ")
        .when(slot == 2, "a I 1 ?")
        .when(slot == 3, "Good tea!")
        .otherwise(F.concat("text", F.lit(" "), "phrase"))
    )
    epoch = F.lit(1199145600) + F.pmod(F.col("doc_id") * 7919, F.lit(1826)) * 86400
    return (
        docs.join(marks, "doc_id", "left")
        .withColumn("cls", cls)
        .withColumn("phrase", phrase)
        .select(
            F.col("doc_id").alias("review_id"),
            score.cast("long").alias("Score"),
            summary.alias("Summary"),
            F.concat("phrase", F.lit(" "), "text").alias("Text"),
            F.timestamp_seconds(epoch).alias("Time"),
        )
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews as they would arrive in a text file: scores and times are strings, some unusable."""
    odd = F.pmod(F.col("review_id"), F.lit(16))
    variants = {
        1: "4.0", 2: "3.5", 3: "abc", 4: "", 5: "nan", 6: "inf", 7: "4d", 8: "-1", 9: "9", 10: " 2 ", 11: "1e0",
    }
    score = F.col("Score").cast("string")
    for slot, value in variants.items():
        score = F.when(odd == slot, value).otherwise(score)
    epoch = F.col("Time").cast("long").cast("string")
    time = F.when(odd == 5, "x").when(odd == 6, F.lit(None).cast("string")).otherwise(epoch)
    return reviews(spark, sf_dir).select(
        "review_id", score.alias("Score"), "Summary", "Text", time.alias("Time")
    )


def probabilities(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """Three class probabilities per labelled document: ``review_id, label, probability``.

    Class 0 is Negative, 1 Neutral, 2 Positive. ``second`` is another model's opinion.
    """
    m, off = ((41, 59, 83), (7, 17, 31)) if second else ((37, 53, 71), (11, 29, 5))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    marks = table(spark, sf_dir, "labels")
    label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    df = docs.join(marks, "doc_id").select("doc_id", label.alias("label"))
    for c in range(3):
        bonus = F.when((F.col("label") == c) & (F.pmod(F.col("doc_id"), F.lit(3)) != 0), 60).otherwise(0)
        df = df.withColumn(f"r{c}", 1 + F.pmod(F.col("doc_id") * m[c] + off[c], F.lit(97)) + bonus)
    total = F.col("r0") + F.col("r1") + F.col("r2")
    return df.select(
        F.col("doc_id").alias("review_id"),
        "label",
        F.array(*[F.col(f"r{c}").cast("double") / total for c in range(3)]).alias("probability"),
    )


def fixture_vectors(token_freq: DataFrame, dim: int = 8, min_count: int = 2) -> DataFrame:
    """Deterministic word vectors ``token, vector`` for every token seen at least ``min_count`` times."""
    part = lambda i: F.conv(F.substring(F.md5(F.concat("token", F.lit(f":{i}"))), 1, 6), 16, 10)
    comps = [part(i).cast("long") / F.lit(16777215.0) * 2 - 1 for i in range(dim)]
    return token_freq.filter(F.col("n") >= min_count).select("token", F.array(*comps).alias("vector"))


def fixture_polarity(token_freq: DataFrame) -> DataFrame:
    """A valence in [-4, 4] for every corpus token, on a grid that meets the gate limits exactly."""
    h = F.conv(F.substring(F.md5(F.concat("token", F.lit(":valence"))), 1, 4), 16, 10).cast("long")
    return token_freq.select("token", (F.pmod(h, F.lit(81)).cast("double") / 10 - 4).alias("valence"))


def fixture_lemmas(token_freq: DataFrame) -> DataFrame:
    """A lemma for every corpus token that ends in s (its singular), protected words included."""
    return token_freq.filter(F.col("token").rlike("^[a-z]{3,}s$")).select(
        "token", F.expr("substring(token, 1, length(token) - 1)").alias("lemma")
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction log: one row per labelled document, one minute apart."""
    names = F.array(F.lit("Negative"), F.lit("Neutral"), F.lit("Positive"))
    probs = probabilities(spark, sf_dir)
    texts = reviews(spark, sf_dir).select("review_id", "Text")
    shown = F.when(F.length("Text") > 50, text.preview(F.col("Text"), 50)).otherwise(F.col("Text"))
    best = F.array_max("probability")
    return probs.join(texts, "review_id").select(
        "review_id",
        shown.alias("text"),
        F.element_at(names, F.array_position("probability", best).cast("int")).alias("prediction"),
        best.alias("confidence"),
        F.when(F.pmod("review_id", F.lit(2)) == 0, "Random Forest").otherwise("Boosting").alias("model"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("review_id") * 60).alias("timestamp"),
        F.size(text.clean_tokens(F.col("Text"))).alias("word_count"),
        (F.pmod("review_id", F.lit(11)) / F.lit(10.0)).alias("vocab_coverage"),
    )


def emotion_of(score):
    return labels.emotion_mapped(score)
