"""Benchmark passages in documents, by a positional inverted index; column functions only.

The index stores postings (term, document, position and the words around it) of the terms that decide a search:
the two rarest of every window, by their counts over the whole corpus. A search takes the list of the rarest
term, shifts it by the term's offset in the window, and intersects it with the shifted list of the second. What
is left is compared word by word with the stored surroundings. With a slop, shifted lists may differ by so many
words: such a proximity match is no exact match.

Documents are never shuffled, only postings of rare terms and one row per document. The search table is broadcast
while its counted rows stay under ``BROADCAST_WINDOWS``; beyond that it is joined by shuffles.

Null texts have no words. A document is told from others by its id and a hash of its text, so repeated rows get
equal results each, and null ids are kept. An empty benchmark finds nothing. Further columns pass through
:func:`mark` unless they are named like its results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.common import ascii_lower, pieces, stored, whole

WINDOW = 10
#: Rows of the search table (about 200 bytes each) up to which it is sent to every executor.
BROADCAST_WINDOWS = 50_000
#: Letters of both cases count as word characters here; words are put in lower case one by one. Every character is
#: named, as Java looks single ones up in one table but tries ranges one after another.
SEPARATORS = "[" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOC = ["doc_id", "text_key"]


def _cased_words(text: Column) -> Column:
    return pieces(whole(text), SEPARATORS)


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(item_id, phrase, length)``: every window of every item, its words joined by spaces."""
    items = benchmark.select("item_id", pieces(ascii_lower(whole(F.col("text"))), SEPARATORS).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - size, F.lit(0))
    at = items.select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    cut = F.slice("w", F.col("i") + 1, size)
    return at.select("item_id", F.array_join(cut, " ").alias("phrase"), F.size(cut).alias("length")).distinct()


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_WINDOWS else df


def _exploded(docs: DataFrame, *more: Column) -> DataFrame:
    """One row for each word, with its position; the document's words stay at hand for ``more``."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), _cased_words(F.col("text")).alias("words"))
    return words.select(*DOC, "words", F.posexplode("words").alias("pos", "word")).select(*DOC, "words", "pos", ascii_lower(F.col("word")).alias("term"), *more)


def search_terms(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(phrase, length, rank, term, offset)``: the rarest (rank 1) and second rarest term of each phrase.

    Counts cover all documents. Ties go to the smaller term, then to the smaller offset.
    """
    terms = phrases.select("phrase", "length", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    vocabulary = terms.select("term").distinct()
    found = _exploded(docs).join(_small(vocabulary, phrases.count()), "term").groupBy("term").agg(F.count("*").alias("n"))
    counted = terms.join(found, "term", "left").groupBy("phrase", "length").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset"))).alias("t")
    )
    two = counted.select("phrase", "length", F.posexplode(F.slice("t", 1, 2)).alias("k", "x"))
    return two.select("phrase", "length", (F.col("k") + 1).alias("rank"), "x.term", "x.offset")


def build_index(docs: DataFrame, search: DataFrame, reach: int = WINDOW) -> DataFrame:
    """Postings of the searched terms: ``(term, doc_id, text_key, pos, before, around)``.

    ``around`` holds the words from ``before`` words ahead of the posting to ``reach - 1`` behind it.
    """
    terms = search.select("term").distinct()
    before = F.least(F.col("pos"), F.lit(reach - 1))
    hit = _exploded(docs, before.alias("before")).join(_small(terms, search.count()), "term")
    around = F.slice("words", F.col("pos") - F.col("before") + 1, F.col("before") + reach)
    return hit.select("term", *DOC, "pos", "before", around.alias("around"))


def matches(index: DataFrame, search: DataFrame, slop: int = 0) -> DataFrame:
    """``(doc_id, text_key, phrase, length, start, exact)``: where phrases stand in documents.

    With ``slop`` also places where the two rarest terms are up to so many words from their places.
    """
    rows = search.count()

    def lists(rank: int, *cols: str) -> DataFrame:
        side = _small(search.where(F.col("rank") == rank), rows)
        return index.join(side, "term").select(*DOC, "phrase", "length", "offset", (F.col("pos") - F.col("offset")).alias("start"), *cols)

    cut = F.slice("around", F.col("before") - F.col("offset") + 1, F.col("length"))
    same = (F.col("offset") <= F.col("before")) & (ascii_lower(F.array_join(cut, " ")) == F.col("phrase"))
    first = lists(1, "before", "around").select(
        *DOC, "phrase", "length", "start", F.when(F.col("offset") <= F.col("before"), same).otherwise(False).alias("exact")
    )
    if slop == 0:
        first = first.where(F.col("start") >= 0)
    wide = slop + 1
    second = lists(2).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("phrase").alias("_phrase"), F.col("start").alias("_start")
    )
    if slop:  # neighbouring bins, so that each posting meets a bounded number of others
        first = first.withColumn("bin", F.explode(F.array(*[F.floor(F.col("start") / wide) + k for k in (-1, 0, 1)])))
        second = second.withColumn("_bin", F.floor(F.col("_start") / wide))
    else:
        first, second = first.withColumn("bin", F.col("start")), second.withColumn("_bin", F.col("_start"))
    on = (
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")) & (F.col("phrase") == F.col("_phrase"))
        & (F.col("bin") == F.col("_bin")) & (F.abs(F.col("start") - F.col("_start")) <= slop)
    )
    both = first.where("length > 1").join(second, on, "left_semi")
    alone = first.where("length = 1")
    return both.unionByName(alone).drop("bin").distinct()


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(doc_id, text_key, n_hit, items)`` of the documents with an exact match; ``items`` sorted as strings."""
    items = stored(windows(benchmark, size), "windows")
    phrases = items.select("phrase", "length").distinct()
    search = stored(search_terms(docs, phrases), "search")
    index = stored(build_index(docs, search, size), "postings")
    exact = stored(matches(index, search).where("exact").select(*DOC, "phrase", "length", "start"), "matches")
    places = F.collect_set(F.struct("start", "length"))
    covered = F.array_distinct(F.flatten(F.transform(places, lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))
    words = exact.groupBy(*DOC).agg(F.size(covered).cast("long").alias("n_hit"))
    named = exact.select(*DOC, "phrase").distinct().join(_small(items.select("item_id", "phrase"), items.count()), "phrase")
    found = named.groupBy(*DOC).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    left, right = words.alias("l"), found.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_key") == F.col("r.text_key"))
    return left.join(right, same).select("l.doc_id", "l.text_key", "n_hit", "items")


def mark(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words, n_hit, items, contaminated``; the input's columns of these names are replaced."""
    found = hits(docs, benchmark, size).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("n_hit").alias("_n"), F.col("items").alias("_items"))
    rows = docs.drop("n_words", "n_hit", "items", "contaminated").withColumn("_text_key", F.xxhash64("text")).withColumn("n_words", F.size(_cased_words(F.col("text"))).cast("long"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    return joined.withColumns({
        "n_hit": F.coalesce("_n", F.lit(0).cast("long")),
        "items": F.coalesce("_items", F.array().cast("array<string>")),
        "contaminated": F.col("_n").isNotNull(),
    }).drop("_id", "_key", "_n", "_items", "_text_key")
