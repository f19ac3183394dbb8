"""Sources, row shaping, text functions and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions import labels, text
from moodlens.operators import cleaning, diagnostics, profile, rows, vocabulary
from moodlens.plans import base, twin
from moodlens.plans.registry import query
from moodlens.plans.twin import r
from moodlens.session import scratch_path
from moodlens.sources import derived, sinks
from moodlens.sources import reviews as src

# --- sources -----------------------------------------------------------------------------------


@query("src1_read_csv", "SELECT review_id, Score, Summary, Text FROM reviews")
def _(spark, sf):
    path = scratch_path(spark, "csv") + ".csv"
    cols = ["review_id", "Score", "Summary", "Text"]
    out = base.reviews(spark, sf).select(*cols)
    # a marker keeps null apart from the empty string, which CSV alone cannot
    out.withColumn("Summary", F.coalesce("Summary", F.lit("<null>"))).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    back = src.read_reviews(spark, path, cols)
    return back.withColumn("review_id", F.col("review_id").cast("long")).withColumn(
        "Summary", F.nullif("Summary", F.lit("<null>")))


@query("src1_first_rows_csv", "SELECT review_id, Score, Text FROM reviews ORDER BY review_id LIMIT 250")
def _(spark, sf):
    # files in the order of the ids, with cells over lines; the first rows span several of them
    path = scratch_path(spark, "parts") + ".csv"
    rows_ = base.reviews(spark, sf).select("review_id", "Score", "Text").repartitionByRange(16, "review_id").sortWithinPartitions("review_id")
    sinks.write_csv(rows_, path)
    back = src.read_reviews(spark, path, ["review_id", "Score", "Text"], n_rows=250)
    return back.withColumn("review_id", F.col("review_id").cast("long"))


@query("src2_read_parquet_subset", "SELECT doc_id, lang, n_chars FROM documents")
def _(spark, sf):
    return src.read_reviews(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "n_chars"])


@query("src3_format_dispatch", "SELECT 'parquet' AS format, count(*) AS n FROM documents UNION ALL SELECT 'csv', count(*) FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "dispatch") + ".csv"
    derived.table(spark, sf, "documents").select("doc_id", "lang").write.option("header", True).csv(path)
    parts = [
        src.read_reviews(spark, p).select(F.lit(kind).alias("format"))
        for kind, p in (("parquet", f"{sf}/documents.parquet"), ("csv", path))
    ]
    return parts[0].unionByName(parts[1]).groupBy("format").agg(F.count("*").alias("n"))


@query("src4_large_csv_scan", "SELECT Score, count(*) AS n, sum(length(Text))::BIGINT AS n_chars FROM reviews GROUP BY Score")
def _(spark, sf):
    path = scratch_path(spark, "large") + ".csv"
    sinks.write_csv(base.reviews(spark, sf).select("review_id", "Score", "Text"), path)
    return src.read_reviews(spark, path).groupBy("Score").agg(
        F.count("*").alias("n"), F.sum(F.length("Text")).alias("n_chars"))


_RAW_SCORE = """CASE review_id % 16 WHEN 1 THEN '4.0' WHEN 2 THEN '3.5' WHEN 3 THEN 'abc' WHEN 4 THEN '' WHEN 5 THEN 'nan'
 WHEN 6 THEN 'inf' WHEN 7 THEN '4d' WHEN 8 THEN '-1' WHEN 9 THEN '9' WHEN 10 THEN ' 2 ' WHEN 11 THEN '1e0' ELSE CAST(Score AS VARCHAR) END"""
_RAW_TIME = "CASE review_id % 16 WHEN 5 THEN 'x' WHEN 6 THEN NULL ELSE CAST(epoch AS VARCHAR) END"


@query("src5_coerce_types", f"""SELECT review_id,
 CASE WHEN num = floor(num) THEN CAST(num AS BIGINT) END AS Score, TRY_CAST(t AS BIGINT) AS epoch FROM (
 SELECT review_id, {_RAW_TIME} AS t, CASE WHEN regexp_matches(s, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
 THEN TRY_CAST(trim(s) AS DOUBLE) END AS num FROM (SELECT *, {_RAW_SCORE} AS s FROM reviews))""")
def _(spark, sf):
    out = src.coerce_types(derived.raw_reviews(spark, sf))
    return out.select("review_id", "Score", F.unix_timestamp("Time").alias("epoch"))


@query("src6_first_rows", "SELECT review_id, Score FROM reviews ORDER BY review_id LIMIT 500")
def _(spark, sf):
    return src.first_rows(base.reviews(spark, sf).select("review_id", "Score"), 500)


@query("src7_required_columns", "SELECT count(*) AS n_rows FROM reviews")
def _(spark, sf):
    df = src.require_rows(src.require_columns(base.reviews(spark, sf)))
    return df.agg(F.count("*").alias("n_rows"))


@query("src8_text_columns", """SELECT 'text' AS column, count(text) AS non_null, sum(length(text))::BIGINT AS n_chars FROM conversations""")
def _(spark, sf):
    df = derived.table(spark, sf, "conversations")
    parts = [
        df.agg(F.count(c).alias("non_null"), F.sum(F.length(c)).alias("n_chars")).select(F.lit(c).alias("column"), "non_null", "n_chars")
        for c in src.text_columns(df)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- sinks (written to the shared folder and read back) ------------------------------------------


@query("snk1_cleaned_csv", "SELECT review_id, Score, Emotion, clean_text FROM cleaned")
def _(spark, sf):
    path = sinks.write_cleaned(base.cleaned(spark, sf).drop("Summary", "Text"), scratch_path(spark, "cleaned"))
    back = src.coerce_types(src.read_csv(spark, path))
    return back.select(F.col("review_id").cast("long").alias("review_id"), "Score", "Emotion", "clean_text")


# --- rows ----------------------------------------------------------------------------------------


@query("row1_projection", "SELECT Score, Summary FROM reviews")
def _(spark, sf):
    return base.reviews(spark, sf).select("Score", "Summary")


@query("row2_drop_exact_duplicates", """SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS k
 FROM documents) WHERE k = 1""")
def _(spark, sf):
    docs = derived.table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    kept = rows.drop_exact_duplicates(docs.drop("n_chars"), "doc_id").select("doc_id")
    return docs.join(kept, "doc_id").select("doc_id", "lang", "n_chars")


@query("row2_drop_duplicate_documents", """SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text, lang, source, n_chars ORDER BY doc_id) AS k
 FROM documents) WHERE k = 1""")
def _(spark, sf):
    return rows.drop_exact_duplicates(derived.table(spark, sf, "documents"), "doc_id").select("doc_id", "lang", "source", "n_chars")


@query("row3_choose_source_text", f"""SELECT review_id, md5(coalesce(Summary, '')) AS summary_only,
 md5(CASE WHEN {twin.blank('Summary')} THEN Text ELSE Summary END) AS with_fallback,
 md5(CASE WHEN {twin.blank("coalesce(Summary, 'nan')")} THEN Text ELSE coalesce(Summary, 'nan') END) AS with_nan,
 md5({twin.strip_ends("concat(coalesce(Summary, ''), ' ', coalesce(Text, ''))")}) AS both FROM reviews""")
def _(spark, sf):
    df = base.reviews(spark, sf)
    return df.select(
        "review_id",
        text.content_hash(cleaning.source_text(df, fallback=False)).alias("summary_only"),
        F.md5(cleaning.source_text(df)).alias("with_fallback"),
        F.md5(cleaning.source_text(df, compat_nan=True)).alias("with_nan"),
        F.md5(cleaning.source_text(df, summary_only=False)).alias("both"),
    )


@query("row4_drop_empty_clean", "SELECT review_id, length(clean_text) AS n_chars FROM cleaned_all WHERE length(clean_text) > 0")
def _(spark, sf):
    return cleaning.drop_empty_clean(base.cleaned_all(spark, sf)).select("review_id", F.length("clean_text").alias("n_chars"))


@query("row5_short_reviews", """SELECT review_id, n_tokens, n_tokens <= 2 AS is_short FROM cleaned_all""")
def _(spark, sf):
    return base.cleaned_all(spark, sf).select("review_id", "n_tokens", rows.is_short(2).alias("is_short"))


@query("row5_short_report", f"""SELECT count(*) AS n_rows, count(*) FILTER (n_tokens <= 2) AS n_short,
 {r('count(*) FILTER (n_tokens <= 2) * 100.0 / count(*)')} AS pct_short,
 count(*) FILTER (n_tokens <= 2) > count(*) * 0.1 AS high_share FROM cleaned_all""")
def _(spark, sf):
    return rows.short_report(base.cleaned_all(spark, sf), 2)


@query("row6_exact_text_duplicates", """SELECT review_id, Emotion, row_number() OVER (PARTITION BY clean_text ORDER BY review_id) > 1
 AS is_duplicate FROM cleaned_all""")
def _(spark, sf):
    df = base.kept(base.cleaned_all(spark, sf).select("review_id", "Emotion", "clean_text"))
    return rows.exact_text_duplicates(df).drop("clean_text")


@query("row7_hash_duplicates", """SELECT item_id, md5(text) AS content_hash, row_number() OVER (PARTITION BY md5(text) ORDER BY item_id) > 1
 AS is_duplicate FROM (SELECT doc_id AS item_id, text FROM documents UNION ALL SELECT 10000000000 + item_id, text FROM benchmark)""")
def _(spark, sf):
    docs = derived.table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "text")
    bench = derived.table(spark, sf, "benchmark").select((F.lit(10_000_000_000) + F.col("item_id")).alias("item_id"), "text")
    return rows.hash_duplicates(docs.unionByName(bench), "text", "item_id").drop("text")


@query("row8_random_sample", """SELECT review_id, Score FROM reviews ORDER BY md5(CAST(review_id AS VARCHAR) || ':42') LIMIT 300""")
def _(spark, sf):
    return rows.random_sample(base.reviews(spark, sf).select("review_id", "Score"), 300, 42)


@query("row9_emotion_rows", "SELECT review_id, n_tokens FROM cleaned WHERE Emotion = 'Negative'")
def _(spark, sf):
    return rows.of_emotion(base.cleaned(spark, sf), "Negative").select("review_id", "n_tokens")


@query("row10_train_rows", "SELECT review_id, Emotion FROM split WHERE split = 'train'")
def _(spark, sf):
    df = base.staged(spark, sf, "review_id", "Emotion")
    return rows.train_rows(df.select("review_id", "Emotion"), base.split(df))


@query("row11_preview", """SELECT review_id, Score, Emotion, concat(substr(Summary, 1, 60), '...') AS Summary,
 concat(substr(clean_text, 1, 80), '...') AS clean_text_preview FROM (SELECT * REPLACE (CASE WHEN Summary IS NULL THEN NULL ELSE Summary END AS Summary)
 FROM cleaned WHERE Summary IS NOT NULL ORDER BY review_id LIMIT 12)""")
def _(spark, sf):
    return rows.preview_rows(base.cleaned(spark, sf).filter(F.col("Summary").isNotNull()), 12)


@query("row11_preview_with_nulls", """SELECT review_id, Score, Emotion, substr(Summary, 1, 60) || '...' AS Summary,
 concat(substr(clean_text, 1, 80), '...') AS clean_text_preview FROM (SELECT * FROM cleaned ORDER BY review_id LIMIT 60)""")
def _(spark, sf):
    return rows.preview_rows(base.cleaned(spark, sf), 60)


@query("row12_sample_per_emotion", """SELECT Emotion, concat(substr(arg_min(clean_text, review_id), 1, 60), '...') AS sample
 FROM cleaned GROUP BY Emotion""")
def _(spark, sf):
    return rows.first_sample_per_emotion(base.cleaned(spark, sf))


# --- text functions ------------------------------------------------------------------------------


def _text_query(name, sql_expr, expr, table="reviews", key="review_id", col="Text"):
    @query(name, f"SELECT {key}, md5({sql_expr}) AS digest, length({sql_expr}) AS n_chars FROM {table}")
    def _(spark, sf):
        df = base.reviews(spark, sf) if table == "reviews" else derived.table(spark, sf, table)
        out = df.select(key, expr(F.col(col)).alias("t"))
        return out.select(key, F.md5("t").alias("digest"), F.length("t").alias("n_chars"))


_text_query("txt1_lowercase", "lower(Text)", text.lowercase)
_text_query("txt2_expand_contractions", twin.expand("Text"), text.expand_contractions)
_text_query("txt3_strip_tags", twin.strip_tags("html"), text.strip_tags, "pages", "page_id", "html")
_text_query("txt4_strip_punctuation", twin.strip_punct("html"), text.strip_punctuation, "pages", "page_id", "html")
_text_query("txt5_strip_digits", twin.strip_digits("html"), text.strip_digits, "pages", "page_id", "html")
_text_query("txt6_collapse_space", twin.collapse("html"), text.collapse_space, "pages", "page_id", "html")
_text_query("txt13_scoring_clean",
            f"array_to_string({twin.keep_tokens(twin.split_words(twin.collapse(twin.strip_digits(twin.strip_punct(twin.strip_tags('lower(Text)'), '')))))}, ' ')",
            text.scoring_clean)
_text_query("txt14_content_hash", "md5(Text)", text.content_hash)


@query("txt7_tokenise", f"""SELECT conv_id, turn, len({twin.split_words('text')}) AS n_tokens,
 md5(array_to_string({twin.split_words('text')}, '|')) AS digest FROM conversations""")
def _(spark, sf):
    toks = text.tokenise(F.col("text"))
    return derived.table(spark, sf, "conversations").select("conv_id", "turn", toks.alias("t")).select(
        "conv_id", "turn", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", "|")).alias("digest"))


@query("txt8_token_filter", f"""SELECT conv_id, turn, array_to_string({twin.keep_tokens(twin.split_words('lower(text)'))}, ' ') AS kept FROM conversations""")
def _(spark, sf):
    return derived.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(text.filter_tokens(text.tokenise(F.lower("text"))), " ").alias("kept"))


@query("txt9_stopword_set", f"""SELECT token, count(*) AS n FROM (SELECT unnest({twin.split_words('lower(text)')}) AS token FROM conversations)
 WHERE token IN {twin.in_list(lexicons.STOPWORDS)} AND token NOT IN {twin.in_list(lexicons.SENTIMENT_WORDS)}
 AND token NOT IN {twin.in_list(lexicons.NEGATORS)} GROUP BY token""")
def _(spark, sf):
    stop = vocabulary.stopword_table(spark)
    toks = derived.table(spark, sf, "conversations").select(F.explode_outer(text.tokenise(F.lower("text"))).alias("token"))
    # the stop list has under a hundred rows
    return toks.groupBy("token").agg(F.count("*").alias("n")).join(F.broadcast(stop), "token", "left_semi")


@query("txt10_lemmatise", f"""WITH lemmas AS (SELECT token, substr(token, 1, length(token) - 1) AS lemma FROM token_freq
 WHERE regexp_full_match(token, '[a-z]{{3,}}s')),
 pos AS (SELECT review_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM cleaned)
 SELECT p.review_id, string_agg(CASE WHEN p.token IN {twin.in_list(lexicons.PROTECTED_WORDS)} THEN p.token ELSE coalesce(l.lemma, p.token) END, ' ' ORDER BY p.pos)
 AS lemma_text FROM pos p LEFT JOIN lemmas l ON p.token = l.token GROUP BY p.review_id""")
def _(spark, sf):
    df = base.staged(spark, sf)
    return vocabulary.lemmatise(df, derived.fixture_lemmas(base.freq(df))).select(
        "review_id", F.array_join("tokens", " ").alias("lemma_text"))


@query("txt11_stem_vocabulary")
def _(spark, sf):
    return vocabulary.stem_vocabulary(base.freq(base.cleaned(spark, sf)))


@query("txt11_stem_rules", f"""SELECT token, n, TRUE AS no_longer, CASE WHEN token IN ({', '.join(repr(w) for w in lexicons.PROTECTED_WORDS)}) THEN TRUE END AS kept_if_protected
 FROM token_freq""")
def _(spark, sf):
    # a step may add one letter; protected words stay as they are
    stems = vocabulary.stem_vocabulary(base.freq(base.cleaned(spark, sf)))
    kept = F.when(F.col("token").isin(*lexicons.PROTECTED_WORDS), F.col("stem") == F.col("token"))
    return stems.select("token", "n", (F.length("stem") <= F.length("token") + 1).alias("no_longer"), kept.alias("kept_if_protected"))


@query("txt12_clean_text", "SELECT review_id, n_tokens, clean_text FROM cleaned_all")
def _(spark, sf):
    return base.cleaned_all(spark, sf).select("review_id", "n_tokens", "clean_text")


@query("txt12_clean_text_stem", "SELECT review_id, n_tokens, 0::BIGINT AS n_longer, TRUE AS as_after_cleaning FROM cleaned")
def _(spark, sf):
    # the toggle of the cleaner against stemming the cleaned tokens word by word
    one = cleaning.clean_reviews(base.reviews(spark, sf), text.CleanOptions(stem=True)).select("review_id", "n_tokens", "clean_text", F.col("tokens").alias("stems"))
    plain = base.cleaned(spark, sf)
    two = vocabulary.reduce_words(plain.select("review_id", "tokens", "n_tokens", "clean_text"), None, True)
    both = one.join(plain.select("review_id", "tokens"), "review_id").join(two.select("review_id", F.col("clean_text").alias("after")), "review_id")
    longer = F.size(F.filter(F.zip_with("stems", "tokens", lambda a, b: F.length(a) > F.length(b)), lambda x: x))
    return both.select("review_id", "n_tokens", longer.cast("long").alias("n_longer"), (F.col("clean_text") == F.col("after")).alias("as_after_cleaning"))


@query("txt15_keyword_predicate", f"SELECT token, n, {twin.token_ok('token')} AS ok, regexp_full_match(token, '[a-z]{{3,15}}') AS ok_any_domain FROM token_freq")
def _(spark, sf):
    return base.freq(base.cleaned(spark, sf)).select(
        "token", "n", text.keyword_token_ok(F.col("token")).alias("ok"),
        text.keyword_token_ok(F.col("token"), domain_stop=False).alias("ok_any_domain"))


def _aspect_sql(words):
    hit = " OR ".join(f"contains(lower(s), {twin.lit(w)})" for w in words)
    return f"array_to_string(list_transform(list_filter(string_split(Text, '.'), lambda s: {hit}), lambda s: {twin.strip_ends('s')}), ' ')"


@query("txt16_aspect_sentences", f"SELECT review_id, {_aspect_sql(['taste', 'quality'])} AS taste_quality, {_aspect_sql(lexicons.ASPECTS)} AS any_aspect FROM reviews")
def _(spark, sf):
    return base.reviews(spark, sf).select(
        "review_id", text.aspect_sentences(F.col("Text"), ["taste", "quality"]).alias("taste_quality"),
        text.aspect_sentences(F.col("Text"), lexicons.ASPECTS).alias("any_aspect"))


def _found(words):
    return f"list_filter([{', '.join(twin.lit(w) for w in words)}], lambda w: contains(clean_text, w))"


def _indicator_sql():
    cols, totals = [], {}
    for side, cats in (("positive", lexicons.POSITIVE_INDICATORS), ("negative", lexicons.NEGATIVE_INDICATORS)):
        cols += [f"array_to_string({_found(ws)}, ',') AS {side}_{c}" for c, ws in cats.items()]
        totals[side] = " + ".join(f"len({_found(ws)})" for ws in cats.values())
    p, n = totals["positive"], totals["negative"]
    return (
        f"SELECT *, CASE WHEN n_positive = 0 AND n_negative = 0 THEN 'neutral' WHEN n_positive > n_negative THEN 'positive' "
        f"WHEN n_negative > n_positive THEN 'negative' ELSE 'mixed' END AS verdict FROM (SELECT review_id, {', '.join(cols)}, "
        f"{p} AS n_positive, {n} AS n_negative FROM cleaned)"
    )


@query("txt17_lexicon_indicators", _indicator_sql())
def _(spark, sf):
    return diagnostics.lexicon_indicators(base.cleaned(spark, sf).select("review_id", "clean_text")).drop("clean_text")


@query("txt18_text_stats", f"""SELECT *, CASE WHEN coverage < 0.3 THEN 'very low' WHEN coverage < 0.5 THEN 'moderate' ELSE 'good' END AS tier FROM (
 SELECT c.review_id, c.n_tokens AS words, length(c.clean_text) AS chars, coalesce(i.n_in_vocab, 0) AS n_in_vocab,
 {r('coalesce(i.n_in_vocab, 0) / c.n_tokens')} AS coverage FROM cleaned c LEFT JOIN (
 SELECT t.review_id, count(*) AS n_in_vocab FROM toks t JOIN vectors v ON t.token = v.token GROUP BY t.review_id) i ON c.review_id = i.review_id)""")
def _(spark, sf):
    df = base.staged(spark, sf, "review_id", "tokens", "n_tokens", "clean_text")
    return vocabulary.text_stats(df, base.vectors(df).select("token"))


# --- labels --------------------------------------------------------------------------------------


@query("lab1_emotion_default", """SELECT s AS Score, CASE WHEN s IS NULL THEN 'Unknown' WHEN s <= 2 THEN 'Negative' WHEN s = 3 THEN 'Neutral'
 ELSE 'Positive' END AS Emotion, count(*) AS n FROM (SELECT CASE WHEN review_id % 7 = 0 THEN Score * 3 ELSE Score END AS s FROM reviews) GROUP BY ALL""")
def _(spark, sf):
    # some scores leave the 1..5 range, where the two mappings differ
    s = F.when(F.pmod("review_id", F.lit(7)) == 0, F.col("Score") * 3).otherwise(F.col("Score"))
    df = base.reviews(spark, sf).select(s.alias("Score"))
    return df.withColumn("Emotion", labels.emotion_default(F.col("Score"))).groupBy("Score", "Emotion").agg(F.count("*").alias("n"))


@query("lab2_emotion_mapped", f"""SELECT Score, {twin.emotion('Score')} AS standard, {twin.emotion('Score', 1, 3, 5)} AS strict,
 count(*) AS n FROM reviews GROUP BY ALL""")
def _(spark, sf):
    df = base.reviews(spark, sf).select("Score")
    df = df.withColumn("standard", labels.emotion_mapped(F.col("Score")))
    df = df.withColumn("strict", labels.emotion_mapped(F.col("Score"), 1, 3, 5))
    return df.groupBy("Score", "standard", "strict").agg(F.count("*").alias("n"))


@query("lab3_label_codes", """SELECT Emotion, dense_rank() OVER (ORDER BY Emotion) - 1 AS label, n FROM (
 SELECT Emotion, count(*) AS n FROM cleaned GROUP BY Emotion)""")
def _(spark, sf):
    return vocabulary.label_codes(base.cleaned(spark, sf).groupBy("Emotion").agg(F.count("*").alias("n")))


@query("lab4_by_year", """SELECT year(to_timestamp(epoch) AT TIME ZONE 'UTC') AS year, count(*) AS n,
 CAST(min(CAST(to_timestamp(epoch) AT TIME ZONE 'UTC' AS DATE)) AS VARCHAR) AS first_day,
 CAST(max(CAST(to_timestamp(epoch) AT TIME ZONE 'UTC' AS DATE)) AS VARCHAR) AS last_day FROM reviews GROUP BY 1""")
def _(spark, sf):
    return profile.by_year(base.reviews(spark, sf))


@query("lab5_emotion_trend", f"""SELECT strftime(period, '%Y-%m-%d') AS period, Emotion, n, {r('n * 100.0 / sum(n) OVER (PARTITION BY period)')} AS share_pct FROM (
 SELECT date_trunc('quarter', to_timestamp(epoch) AT TIME ZONE 'UTC') AS period, {twin.emotion('Score')} AS Emotion, count(*) AS n FROM reviews GROUP BY ALL)""")
def _(spark, sf):
    df = base.reviews(spark, sf).withColumn("Emotion", labels.emotion_mapped(F.col("Score")))
    out = profile.emotion_trend(df, "Quarter")
    return out.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@query("lab5_event_trend", f"""SELECT strftime(period, '%Y-%m-%d') AS period, event_type, n, {r('n * 100.0 / sum(n) OVER (PARTITION BY period)')} AS share_pct FROM (
 SELECT date_trunc('month', ts) AS period, event_type, count(*) AS n FROM events GROUP BY ALL)""")
def _(spark, sf):
    out = profile.emotion_trend(derived.table(spark, sf, "events"), "Month", "ts", "event_type")
    return out.withColumn("period", F.date_format("period", "yyyy-MM-dd"))
