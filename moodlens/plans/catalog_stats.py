"""Aggregations, lookups, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions import text
from moodlens.operators import diagnostics, embeddings, evaluation, joins, keywords, prediction, profile, rows, splits, vocabulary
from moodlens.plans import base, twin
from moodlens.plans.registry import query
from moodlens.plans.twin import r
from moodlens.sources import derived

_REVIEW_COLS = (("review_id", "bigint"), ("Score", "bigint"), ("Summary", "string"), ("Text", "string"), ("Time", "timestamp"))


# --- aggregations --------------------------------------------------------------------------------


@query("agg1_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count({c if c != 'Time' else 'epoch'}) AS non_null, count(*) - count({c if c != 'Time' else 'epoch'}) AS nulls, "
    f"round((count(*) - count({c if c != 'Time' else 'epoch'})) * 100.0 / count(*), 2)::DOUBLE AS null_pct FROM reviews" for c, t in _REVIEW_COLS))
def _(spark, sf):
    return profile.column_profile(base.reviews(spark, sf))


@query("agg1_profile_lineitem", " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS null_pct FROM lineitem"
    for c, t in (("l_orderkey", "bigint"), ("l_quantity", "double"), ("l_returnflag", "string"))))
def _(spark, sf):
    return profile.column_profile(derived.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"))


@query("agg2_duplicate_documents", """SELECT (SELECT count(*) FROM documents) - count(*) AS duplicate_rows FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)""")
def _(spark, sf):
    return profile.duplicate_row_count(derived.table(spark, sf, "documents").drop("doc_id"))


@query("agg2_duplicate_rows", """SELECT (SELECT count(*) FROM documents) - count(*) AS duplicate_rows FROM (SELECT DISTINCT text, lang FROM documents)""")
def _(spark, sf):
    return profile.duplicate_row_count(derived.table(spark, sf, "documents").select("text", "lang"))


@query("agg3_score_distribution", "SELECT Score, count(*) AS n FROM reviews GROUP BY Score")
def _(spark, sf):
    return profile.score_distribution(base.reviews(spark, sf))


@query("agg4_emotion_distribution", f"SELECT Emotion, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM cleaned GROUP BY Emotion")
def _(spark, sf):
    return profile.emotion_distribution(base.cleaned(spark, sf))


@query("agg4_scored_emotions", f"""SELECT Emotion, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM (
 SELECT CASE WHEN Score <= 2 THEN 'Negative' WHEN Score = 3 THEN 'Neutral' ELSE 'Positive' END AS Emotion FROM reviews WHERE Score IS NOT NULL) GROUP BY Emotion""")
def _(spark, sf):
    return profile.score_emotions(base.reviews(spark, sf))


@query("agg5_dataset_summary", f"""SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns,
 {r('(count(review_id) + count(Score) + count(Summary) + count(Text) + count(epoch)) * 100.0 / (count(*) * 5)')} AS completeness_pct FROM reviews""")
def _(spark, sf):
    return profile.dataset_summary(base.reviews(spark, sf))


@query("agg6_invalid_scores", f"""SELECT count(*) - count(Score) AS n_invalid, {r('(count(*) - count(Score)) * 100.0 / count(*)')} AS pct_invalid,
 (count(*) - count(Score)) > count(*) * 0.5 AS mostly_invalid FROM reviews""")
def _(spark, sf):
    return profile.invalid_scores(base.reviews(spark, sf))


@query("agg7_cleaning_report", f"""WITH x AS (SELECT len({twin.split_words("coalesce(source_text, '')")}) AS b, n_tokens AS a, {twin.blank('Summary')} AS fb FROM cleaned_all)
 SELECT count(*) FILTER (b = 0) AS empty_before, count(*) FILTER (a = 0) AS empty_after, sum(b)::BIGINT AS tokens_before, sum(a)::BIGINT AS tokens_after,
 {r('sum(a) / sum(b)')} AS preservation_rate, sum(a) / sum(b) < 0.3 AS low_preservation, count(*) FILTER (fb) AS n_fallback FROM x""")
def _(spark, sf):
    return profile.cleaning_report(base.cleaned_all(spark, sf))


_COUNTS = "SELECT Emotion, count(*) AS n FROM cleaned GROUP BY Emotion"


@query("agg8_class_balance", f"""SELECT arg_max(Emotion, n) AS largest_class, {r('max(n) / sum(n)')} AS max_share, {r('min(n) / sum(n)')} AS min_share,
 {r('max(n) / min(n)')} AS ratio, CASE WHEN max(n) / sum(n) > 0.7 THEN 'severe' WHEN max(n) / min(n) > 3 THEN 'moderate' ELSE 'good' END AS verdict FROM ({_COUNTS})""")
def _(spark, sf):
    return profile.class_balance(base.cleaned(spark, sf))


@query("agg9_text_length_stats", f"""SELECT count(*) AS n_rows, {r('avg(n_tokens)')} AS mean_tokens, {r('median(n_tokens)')} AS median_tokens,
 count(DISTINCT Emotion) AS n_emotions FROM cleaned""")
def _(spark, sf):
    return diagnostics.text_length_stats(base.cleaned(spark, sf))


@query("agg10_corpus_shape", f"""SELECT count(*) AS n_rows, count(clean_text) AS non_null_text, count(Emotion) AS non_null_emotion,
 CAST(floor(median(n_tokens)) AS BIGINT) AS median_tokens, {r('avg(n_tokens)')} AS mean_tokens, max(n_tokens)::BIGINT AS max_tokens FROM cleaned_all""")
def _(spark, sf):
    return diagnostics.corpus_shape(base.cleaned_all(spark, sf))


@query("agg11_length_quantiles", " UNION ALL ".join(
    f"SELECT {r(q)} AS quantile, {r(f'quantile_cont(n_tokens, {q})')} AS tokens FROM cleaned_all" for q in ("0.1", "0.5", "0.9", "0.99")))
def _(spark, sf):
    return diagnostics.length_quantiles(base.cleaned_all(spark, sf))


@query("agg12_length_histogram", f"""WITH s AS (SELECT min(n_tokens)::DOUBLE AS lo, max(n_tokens)::DOUBLE AS hi, least(80, greatest(10, max(n_tokens)))::BIGINT AS bins FROM cleaned_all),
 b AS (SELECT least(CAST(floor((n_tokens - lo) / ((hi - lo) / bins)) AS BIGINT), bins - 1) AS bin, lo, (hi - lo) / bins AS w
 FROM cleaned_all JOIN s ON TRUE)
 SELECT bin, {r('min(lo + bin * w)')} AS bin_start, count(*) AS n FROM b GROUP BY bin""")
def _(spark, sf):
    return diagnostics.length_histogram(base.cleaned_all(spark, sf))


@query("agg13_vocabulary_counts", "SELECT token, n FROM token_freq")
def _(spark, sf):
    return base.freq(base.cleaned(spark, sf))


@query("agg14_lexical_richness", f"""SELECT count(*) AS vocabulary, sum(n)::BIGINT AS tokens, {r('count(*) / sum(n)')} AS ttr,
 {r('ln(count(*) + 1) / ln(sum(n) + 1)')} AS herdan_c, {r('count(*) FILTER (n = 1) / greatest(count(*), 1)')} AS hapax_share,
 CASE WHEN count(*) / sum(n) < 0.1 THEN 'low' WHEN count(*) / sum(n) < 0.3 THEN 'moderate' ELSE 'high' END AS tier FROM token_freq""")
def _(spark, sf):
    return diagnostics.lexical_richness(base.freq(base.cleaned(spark, sf)))


@query("agg15_imbalance_ratio", f"""SELECT max(n) AS max_class, min(n) AS min_class, {r('max(n) / min(n)')} AS ratio,
 CASE WHEN max(n) / min(n) > 10 THEN 'significant' WHEN max(n) / min(n) > 3 THEN 'moderate' ELSE 'balanced' END AS tier FROM ({_COUNTS})""")
def _(spark, sf):
    return profile.imbalance_ratio(base.cleaned(spark, sf))


_TFIDF = """w AS (SELECT review_id, unnest(list_filter(string_split_regex(lower(clean_text), '[^\\p{L}\\p{N}_]+'), lambda t: t <> '')) AS token FROM cleaned),
 tf AS (SELECT review_id, token, count(*) AS tf FROM w GROUP BY ALL),
 v AS (SELECT token, sum(tf) AS n, count(*) AS df FROM tf GROUP BY token),
 nd AS (SELECT count(*) AS d FROM cleaned),
 x AS (SELECT tf.review_id, tf.token, tf.tf * (ln((1 + nd.d) / (1 + v.df)) + 1) AS w FROM tf JOIN v ON tf.token = v.token JOIN nd ON TRUE),
 y AS (SELECT token, w / sqrt(sum(w * w) OVER (PARTITION BY review_id)) AS w FROM x),
 z AS (SELECT token, sum(w) / (SELECT d FROM nd) AS m FROM y GROUP BY token)"""


@query("agg16_mean_tfidf", f"WITH {_TFIDF} SELECT token, {r('m')} AS mean_tfidf FROM z")
def _(spark, sf):
    return diagnostics.mean_tfidf(base.staged(spark, sf, "review_id", "clean_text"))


@query("agg17_diagnostic_summary", f"""WITH c AS (SELECT Emotion, count(*) AS n FROM cleaned_all GROUP BY Emotion),
 d AS (SELECT count(*) - count(DISTINCT clean_text) AS dup, count(*) AS n, count(*) FILTER (n_tokens <= 2) AS s, count(*) - count(clean_text) AS mt FROM cleaned_all)
 SELECT d.n AS n_rows, d.mt AS missing_text, CAST(0 AS BIGINT) AS missing_emotion, d.s AS n_short, {r('(SELECT max(n) / min(n) FROM c)')} AS imbalance_ratio,
 d.dup AS n_duplicate, concat_ws(',', CASE WHEN d.s > d.n * 0.1 THEN 'many short reviews' END, CASE WHEN (SELECT max(n) / min(n) FROM c) > 10 THEN 'severe class imbalance' END,
 CASE WHEN d.dup > d.n * 0.05 THEN 'many duplicates' END) AS issues FROM d""")
def _(spark, sf):
    return diagnostics.diagnostic_summary(base.kept(base.cleaned_all(spark, sf).select("Emotion", "n_tokens", "clean_text")))


_DF = f"SELECT token, count(DISTINCT review_id) AS n_docs FROM toks WHERE {twin.token_ok('token')} GROUP BY token"


@query("agg18_document_frequency", f"SELECT * FROM ({_DF}) WHERE n_docs >= 20")
def _(spark, sf):
    return diagnostics.document_frequency(base.cleaned(spark, sf)).filter(F.col("n_docs") >= 20)


_PRESERVED = ", ".join(
    f"({twin.lit(w)}, '{k}')" for k, ws in (("sentiment", lexicons.SENTIMENT_WORDS), ("negator", lexicons.NEGATORS)) for w in ws)


@query("agg19_preserved_words", f"""SELECT w.word, w.kind, bool_or(contains(c.clean_text, w.word)) AS found FROM cleaned c
 JOIN (SELECT * FROM (VALUES {_PRESERVED}) AS v(word, kind)) w ON TRUE GROUP BY w.word, w.kind""")
def _(spark, sf):
    return diagnostics.preserved_words(base.cleaned(spark, sf))


_KEY1 = f"""SELECT e.Emotion, e.token, e.n FROM etf e JOIN ({_DF}) d ON e.token = d.token
 WHERE d.n_docs >= 2 AND e.Emotion IN ('Negative', 'Neutral', 'Positive') AND {twin.token_ok('e.token')}"""


@query("agg20_emotion_vocabulary", f"""SELECT Emotion, count(*) AS vocabulary, sum(n)::BIGINT AS tokens,
 CASE WHEN count(*) < 50 THEN 'poor' WHEN count(*) < 200 THEN 'moderate' ELSE 'good' END AS tier FROM ({_KEY1}) GROUP BY Emotion""")
def _(spark, sf):
    return keywords.emotion_vocabulary(keywords.emotion_counts(base.staged(spark, sf), min_df=2))


@query("agg21_split_class_counts", "SELECT split, Emotion, count(*) AS n FROM split GROUP BY ALL")
def _(spark, sf):
    return splits.class_counts(base.split(base.staged(spark, sf, "review_id", "Emotion")))


# --- lookups -------------------------------------------------------------------------------------

_PAIRS = "SELECT review_id, token, count(*) AS c FROM toks GROUP BY ALL"


@query("jn1_token_vectors", f"""SELECT t.review_id, count(*) AS n_types, sum(t.c)::BIGINT AS n_tokens, {r('sum(t.c * v.vector[1])')} AS first_component
 FROM ({_PAIRS}) t JOIN vectors v ON t.token = v.token GROUP BY t.review_id""")
def _(spark, sf):
    df = base.written(spark, sf)
    vectors, fits = joins.fits_broadcast(base.vectors(df))
    if not fits:  # no token leaves its review
        first = vectors.select("token", F.slice("vector", 1, 1).alias("vector"), F.lit(1.0).alias("weight"))
        sums = embeddings.token_sums(df, first, 1, written=True).filter("n_types > 0")
        return sums.select("review_id", "n_types", F.col("n_in_vocab").alias("n_tokens"), F.col("sums")[0].alias("first_component"))
    hit = embeddings.token_counts(df).join(F.broadcast(vectors), "token")
    return hit.groupBy("review_id").agg(
        F.count("*").alias("n_types"), F.sum("c").alias("n_tokens"), F.sum(F.col("c") * F.col("vector")[0]).alias("first_component"))


@query("jn1_salted_shuffle_join", f"""SELECT t.token, count(*) AS n_docs, sum(t.c)::BIGINT AS n_tokens, {r('min(v.vector[2])')} AS second_component
 FROM ({_PAIRS}) t JOIN vectors v ON t.token = v.token GROUP BY t.token""")
def _(spark, sf):
    df = base.staged(spark, sf)
    hit = joins.salted_join(base.kept(embeddings.token_counts(df)), base.kept(base.vectors(df)), "token", F.col("review_id"))
    return hit.groupBy("token").agg(
        F.count("*").alias("n_docs"), F.sum("c").alias("n_tokens"), F.min(F.col("vector")[1]).alias("second_component"))


@query("jn2_train_frequency", """SELECT f.token, f.n, coalesce(t.n, 0) AS train_n FROM token_freq f LEFT JOIN (
 SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM split WHERE split = 'train') GROUP BY token) t ON f.token = t.token""")
def _(spark, sf):
    df = base.staged(spark, sf)
    train = base.split(df).filter(F.col("split") == "train")
    freq = base.freq(df)
    return freq.join(base.freq(train).withColumnRenamed("n", "train_n"), "token", "left").fillna(0, ["train_n"])


@query("jn3_document_frequency_filter", f"""SELECT f.token, f.n FROM token_freq f WHERE f.token IN (SELECT token FROM ({_DF}) WHERE n_docs >= 20)""")
def _(spark, sf):
    df = base.staged(spark, sf)
    return base.freq(df).join(diagnostics.document_frequency(df).filter(F.col("n_docs") >= 20), "token", "left_semi")


_POL = "SELECT token, CAST(CAST('0x' || substr(md5(token || ':valence'), 1, 4) AS BIGINT) % 81 AS DOUBLE) / 10 - 4 AS valence FROM token_freq"


@query("jn4_polarity_lookup", f"""SELECT token, n, {r('valence')} AS valence FROM (
 SELECT token, n, CAST(CAST('0x' || substr(md5(token || ':valence'), 1, 4) AS BIGINT) % 81 AS DOUBLE) / 10 - 4 AS valence FROM token_freq) WHERE valence >= 0.5""")
def _(spark, sf):
    freq = base.kept(base.freq(base.cleaned(spark, sf)))  # both sides of the lookup
    return freq.join(derived.fixture_polarity(freq).filter(F.col("valence") >= 0.5), "token")


@query("jn5_stopword_exclusion", f"""SELECT token, count(*) AS n FROM (SELECT unnest({twin.split_words('lower(text)')}) AS token FROM documents)
 WHERE token NOT IN {twin.in_list(lexicons.effective_stopwords())} GROUP BY token""")
def _(spark, sf):
    docs = derived.table(spark, sf, "documents").select("doc_id", F.explode_outer(text.tokenise(F.lower("text"))).alias("token"))
    counts = docs.filter(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("n"))
    return vocabulary.drop_listed(counts, vocabulary.stopword_table(spark), "token")


@query("jn6_label_index", """SELECT c.review_id, c.Emotion, l.label FROM cleaned c JOIN (
 SELECT Emotion, dense_rank() OVER (ORDER BY Emotion) - 1 AS label FROM (SELECT DISTINCT Emotion FROM cleaned)) l ON c.Emotion = l.Emotion""")
def _(spark, sf):
    df = base.staged(spark, sf, "review_id", "Emotion")
    codes = vocabulary.label_codes(df.select("Emotion").distinct())
    # one row per class
    return df.join(F.broadcast(codes), "Emotion").select("review_id", "Emotion", "label")


def _metric_rows(table: str, model: str) -> str:
    m = f"""SELECT c, sum(CASE WHEN label = c AND pred = c THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN label = c THEN 1 ELSE 0 END) AS t,
 sum(CASE WHEN pred = c THEN 1 ELSE 0 END) AS p FROM {table} JOIN (SELECT unnest([0, 1, 2]) AS c) g ON TRUE GROUP BY c HAVING t > 0 OR p > 0"""
    return f"""SELECT '{model}' AS model, avg(coalesce(tp / nullif(p, 0), 0)) AS precision, avg(coalesce(tp / nullif(t, 0), 0)) AS recall,
 avg(CASE WHEN p + t = 0 THEN 0 ELSE 2 * tp / (p + t) END) AS f1, sum(tp) / (SELECT count(*) FROM {table}) AS accuracy FROM ({m})"""


_ENS_SCORED = """scored3 AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS pred, greatest(p0, p1, p2) AS conf FROM (
 SELECT a.review_id, a.label, 0.4::DOUBLE * a.p0 + 0.6::DOUBLE * b.p0 AS p0, 0.4::DOUBLE * a.p1 + 0.6::DOUBLE * b.p1 AS p1, 0.4::DOUBLE * a.p2 + 0.6::DOUBLE * b.p2 AS p2
 FROM probs a JOIN probs2 b ON a.review_id = b.review_id))"""


def _auc_sql(table: str) -> str:
    e = " UNION ALL ".join(f"SELECT {c} AS c, CASE WHEN label = {c} THEN 1 ELSE 0 END AS y, p{c} AS s FROM {table}" for c in range(3))
    return f"""SELECT c, sum(pos * below + 0.5 * pos * neg)::DOUBLE / (sum(pos) * sum(neg)) AS auc FROM (
 SELECT c, pos, neg, sum(neg) OVER (PARTITION BY c ORDER BY s ROWS UNBOUNDED PRECEDING) - neg AS below FROM (
 SELECT c, s, sum(y) AS pos, sum(1 - y) AS neg FROM ({e}) GROUP BY c, s)) GROUP BY c"""


_ALL_METRICS = f"""{_ENS_SCORED}, metrics AS (SELECT m.*, a.auc FROM ({_metric_rows('scored', 'Random Forest')} UNION ALL {_metric_rows('scored2', 'Boosting')}
 UNION ALL {_metric_rows('scored3', 'Ensemble')}) m JOIN (
 SELECT 'Random Forest' AS model, avg(auc) AS auc FROM ({_auc_sql('probs')}) UNION ALL SELECT 'Boosting', avg(auc) FROM ({_auc_sql('probs2')})
 UNION ALL SELECT 'Ensemble', avg(auc) FROM ({_auc_sql('scored3')})) a ON m.model = a.model)"""


@query("jn7_model_metrics", f"WITH {_ALL_METRICS} SELECT model, {r('accuracy')} AS accuracy, {r('f1')} AS f1, {r('precision')} AS precision, {r('recall')} AS recall FROM metrics WHERE model = 'Ensemble'")
def _(spark, sf):
    return evaluation.metrics_of(base.model_metrics(spark, sf), "Ensemble").select("model", "accuracy", "f1", "precision", "recall")


_TOP = f"""kw AS ({_KEY1}), lo AS (SELECT k.Emotion, k.token, k.n, ln((k.n + 1) / (i.t - k.n + 1)) - ln((g.n - k.n + 1) / (a.t - i.t - (g.n - k.n) + 1)) AS score
 FROM kw k JOIN (SELECT Emotion, sum(n) AS t FROM kw GROUP BY Emotion) i ON k.Emotion = i.Emotion
 JOIN (SELECT token, sum(n) AS n FROM kw GROUP BY token) g ON k.token = g.token JOIN (SELECT sum(n) AS t FROM kw) a ON TRUE WHERE k.n >= 2),
 cloud AS (SELECT Emotion, token, score, row_number() OVER (PARTITION BY Emotion ORDER BY round(score, 9) DESC, token) AS k FROM lo QUALIFY k <= 180),
 wt AS (SELECT Emotion, token AS Word, CASE WHEN min(score) OVER (PARTITION BY Emotion) < 0 THEN score - min(score) OVER (PARTITION BY Emotion) + 0.001 ELSE score END AS Weight, k AS Rank FROM cloud),
 tbl AS (SELECT Emotion, Rank, Word, Weight FROM wt WHERE Rank <= 60)"""


@query("jn8_word_emotions", f"WITH {_TOP} SELECT Word, count(*) AS n_emotions, string_agg(Emotion, ',' ORDER BY Emotion) AS emotions FROM tbl GROUP BY Word")
def _(spark, sf):
    return keywords.word_emotions(base.keyword_table(spark, sf))


# --- rankings ------------------------------------------------------------------------------------


@query("top1_top_tokens", "SELECT token, n FROM token_freq ORDER BY n DESC, token LIMIT 20")
def _(spark, sf):
    return diagnostics.top_tokens(base.freq(base.cleaned(spark, sf)), 20)


@query("top2_top_tokens_per_emotion", """SELECT Emotion, token, n, row_number() OVER (PARTITION BY Emotion ORDER BY n DESC, token) AS rank FROM etf QUALIFY rank <= 15""")
def _(spark, sf):
    return diagnostics.top_tokens_per_emotion(diagnostics.emotion_token_freq(base.cleaned(spark, sf)), 15)


@query("top3_top_tfidf", f"WITH {_TFIDF} SELECT token, {r('m')} AS mean_tfidf FROM z ORDER BY round(m, 9) DESC, token LIMIT 20")
def _(spark, sf):
    return diagnostics.top_tfidf(base.staged(spark, sf, "review_id", "clean_text"), 20)


_TRAIN_FREQ = "SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM split WHERE split = 'train') GROUP BY token"
_SIF = f"""tr AS ({_TRAIN_FREQ}), sif AS (SELECT token, n, 0.001::DOUBLE / (0.001::DOUBLE + n / (SELECT sum(n) FROM tr)) AS w,
 row_number() OVER (ORDER BY n DESC, token) AS k FROM tr)"""


@query("top4_frequent_sif_weights", f"WITH {_SIF} SELECT k AS rank, token, n, {r('w')} AS weight FROM sif WHERE k <= 30")
def _(spark, sf):
    train = base.split(base.staged(spark, sf)).filter(F.col("split") == "train")
    return embeddings.frequent_sif_weights(base.freq(train), 30)


@query("top4_sif_weight_buckets", f"WITH {_SIF} SELECT CASE WHEN k <= 10 THEN 'high' WHEN k <= 20 THEN 'mid' ELSE 'low' END AS bucket, {r('avg(w)')} AS mean_weight FROM sif WHERE k <= 30 GROUP BY 1")
def _(spark, sf):
    train = base.split(base.staged(spark, sf)).filter(F.col("split") == "train")
    return embeddings.sif_buckets(embeddings.frequent_sif_weights(base.freq(train), 30))


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, 9), lambda i: {a}[i] * {b}[i]))"


@query("top5_nearest_words", f"""WITH probe AS (SELECT token AS probe, vector AS pv FROM vectors WHERE token IN ('good', 'love', 'taste'))
 SELECT probe, token, {r('s')} AS similarity, row_number() OVER (PARTITION BY probe ORDER BY round(s, 9) DESC, token) AS rank FROM (
 SELECT p.probe, v.token, {_dot('p.pv', 'v.vector')} / (sqrt({_dot('p.pv', 'p.pv')}) * sqrt({_dot('v.vector', 'v.vector')}) + 1e-12::DOUBLE) AS s
 FROM vectors v JOIN probe p ON v.token <> p.probe) QUALIFY rank <= 6""")
def _(spark, sf):
    return embeddings.nearest_words(base.kept(base.vectors(base.staged(spark, sf))), ["good", "love", "taste"], 6)


@query("top6_keyword_table", f"WITH {_TOP} SELECT Emotion, Rank, Word, {r('Weight')} AS Weight FROM tbl")
def _(spark, sf):
    return base.keyword_table(spark, sf)


@query("top8_first_of_group", """SELECT review_id, row_number() OVER (PARTITION BY n_tokens ORDER BY review_id) = 1 AS is_first FROM cleaned""")
def _(spark, sf):
    df = rows.flag_repeats(base.staged(spark, sf, "review_id", "n_tokens").select("review_id", "n_tokens"), [F.col("n_tokens")])
    return df.select("review_id", (~F.col("is_duplicate")).alias("is_first"))


@query("top9_recent_predictions", f"""SELECT review_id, prediction, {r('confidence')} AS confidence, model, {r('avg(confidence) OVER ()')} AS mean_confidence FROM (
 SELECT * FROM history ORDER BY ts DESC, review_id DESC LIMIT 10)""")
def _(spark, sf):
    return prediction.recent(derived.history(spark, sf), 10).select("review_id", "prediction", "confidence", "model", "mean_confidence")


@query("top10_most_common", "SELECT prediction, count(*) AS n FROM history GROUP BY prediction ORDER BY n DESC, prediction LIMIT 1")
def _(spark, sf):
    return prediction.most_common(derived.history(spark, sf))


@query("top11_winner", f"""WITH {_ALL_METRICS} SELECT (SELECT model FROM metrics ORDER BY round(f1, 9) DESC, round(auc, 9) DESC, model LIMIT 1) AS winner,
 (SELECT model FROM metrics ORDER BY round(f1, 9) DESC, model LIMIT 1) AS best_f1, (SELECT model FROM metrics ORDER BY round(auc, 9) DESC, model LIMIT 1) AS best_auc,
 (SELECT model FROM metrics ORDER BY round(precision, 9) DESC, model LIMIT 1) AS best_precision, (SELECT model FROM metrics ORDER BY round(recall, 9) DESC, model LIMIT 1) AS best_recall""")
def _(spark, sf):
    return evaluation.winners(base.model_metrics(spark, sf))


# --- set operations ------------------------------------------------------------------------------


@query("set1_union", "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def _(spark, sf):
    docs = derived.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs.unionByName(derived.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"))


@query("set2_lexicon_difference", f"SELECT token FROM token_freq WHERE token NOT IN {twin.in_list(lexicons.PROTECTED_WORDS)}")
def _(spark, sf):
    vocab = base.freq(base.cleaned(spark, sf)).select("token")
    return vocab.subtract(vocabulary.word_table(spark, lexicons.PROTECTED_WORDS))


@query("set3_subset_test", """SELECT (SELECT count(*) FROM vectors WHERE token IN ('good', 'great', 'terrible')) = 3 AS is_subset, count(*) AS vocabulary FROM vectors""")
def _(spark, sf):
    vec = base.vectors(base.staged(spark, sf))
    return vec.agg((F.countDistinct(F.when(F.col("token").isin("good", "great", "terrible"), F.col("token"))) == 3).alias("is_subset"),
                   F.count("*").alias("vocabulary"))


@query("set4_overlap_words", f"WITH {_TOP} SELECT Word, count(*) AS n_emotions, count(*) > 1 AS overlapping FROM tbl GROUP BY Word")
def _(spark, sf):
    words = keywords.word_emotions(base.keyword_table(spark, sf))
    return words.select("Word", "n_emotions", (F.col("n_emotions") > 1).alias("overlapping"))


