"""Vectors, splits, evaluation, keywords and prediction tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.operators import embeddings, ensemble, evaluation, keywords, prediction, splits, vocabulary
from moodlens.operators.cleaning import tokens_long
from moodlens.plans import base, twin
from moodlens.plans.catalog_stats import _ALL_METRICS, _ENS_SCORED, _KEY1, _POL, _SIF, _TOP, _auc_sql, _dot
from moodlens.plans.registry import query
from moodlens.plans.twin import r
from moodlens.sources import derived

NAMES = list(lexicons.EMOTIONS)
DIM = 8

# --- embeddings ----------------------------------------------------------------------------------


@query("emb3_frequent_subsampling", """WITH p AS (SELECT review_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM cleaned),
 f AS (SELECT token, n, sqrt(0.001::DOUBLE / (n / (SELECT sum(n) FROM token_freq))) + 0.001::DOUBLE / (n / (SELECT sum(n) FROM token_freq)) AS keep FROM token_freq)
 SELECT p.token, count(*) AS n FROM p JOIN f ON p.token = f.token
 WHERE f.keep >= 1 OR CAST('0x' || substr(md5(concat(p.review_id, ':', p.pos, ':42')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < f.keep GROUP BY p.token""")
def _(spark, sf):
    toks = tokens_long(base.staged(spark, sf), "review_id")
    return embeddings.subsample_frequent(toks, 1e-3, 42).groupBy("token").agg(F.count("*").alias("n"))


@query("emb3_subsampled_reviews", """WITH f AS (SELECT token, sqrt(0.001::DOUBLE / (n / (SELECT sum(n) FROM token_freq))) + 0.001::DOUBLE / (n / (SELECT sum(n) FROM token_freq)) AS keep FROM token_freq),
 p AS (SELECT review_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM cleaned),
 k AS (SELECT p.review_id, p.token, p.pos FROM p JOIN f ON p.token = f.token
 WHERE f.keep >= 1 OR CAST('0x' || substr(md5(concat(p.review_id, ':', p.pos, ':42')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < f.keep)
 SELECT c.review_id, count(k.token) AS n_left, md5(coalesce(string_agg(k.token, ' ' ORDER BY k.pos), '')) AS tokens_md5 FROM cleaned c LEFT JOIN k ON c.review_id = k.review_id GROUP BY c.review_id""")
def _(spark, sf):
    left = embeddings.subsample_rows(base.staged(spark, sf, "review_id", "tokens"), 1e-3, 42)
    return left.select("review_id", F.size("tokens").cast("long").alias("n_left"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("emb5_sif_weights", f"WITH {_SIF} SELECT token, n, {r('w')} AS weight FROM sif")
def _(spark, sf):
    train = base.split(base.staged(spark, sf)).filter(F.col("split") == "train")
    return embeddings.sif_weights(base.freq(train))


def _comp(e: str) -> str:
    return f"list_transform(range(1, {DIM + 1}), lambda i: {e})"


_DV = """dv AS (SELECT c.review_id, c.Emotion, c.split, d.dim, coalesce(h.n_in, 0) AS n_in, coalesce(h.x, 0) AS x FROM split c
 JOIN (SELECT unnest(range(8)) AS dim) d ON TRUE LEFT JOIN (
 SELECT t.review_id, g.dim, sum(t.c * v.vector[g.dim + 1] * {w}) / sum(t.c) AS x, sum(t.c) AS n_in FROM (SELECT review_id, token, count(*) AS c FROM toks GROUP BY ALL) t
 JOIN vectors v ON t.token = v.token JOIN (SELECT unnest(range(8)) AS dim) g ON TRUE {extra} GROUP BY t.review_id, g.dim) h ON c.review_id = h.review_id AND d.dim = h.dim)"""
_MEAN_DV = _DV.format(w="1", extra="")
_SIF_DV = _DV.format(w="coalesce(s.w, 1)", extra="LEFT JOIN sif s ON t.token = s.token")
_NORM_DV = f"{_MEAN_DV}, nv AS (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY review_id)) AS nrm FROM dv)"


def _doc_vectors(spark, sf, sif=False, l2=False):
    df = base.written(spark, sf)
    weights = None
    if sif:
        weights = embeddings.sif_weights(base.freq(base.split(df).filter(F.col("split") == "train")))
    return df, embeddings.document_vectors(df, base.vectors(df), DIM, weights, l2, written=True)


@query("emb6_document_vectors", f"WITH {_MEAN_DV} SELECT review_id, dim, n_in::BIGINT AS n_in_vocab, {r('x')} AS value FROM dv")
def _(spark, sf):
    return base.long_vectors(_doc_vectors(spark, sf)[1], "features", "review_id", "n_in_vocab")


@query("emb6_sif_document_vectors", f"WITH {_SIF}, {_SIF_DV} SELECT review_id, dim, {r('x')} AS value FROM dv")
def _(spark, sf):
    return base.long_vectors(_doc_vectors(spark, sf, sif=True)[1], "features", "review_id")


@query("emb8_l2_normalise", f"WITH {_NORM_DV} SELECT review_id, dim, {r('x / (nrm + 1e-12::DOUBLE)')} AS value FROM nv")
def _(spark, sf):
    return base.long_vectors(_doc_vectors(spark, sf, l2=True)[1], "features", "review_id")


@query("emb9_embedding_quality", f"""WITH {_MEAN_DV}, q AS (SELECT review_id, sqrt(sum(x * x)) AS nrm, count(*) FILTER (x <> 0) AS nz FROM dv GROUP BY review_id)
 SELECT count(*) AS n_rows, count(*) FILTER (nz = 0) AS zero_vectors, {r('count(*) FILTER (nz = 0) * 100.0 / count(*)')} AS zero_pct, {r('avg(nrm)')} AS mean_norm,
 {r('stddev_pop(nrm)')} AS std_norm, {r('avg(nz)')} AS mean_nonzero_dims, {r('avg(nz) / 8')} AS utilisation, count(*) FILTER (nz = 0) > count(*) * 0.1 AS many_zero_vectors FROM q""")
def _(spark, sf):
    return embeddings.embedding_quality(_doc_vectors(spark, sf)[1], DIM)


@query("emb9_embeddings_table_quality", f"""WITH q AS (SELECT sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS nrm, len(list_filter(embedding, lambda v: v <> 0)) AS nz FROM embeddings)
 SELECT count(*) AS n_rows, count(*) FILTER (nz = 0) AS zero_vectors, {r('count(*) FILTER (nz = 0) * 100.0 / count(*)')} AS zero_pct, {r('avg(nrm)')} AS mean_norm,
 {r('stddev_pop(nrm)')} AS std_norm, {r('avg(nz)')} AS mean_nonzero_dims, {r('avg(nz) / 64')} AS utilisation, count(*) FILTER (nz = 0) > count(*) * 0.1 AS many_zero_vectors FROM q""")
def _(spark, sf):
    df = derived.table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("features"))
    return embeddings.embedding_quality(df, 64)


@query("emb10_token_coverage", f"""WITH x AS (SELECT t.Emotion, count(*) AS total, count(v.token) AS in_vocab FROM toks t LEFT JOIN vectors v ON t.token = v.token GROUP BY t.Emotion),
 y AS (SELECT * FROM x UNION ALL SELECT '(all)', sum(total)::BIGINT, sum(in_vocab)::BIGINT FROM x)
 SELECT Emotion, in_vocab, total, {r('in_vocab / greatest(total, 1)')} AS coverage, in_vocab / greatest(total, 1) < 0.7 AS low FROM y""")
def _(spark, sf):
    df = base.staged(spark, sf)
    return embeddings.token_coverage(df, base.vectors(df).select("token"))


@query("emb11_word_cosines", f"""WITH p AS (SELECT * FROM (VALUES ('good', 'great'), ('good', 'terrible'), ('love', 'taste')) AS p(a, b))
 SELECT p.a, p.b, {r(f"{_dot('x.vector', 'y.vector')} / (sqrt({_dot('x.vector', 'x.vector')}) * sqrt({_dot('y.vector', 'y.vector')}) + 1e-12::DOUBLE)")} AS cosine
 FROM p LEFT JOIN vectors x ON p.a = x.token LEFT JOIN vectors y ON p.b = y.token""")
def _(spark, sf):
    vec = base.vectors(base.staged(spark, sf))
    return embeddings.word_cosines(vec, [("good", "great"), ("good", "terrible"), ("love", "taste")])


@query("emb12_description", "SELECT 'Word2Vec(SIF-PCrm-L2)' AS embedding, count(*) AS n_rows, CAST(8 AS BIGINT) AS dim FROM cleaned")
def _(spark, sf):
    _, dv = _doc_vectors(spark, sf)
    return dv.agg(F.count("*").alias("n_rows"), F.max(F.size("features")).alias("dim")).select(
        F.lit(embeddings.describe(True, True, True)).alias("embedding"), "n_rows", "dim")


# --- splits --------------------------------------------------------------------------------------


@query("spl1_stratified_split", "SELECT review_id, Emotion, split FROM split")
def _(spark, sf):
    return base.split(base.staged(spark, sf, "review_id", "Emotion")).select("review_id", "Emotion", "split")


@query("spl2_stratified_folds", """SELECT review_id, Emotion, (row_number() OVER (PARTITION BY Emotion ORDER BY md5(CAST(review_id AS VARCHAR) || ':42')) - 1) % 5 AS fold
 FROM split WHERE split = 'train'""")
def _(spark, sf):
    train = base.split(base.staged(spark, sf, "review_id", "Emotion")).filter(F.col("split") == "train")
    return splits.stratified_folds(train.select("review_id", "Emotion"), k=5)


@query("spl3_class_weights", f"""SELECT s.review_id, s.Emotion, {r('w.w')} AS weight FROM split s JOIN (SELECT Emotion, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w
 FROM split WHERE split = 'train' GROUP BY Emotion) w ON s.Emotion = w.Emotion WHERE s.split = 'train'""")
def _(spark, sf):
    train = base.kept(base.split(base.staged(spark, sf, "review_id", "Emotion")).filter(F.col("split") == "train").select("review_id", "Emotion"))
    return splits.with_class_weights(train)


@query("spl5_default_balancing", f"""SELECT {r('max(n) / sum(n)')} AS max_share, CASE WHEN max(n) / sum(n) > 0.6 THEN 'SMOTE' ELSE 'None' END AS method FROM (
 SELECT Emotion, count(*) AS n FROM split WHERE split = 'train' GROUP BY Emotion)""")
def _(spark, sf):
    return splits.default_balancing(base.split(base.staged(spark, sf, "review_id", "Emotion")).filter(F.col("split") == "train"))


@query("spl6_validation_splits", """WITH t AS (SELECT review_id, Emotion, row_number() OVER (PARTITION BY Emotion ORDER BY md5(CAST(review_id AS VARCHAR) || ':7')) AS rk,
 count(*) OVER (PARTITION BY Emotion) AS nc FROM split WHERE split = 'train')
 SELECT review_id, CASE WHEN rk <= round(nc * CAST(0.15 AS DOUBLE)) THEN 'validation' ELSE 'fit' END AS early_stop,
 CASE WHEN rk <= round(nc * CAST(0.2 AS DOUBLE)) THEN 'validation' ELSE 'fit' END AS ensemble FROM t""")
def _(spark, sf):
    train = base.kept(base.split(base.staged(spark, sf, "review_id", "Emotion")).filter(F.col("split") == "train").select("review_id", "Emotion"))
    out = splits.stratified_split(train, test_size=0.15, seed=7, column="early_stop", parts=("fit", "validation"))
    return splits.stratified_split(out, test_size=0.2, seed=7, column="ensemble", parts=("fit", "validation")).drop("Emotion")


# --- ensemble ------------------------------------------------------------------------------------


def _probs(spark, sf, second=False):
    return evaluation.with_prediction(derived.probabilities(spark, sf, second))


@query("mod4_ensemble", f"WITH {_ENS_SCORED} SELECT review_id, label, {r('p0')} AS p0, {r('p1')} AS p1, {r('p2')} AS p2, pred AS prediction, {r('conf')} AS confidence FROM scored3")
def _(spark, sf):
    out = ensemble.combine(_probs(spark, sf), _probs(spark, sf, True), 0.4, 0.6)
    p = F.col("probability")
    return out.select("review_id", "label", p[0].alias("p0"), p[1].alias("p1"), p[2].alias("p2"), "prediction", "confidence")


_GRID = """mix AS (SELECT w.i * 0.1::DOUBLE AS w1, a.label, a.p0 * (w.i * 0.1::DOUBLE) + b.p0 * (1 - w.i * 0.1::DOUBLE) AS p0, a.p1 * (w.i * 0.1::DOUBLE) + b.p1 * (1 - w.i * 0.1::DOUBLE) AS p1,
 a.p2 * (w.i * 0.1::DOUBLE) + b.p2 * (1 - w.i * 0.1::DOUBLE) AS p2 FROM probs a JOIN probs2 b ON a.review_id = b.review_id JOIN (SELECT unnest(range(1, 10)) AS i) w ON TRUE),
 pr AS (SELECT w1, label, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS pred FROM mix),
 pc AS (SELECT w1, c, count(*) FILTER (label = c AND pred = c) AS tp, count(*) FILTER (label = c) AS t, count(*) FILTER (pred = c) AS p
 FROM pr JOIN (SELECT unnest([0, 1, 2]) AS c) g ON TRUE GROUP BY w1, c HAVING t > 0 OR p > 0), grid AS (SELECT w1, avg(2 * tp / (p + t)) AS f1 FROM pc GROUP BY w1)"""


@query("mod5_weight_grid", f"WITH {_GRID} SELECT {r('w1')} AS w1, {r('f1')} AS f1 FROM grid")
def _(spark, sf):
    return ensemble.weight_grid(_probs(spark, sf), _probs(spark, sf, True))


@query("mod5_best_weights", f"WITH {_GRID} SELECT {r('w1')} AS w1, {r('1 - w1')} AS w2, {r('f1')} AS f1 FROM grid ORDER BY round(grid.f1, 9) DESC, grid.w1 LIMIT 1")
def _(spark, sf):
    return ensemble.best_weights(ensemble.weight_grid(_probs(spark, sf), _probs(spark, sf, True)))


# --- evaluation ----------------------------------------------------------------------------------


@query("evl1_macro_metrics", f"WITH {_ALL_METRICS} SELECT model, {r('accuracy')} AS accuracy, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1 FROM metrics")
def _(spark, sf):
    return evaluation.macro_metrics(base.model_predictions(spark, sf), ["model"])


@query("evl2_confusion_matrix", """SELECT a.c AS label, b.c AS prediction, count(s.review_id) AS n FROM (SELECT unnest([0, 1, 2]) AS c) a JOIN (SELECT unnest([0, 1, 2]) AS c) b ON TRUE
 LEFT JOIN scored s ON s.label = a.c AND s.pred = b.c GROUP BY a.c, b.c""")
def _(spark, sf):
    return evaluation.confusion_matrix(_probs(spark, sf), 3)


_PC = """pc AS (SELECT c, count(*) FILTER (label = c AND pred = c) AS tp, count(*) FILTER (label = c) AS t, count(*) FILTER (pred = c) AS p
 FROM scored JOIN (SELECT unnest([0, 1, 2]) AS c) g ON TRUE GROUP BY c HAVING t > 0 OR p > 0)"""


@query("evl3_kappa_balanced_accuracy", f"""WITH {_PC} SELECT {r('(sum(tp) / sum(t) - sum(t * p) / (sum(t) * sum(t))) / (1 - sum(t * p) / (sum(t) * sum(t)))')} AS kappa,
 {r('avg(tp / t) FILTER (t > 0)')} AS balanced_accuracy FROM pc""")
def _(spark, sf):
    return evaluation.agreement(_probs(spark, sf))


_REP = """rep AS (SELECT CASE c WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END AS name, coalesce(tp / nullif(p, 0), 0) AS precision,
 coalesce(tp / nullif(t, 0), 0) AS recall, 2 * tp / (p + t) AS f1, t AS support FROM pc)"""


@query("evl4_classification_report", f"""WITH {_PC}, {_REP} SELECT name, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, support FROM rep
 UNION ALL SELECT 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')}, sum(support)::BIGINT FROM rep
 UNION ALL SELECT 'weighted avg', {r('sum(precision * support) / sum(support)')}, {r('sum(recall * support) / sum(support)')}, {r('sum(f1 * support) / sum(support)')}, sum(support)::BIGINT FROM rep""")
def _(spark, sf):
    return evaluation.classification_report(_probs(spark, sf), NAMES)


@query("evl5_auc_per_class", f"SELECT c AS class, {r('auc')} AS auc FROM ({_auc_sql('probs')})")
def _(spark, sf):
    return evaluation.auc_per_class(_probs(spark, sf))


@query("evl5_macro_auc", f"SELECT {r('avg(auc)')} AS auc FROM ({_auc_sql('probs')})")
def _(spark, sf):
    return evaluation.macro_auc(_probs(spark, sf))


@query("evl6_roc_micro", f"""WITH e AS ({' UNION ALL '.join(f'SELECT CASE WHEN label = {c} THEN 1 ELSE 0 END AS y, p{c} AS s FROM probs' for c in range(3))}),
 g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM e GROUP BY s)
 SELECT {r('s')} AS threshold, {r('sum(neg) OVER (ORDER BY s DESC) / (SELECT sum(neg) FROM g)')} AS fpr, {r('sum(pos) OVER (ORDER BY s DESC) / (SELECT sum(pos) FROM g)')} AS tpr FROM g
 UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""")
def _(spark, sf):
    return evaluation.roc_micro(_probs(spark, sf))


@query("evl6_roc_corners", f"""WITH e AS ({' UNION ALL '.join(f'SELECT CASE WHEN label = {c} THEN 1 ELSE 0 END AS y, p{c} AS s FROM probs' for c in range(3))}),
 g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM e GROUP BY s),
 n AS (SELECT *, lead(pos) OVER (ORDER BY s DESC) AS np, lead(neg) OVER (ORDER BY s DESC) AS nn, sum(neg) OVER (ORDER BY s DESC) AS cn, sum(pos) OVER (ORDER BY s DESC) AS cp FROM g)
 SELECT {r('s')} AS threshold, {r('cn / (SELECT sum(neg) FROM g)')} AS fpr, {r('cp / (SELECT sum(pos) FROM g)')} AS tpr FROM n WHERE np IS NULL OR pos * nn <> neg * np
 UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""")
def _(spark, sf):
    return evaluation.roc_micro(_probs(spark, sf), corners=True)


@query("evl7_confidence_stats", f"SELECT {r('avg(conf)')} AS mean, {r('stddev_pop(conf)')} AS std, {r('min(conf)')} AS min, {r('max(conf)')} AS max FROM scored")
def _(spark, sf):
    return evaluation.confidence_stats(_probs(spark, sf))


@query("evl8_accuracy_interval", f"""SELECT label AS class, n, {r('a')} AS accuracy, {r('greatest(0, a - 1.959964::DOUBLE * sqrt(a * (1 - a) / n))')} AS low,
 {r('least(1, a + 1.959964::DOUBLE * sqrt(a * (1 - a) / n))')} AS high FROM (SELECT label, count(*) AS n, avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS a FROM scored GROUP BY label)""")
def _(spark, sf):
    return evaluation.class_accuracy_interval(_probs(spark, sf))


@query("evl9_predicted_counts", f"SELECT pred AS prediction, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM scored GROUP BY pred")
def _(spark, sf):
    return evaluation.predicted_counts(_probs(spark, sf))


@query("evl10_compare_results", f"""WITH {_ALL_METRICS} SELECT {r('max(f1)')} AS best_f1, {r('min(f1)')} AS worst_f1, {r('CASE WHEN min(f1) > 0 THEN (max(f1) - min(f1)) / min(f1) * 100 ELSE 0 END')} AS improvement_pct,
 CASE WHEN max(f1) > 0.6 THEN 'good' WHEN max(f1) > 0.4 THEN 'moderate' ELSE 'low' END AS tier FROM metrics""")
def _(spark, sf):
    return evaluation.compare_results(base.model_metrics(spark, sf))


@query("evl11_distinct_predictions", """SELECT count(DISTINCT pred) AS n_predicted, CASE count(DISTINCT pred) WHEN 1 THEN 'one' WHEN 3 THEN 'all' ELSE 'partial' END AS verdict
 FROM (SELECT pred FROM scored UNION ALL SELECT pred FROM scored2)""")
def _(spark, sf):
    return evaluation.distinct_predictions([_probs(spark, sf), _probs(spark, sf, True)], 3)


# --- keywords ------------------------------------------------------------------------------------


@query("key1_emotion_counts", f"SELECT Emotion, token, n FROM ({_KEY1})")
def _(spark, sf):
    return keywords.emotion_counts(base.cleaned(spark, sf), min_df=2)


@query("key1_emotion_counts_default", f"SELECT Emotion, token, n FROM ({_KEY1.replace('n_docs >= 2', 'n_docs >= 20')})")
def _(spark, sf):
    return keywords.emotion_counts(base.cleaned(spark, sf))


@query("key2_log_odds", f"WITH {_TOP} SELECT Emotion, token, n, {r('score')} AS score FROM lo")
def _(spark, sf):
    return keywords.log_odds(keywords.emotion_counts(base.cleaned(spark, sf), min_df=2), min_freq=2)


_TRAIN_TOKENS = "(SELECT review_id, Emotion, unnest(tokens) AS token FROM split WHERE split = 'train')"
_KEY1_TRAIN = f"""SELECT e.Emotion, e.token, e.n FROM (SELECT Emotion, token, count(*) AS n FROM {_TRAIN_TOKENS} GROUP BY ALL) e
 JOIN (SELECT token, count(DISTINCT review_id) AS n_docs FROM {_TRAIN_TOKENS} GROUP BY token) d ON e.token = d.token
 WHERE d.n_docs >= 2 AND e.Emotion IN ('Negative', 'Neutral', 'Positive') AND {twin.token_ok('e.token')}"""


@query("key2_log_odds_train", f"WITH {_TOP.replace(_KEY1, _KEY1_TRAIN)} SELECT Emotion, token, n, {r('score')} AS score FROM lo")
def _(spark, sf):
    train = base.split(base.staged(spark, sf)).filter(F.col("split") == "train")
    return keywords.log_odds(keywords.emotion_counts(train, min_df=2), min_freq=2)


@query("key3_polarity_gate", f"""WITH {_TOP}, pol AS ({_POL}) SELECT l.Emotion, l.token, l.n, {r('l.score')} AS score FROM lo l JOIN pol p ON l.token = p.token
 WHERE (l.Emotion = 'Positive' AND p.valence >= 0.5) OR (l.Emotion = 'Negative' AND p.valence <= -0.5) OR (l.Emotion = 'Neutral' AND abs(p.valence) <= 0.2)""")
def _(spark, sf):
    df = base.staged(spark, sf)
    scores = keywords.log_odds(keywords.emotion_counts(df, min_df=2), min_freq=2)
    return keywords.polarity_gate(scores, derived.fixture_polarity(base.freq(df)))


_CEN = """kw AS ({k}), cen AS (SELECT k.Emotion, g.dim, sum(k.n * {w} * v.vector[g.dim + 1]) / (sum(k.n * {w}) + 1e-12::DOUBLE) AS x FROM kw k JOIN vectors v ON k.token = v.token {extra}
 JOIN (SELECT unnest(range(8)) AS dim) g ON TRUE GROUP BY k.Emotion, g.dim)"""
_CEN_MEAN = _CEN.format(k=_KEY1, w="1", extra="")
_ALL_SIF = "allsif AS (SELECT token, 0.001::DOUBLE / (0.001::DOUBLE + n / (SELECT sum(n) FROM token_freq)) AS w FROM token_freq)"
_CEN_SIF = _ALL_SIF + ", " + _CEN.format(k=_KEY1, w="coalesce(s.w, 1)", extra="LEFT JOIN allsif s ON k.token = s.token")


def _centroid_parts(spark, sf, sif=False):
    df = base.staged(spark, sf)
    counts = base.kept(keywords.emotion_counts(df, min_df=2))
    vec = base.kept(base.vectors(df))
    weights = embeddings.sif_weights(base.freq(df)) if sif else None
    return counts, vec, keywords.centroids(counts, vec, DIM, weights)


@query("key4_centroids", f"WITH {_CEN_MEAN} SELECT Emotion, dim, {r('x')} AS value FROM cen")
def _(spark, sf):
    return base.long_vectors(_centroid_parts(spark, sf)[2], "centroid", "Emotion")


@query("key5_sif_centroids", f"WITH {_CEN_SIF} SELECT Emotion, dim, {r('x')} AS value FROM cen")
def _(spark, sf):
    return base.long_vectors(_centroid_parts(spark, sf, sif=True)[2], "centroid", "Emotion")


@query("key6_candidates", f"""WITH kw AS ({_KEY1}) SELECT Emotion, token, n FROM kw WHERE n >= 2 AND token IN (SELECT token FROM vectors)""")
def _(spark, sf):
    counts, vec, _ = _centroid_parts(spark, sf)
    return keywords.candidates(counts, vec, min_freq=2)


@query("key6_candidates_capped", f"""WITH kw AS ({_KEY1}) SELECT Emotion, token, n FROM (SELECT *, row_number() OVER (PARTITION BY Emotion ORDER BY n DESC, token) AS k FROM kw
 WHERE n >= 2 AND token IN (SELECT token FROM vectors)) WHERE k <= 500""")
def _(spark, sf):
    counts, vec, _ = _centroid_parts(spark, sf)
    return keywords.candidates(counts, vec, min_freq=2, max_vocab=500)


@query("key6_candidates_all_words", f"""WITH kw AS ({_KEY1}) SELECT e.Emotion, v.token, coalesce(k.n, 0) AS n FROM vectors v JOIN (SELECT DISTINCT Emotion FROM kw) e ON TRUE
 LEFT JOIN kw k ON k.Emotion = e.Emotion AND k.token = v.token WHERE {twin.token_ok('v.token')}""")
def _(spark, sf):
    counts, vec, _ = _centroid_parts(spark, sf)
    return keywords.candidates(counts, vec, emotion_only=False)


_SIM = f"""cand AS (SELECT Emotion, token, n FROM kw WHERE n >= 2 AND token IN (SELECT token FROM vectors)),
 cv AS (SELECT Emotion, list(x ORDER BY dim) AS c FROM cen GROUP BY Emotion),
 sim AS (SELECT a.Emotion, a.token, {_dot('v.vector', 'cv.c')} / (sqrt({_dot('cv.c', 'cv.c')}) + 1e-12::DOUBLE) / (sqrt({_dot('v.vector', 'v.vector')}) + 1e-12::DOUBLE) AS score
 FROM cand a JOIN vectors v ON a.token = v.token JOIN cv ON a.Emotion = cv.Emotion),
 scl AS (SELECT *, row_number() OVER (PARTITION BY Emotion ORDER BY round(score, 9) DESC, token) AS Rank FROM sim QUALIFY Rank <= 180)"""


def _similarities(spark, sf):
    counts, vec, cen = _centroid_parts(spark, sf)
    return keywords.centroid_similarity(keywords.candidates(counts, vec, min_freq=2), vec, cen)


@query("key7_centroid_similarity", f"WITH {_CEN_MEAN}, {_SIM} SELECT Emotion, token AS Word, {r('score')} AS score, Rank FROM scl")
def _(spark, sf):
    rank = F.row_number().over(Window.partitionBy("Emotion").orderBy(F.desc(F.round("score", 9)), "token"))
    return _similarities(spark, sf).withColumn("Rank", rank).filter(F.col("Rank") <= 180).select(
        "Emotion", F.col("token").alias("Word"), "score", "Rank")


@query("key8_shifted_weights", f"""WITH {_CEN_MEAN}, {_SIM} SELECT Emotion, token AS Word, {r('CASE WHEN min(score) OVER (PARTITION BY Emotion) < 0 THEN score - min(score) OVER (PARTITION BY Emotion) + 0.001 ELSE score END')} AS Weight, Rank FROM scl""")
def _(spark, sf):
    return keywords.cloud(_similarities(spark, sf))


@query("key9_cloud_weights", f"WITH {_TOP} SELECT Emotion, Rank, Word, {r('Weight')} AS Weight FROM wt WHERE Weight > 0 AND Word NOT IN {twin.in_list(lexicons.hidden_words())}")
def _(spark, sf):
    return keywords.render_weights(base.keyword_weights(spark, sf))


@query("key10_table_stats", f"""WITH {_TOP} SELECT count(*) AS total_words, {r('avg(Weight)')} AS mean_weight, count(DISTINCT Word) AS unique_words,
 {r('(1 - count(DISTINCT Word) / count(*)) * 100')} AS overlap_pct FROM tbl""")
def _(spark, sf):
    return keywords.table_stats(base.keyword_table(spark, sf))


@query("key11_overlapping_words", f"WITH {_TOP} SELECT Word, count(*) AS n_emotions, string_agg(Emotion, ',' ORDER BY Emotion) AS emotions FROM tbl GROUP BY Word HAVING count(*) > 1 ORDER BY n_emotions DESC, Word LIMIT 20")
def _(spark, sf):
    return keywords.overlapping_words(base.keyword_table(spark, sf))


@query("key11_discriminative_words", f"""WITH {_TOP} SELECT Emotion, row_number() OVER (PARTITION BY Emotion ORDER BY Rank) AS place, Word FROM (
 SELECT *, count(*) OVER (PARTITION BY Word) AS c FROM tbl) WHERE c = 1 QUALIFY place <= 5""")
def _(spark, sf):
    return keywords.discriminative_words(base.keyword_table(spark, sf))


@query("key12_quality_checks", f"""WITH {_TOP}, u AS (SELECT count(DISTINCT Word) AS unique_words, count(*) AS n, (SELECT min(c) / max(c) FROM (SELECT count(*) AS c FROM tbl GROUP BY Emotion)) AS balance,
 (SELECT count(*) FILTER (c < 20) FROM (SELECT count(*) AS c FROM wt GROUP BY Emotion)) AS small_clouds FROM tbl)
 SELECT unique_words, {r('balance')} AS balance, {r('(n - unique_words) / n')} AS overlap_rate, small_clouds,
 CASE WHEN unique_words > 100 THEN 'good' WHEN unique_words > 50 THEN 'moderate' ELSE 'low' END AS diversity,
 CASE WHEN balance > 0.7 THEN 'good' WHEN balance > 0.4 THEN 'moderate' ELSE 'low' END AS balance_tier,
 CASE WHEN (n - unique_words) / n < 0.2 THEN 'low' WHEN (n - unique_words) / n < 0.4 THEN 'moderate' ELSE 'high' END AS overlap_tier,
 concat_ws(',', CASE WHEN unique_words < 50 THEN 'reduce filtering,check preprocessing' END, CASE WHEN (n - unique_words) / n > 0.4 THEN 'try another method,raise frequency thresholds' END,
 CASE WHEN small_clouds > 0 THEN 'check class balance,verify preprocessing' END) AS recommendations FROM u""")
def _(spark, sf):
    weights = base.kept(base.keyword_weights(spark, sf))
    return keywords.quality_checks(keywords.keyword_table(weights), weights)


# --- prediction ----------------------------------------------------------------------------------

_LBL = "CASE {} WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END"


@query("prd2_confidence_columns", f"""SELECT review_id, {_LBL.format('pred')} AS Predicted_Emotion, {r('conf')} AS Confidence, {r('p0')} AS "Prob_Negative", {r('p1')} AS "Prob_Neutral",
 {r('p2')} AS "Prob_Positive" FROM scored""")
def _(spark, sf):
    out = prediction.label_predictions(derived.probabilities(spark, sf), NAMES, True, True)
    return out.drop("label", "probability")


@query("prd4_ranked_probabilities", f"""SELECT review_id, row_number() OVER (PARTITION BY review_id ORDER BY p DESC, c) AS rank, {_LBL.format('c')} AS label, {r('p')} AS probability FROM (
 SELECT review_id, 0 AS c, p0 AS p FROM probs UNION ALL SELECT review_id, 1, p1 FROM probs UNION ALL SELECT review_id, 2, p2 FROM probs)""")
def _(spark, sf):
    return prediction.ranked_probabilities(derived.probabilities(spark, sf), NAMES)


@query("prd5_confidence_tier", "SELECT review_id, CASE WHEN conf >= 0.8 THEN 'high' WHEN conf >= 0.6 THEN 'moderate' WHEN conf >= 0.4 THEN 'low' ELSE 'very low' END AS tier FROM scored")
def _(spark, sf):
    return derived.probabilities(spark, sf).select("review_id", prediction.confidence_tier(F.array_max("probability")).alias("tier"))


@query("prd6_batch_summary", f"SELECT {_LBL.format('pred')} AS Predicted_Emotion, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM scored GROUP BY 1")
def _(spark, sf):
    return prediction.batch_summary(prediction.label_predictions(derived.probabilities(spark, sf), NAMES))


@query("prd7_batch_quality", f"""SELECT {r('avg(conf)')} AS mean_confidence, count(*) FILTER (conf >= 0.8) AS n_high, count(*) FILTER (conf < 0.6) AS n_low,
 {r('count(*) FILTER (conf < 0.6) * 100.0 / count(*)')} AS pct_low FROM scored""")
def _(spark, sf):
    return prediction.batch_quality(prediction.label_predictions(derived.probabilities(spark, sf), NAMES))


@query("prd9_history_analytics", f"""SELECT count(*) AS n_predictions, {r('avg(confidence)')} AS mean_confidence, (SELECT prediction FROM history GROUP BY prediction ORDER BY count(*) DESC, prediction LIMIT 1) AS most_common,
 {r('avg(vocab_coverage)')} AS mean_coverage FROM history""")
def _(spark, sf):
    return prediction.history_analytics(derived.history(spark, sf))


@query("prd10_vocabulary_probe", f"""SELECT p.token, v.n IS NOT NULL AS found, coalesce(v.n, 0) AS n FROM (SELECT unnest([{', '.join(twin.lit(w) for w in lexicons.PROBE_WORDS)}]) AS token) p
 LEFT JOIN (SELECT token, n FROM token_freq WHERE n >= 2) v ON p.token = v.token""")
def _(spark, sf):
    freq = base.freq(base.cleaned(spark, sf)).filter(F.col("n") >= 2)
    return vocabulary.probe(freq)


