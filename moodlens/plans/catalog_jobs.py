"""Jobs that write tables, train models or run streams.

Training settings are small so that the checks stay quick; the tables are always read whole. What can be
stated in SQL about a result (who is in the vocabulary, class sizes, which rows were scored) has a twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions import labels
from moodlens.functions import vectors as V
from moodlens.operators import embeddings, models, negative_sampling, neighbours, prediction, smote, splits
from moodlens.plans import base, training, twin
from moodlens.plans.catalog_stats import _ALL_METRICS, _TOP
from moodlens.plans.registry import QUERIES, query
from moodlens.plans.twin import r
from moodlens.session import cut_lineage, scratch_path
from moodlens.sources import derived, sinks
from moodlens.sources import reviews as src
from moodlens.streaming import jobs

NAMES = list(lexicons.EMOTIONS)
FOREST = models.ForestOptions(trees=10, max_depth=5)
BOOST = models.BoostOptions(rounds=3, max_depth=3)
TRAIN = training.TrainOptions(vector_size=16, window=3, min_count=5, epochs=1, sample=0.0, folds=0, early_stop=False,
                              optimise_weights=False, balancing="None", forest=FOREST, boost=BOOST)
_memo: dict = {}


def _once(spark, sf, what, make):
    """Trained once per session and data folder, as several queries look at the same run."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _memo:
        _memo[key] = make()
    return _memo[key]


def _trained(spark, sf) -> training.Results:
    return _once(spark, sf, "train", lambda: training.train_and_evaluate(base.written(spark, sf), TRAIN))


def _vectors_table(spark, sf):
    """The labelled vectors of the ``embeddings`` table with a hold-out split."""
    df = derived.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("review_id"), "label", F.col("embedding").cast("array<double>").alias("features"))
    return base.kept(splits.stratified_split(src.spread_small_input(df, "review_id"), "label"))


_EMB_SPLIT = """SELECT vec_id, label, CASE WHEN rk <= round(nc * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM (
 SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42')) AS rk, count(*) OVER (PARTITION BY label) AS nc FROM embeddings)"""


# --- sinks ---------------------------------------------------------------------------------------


@query("snk2_metrics_csv", f"WITH {_ALL_METRICS} SELECT model, {r('accuracy')} AS accuracy, {r('f1')} AS f1, {r('auc')} AS auc FROM metrics")
def _(spark, sf):
    path = sinks.write_metrics(base.model_metrics(spark, sf), scratch_path(spark, "metrics"))
    return src.read_csv(spark, path).select("model", *[F.col(c).cast("double").alias(c) for c in ("accuracy", "f1", "auc")])


@query("snk3_keywords_csv", f"WITH {_TOP} SELECT Emotion, Rank, Word, {r('Weight')} AS Weight FROM tbl")
def _(spark, sf):
    path = sinks.write_keywords(base.keyword_table(spark, sf), scratch_path(spark, "keywords"))
    return src.read_csv(spark, path).select("Emotion", F.col("Rank").cast("int").alias("Rank"), "Word", F.col("Weight").cast("double").alias("Weight"))


@query("snk4_predictions_csv", f"""SELECT review_id, CASE pred WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END AS Predicted_Emotion,
 {r('conf')} AS Confidence, 'Ensemble' AS model_used, TRUE AS stamped FROM scored""")
def _(spark, sf):
    out = prediction.label_predictions(derived.probabilities(spark, sf), NAMES).drop("label", "probability")
    back = src.read_csv(spark, sinks.write_predictions(out, scratch_path(spark, "predictions"), "Ensemble"))
    return back.select(F.col("review_id").cast("long").alias("review_id"), "Predicted_Emotion", F.col("Confidence").cast("double").alias("Confidence"),
                       "model_used", F.col("prediction_timestamp").isNotNull().alias("stamped"))


@query("snk5_history_csv", f"SELECT review_id, prediction, model, {r('confidence')} AS confidence FROM history")
def _(spark, sf):
    back = src.read_csv(spark, sinks.write_history(derived.history(spark, sf), scratch_path(spark, "history")))
    return back.select(F.col("review_id").cast("long").alias("review_id"), "prediction", "model", F.col("confidence").cast("double").alias("confidence"))


@query("snk6_stage_tables", "SELECT review_id, Emotion, split, n_tokens FROM split")
def _(spark, sf):
    cols = ["review_id", "Emotion", "tokens", "n_tokens"]
    stage = sinks.save_stage(base.cleaned(spark, sf).select(*cols), scratch_path(spark, "clean"))
    second = sinks.save_stage(splits.stratified_split(stage, "Emotion"), scratch_path(spark, "split"))
    return second.select("review_id", "Emotion", "split", "n_tokens")


# --- word and document vectors -------------------------------------------------------------------

_TRAIN_VOCAB = """SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM split WHERE split = 'train') GROUP BY token HAVING count(*) >= 5"""


def _train_rows(spark, sf):
    return base.split(base.written(spark, sf)).filter(F.col("split") == "train").select("review_id", "tokens")


def _sampled(architecture):
    return negative_sampling.SamplingOptions(architecture=architecture, size=16, window=3, negative=4, rounds=2, chunk_tokens=40_000)


def _moved(df, key):
    """Training changed the start vector, which depends on the key alone, by more than single precision rounds."""
    start = negative_sampling._start_vector(F.col(key).cast("string"), 16, 42)
    change = F.aggregate(F.zip_with("vector", start, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda a, x: F.greatest(a, x))
    return df.select(key, F.size("vector").alias("dim"), (change > 1e-8).alias("moved"))


@query("emb1_word2vec", f"SELECT token, CAST(16 AS BIGINT) AS dim, TRUE AS moved FROM ({_TRAIN_VOCAB})")
def _(spark, sf):
    options = training.TrainOptions(vector_size=16, window=3, min_count=5, epochs=2, chunk_tokens=500_000)
    return _moved(training.fit_word_vectors(_train_rows(spark, sf), options), "token")


@query("emb2_cbow", f"SELECT token, CAST(16 AS BIGINT) AS dim, TRUE AS moved FROM ({_TRAIN_VOCAB})")
def _(spark, sf):
    return _moved(negative_sampling.fit_vectors(_train_rows(spark, sf), _sampled("cbow"))[0], "token")


@query("emb2_skipgram_negative", f"SELECT token, CAST(16 AS BIGINT) AS dim, TRUE AS moved FROM ({_TRAIN_VOCAB})")
def _(spark, sf):
    return _moved(negative_sampling.fit_vectors(_train_rows(spark, sf), _sampled("skipgram"))[0], "token")


@query("emb4_document_context", f"""WITH tv AS ({_TRAIN_VOCAB}) SELECT review_id, CAST(16 AS BIGINT) AS dim, list_has_any(tokens, (SELECT list(token) FROM tv)) AS moved
 FROM split WHERE split = 'train'""")
def _(spark, sf):
    return _moved(negative_sampling.fit_vectors(_train_rows(spark, sf), _sampled("document"))[1], "review_id")


@query("emb7_remove_principal_component", f"""SELECT vec_id AS review_id, split, CAST(0 AS DOUBLE) AS along_direction FROM ({_EMB_SPLIT})""")
def _(spark, sf):
    df = _vectors_table(spark, sf)
    u = embeddings.principal_direction(df.filter(F.col("split") == "train"))
    along = V.dot(F.col("features"), F.array(*[F.lit(x) for x in u]))
    return embeddings.remove_direction(df, u).select("review_id", "split", along.alias("along_direction"))


# --- balancing and models --------------------------------------------------------------------------


@query("spl4_smote", f"""WITH c AS (SELECT label, count(*) AS n FROM ({_EMB_SPLIT}) WHERE split = 'train' GROUP BY label)
 SELECT label, FALSE AS synthetic, n, CAST(0 AS BIGINT) AS off_segment FROM c UNION ALL
 SELECT label, TRUE, (SELECT max(n) FROM c) - n, CAST(0 AS BIGINT) FROM c WHERE n < (SELECT max(n) FROM c)""")
def _(spark, sf):
    train = _vectors_table(spark, sf).filter(F.col("split") == "train").select(F.col("review_id").alias("id"), "label", "features")
    out = cut_lineage(smote.smote(train))
    ends = train.select(F.col("id"), F.col("label").alias("l"), F.col("features").alias("f"))
    pairs = out.join(ends.toDF("base", "lb", "x"), "base", "left").join(ends.toDF("neighbour", "ln", "y"), "neighbour", "left")
    gap = lambda a, b: V.norm(F.zip_with(a, b, lambda p, q: p - q))
    detour = gap(F.col("x"), F.col("features")) + gap(F.col("features"), F.col("y")) - gap(F.col("x"), F.col("y"))
    wrong = F.col("synthetic") & ((F.col("lb") != F.col("label")) | (F.col("ln") != F.col("label")) | (detour > 1e-6))
    return pairs.groupBy("label", "synthetic").agg(F.count("*").alias("n"), F.count_if(wrong).alias("off_segment"))


@query("spl4_nearest_rows", """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
 k AS (SELECT a.vec_id AS id, a.label, b.vec_id AS neighbour, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
 FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id) SELECT id, label, rank, neighbour FROM k WHERE rank <= 5""")
def _(spark, sf):
    # classes of the small tables fit into one leaf, where the forest is exact
    rows = derived.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("features"))
    return neighbours.nearest(rows, 5).select("id", "label", F.col("rank").cast("long").alias("rank"), "neighbour")


def _proper(df):
    total = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
    return df.select("review_id", "label", F.size("probability").alias("n_classes"), total.alias("total_probability"))


_PROPER = f"SELECT vec_id AS review_id, label, CAST(10 AS BIGINT) AS n_classes, CAST(1 AS DOUBLE) AS total_probability FROM ({_EMB_SPLIT}) WHERE split = 'test'"


def _part(df, split):
    return df.filter(F.col("split") == split).select("review_id", "label", "features")


@query("mod1_random_forest", _PROPER)
def _(spark, sf):
    df = _vectors_table(spark, sf)
    return _proper(models.fit_forest(_part(df, "train"), FOREST).predict(_part(df, "test")))


@query("mod1_weighted_random_forest", _PROPER)
def _(spark, sf):
    df = _vectors_table(spark, sf)
    rows, weight = models.balanced(_part(df, "train"), "Class weights")
    return _proper(models.fit_forest(rows, FOREST, weight).predict(_part(df, "test")))


@query("mod2_boosting", """SELECT review_id, label, k AS n_classes, CAST(1 AS DOUBLE) AS total_probability FROM (
 SELECT review_id, split, dense_rank() OVER (ORDER BY Emotion) - 1 AS label, (SELECT count(DISTINCT Emotion) FROM split) AS k FROM split) WHERE split = 'test'""")
def _(spark, sf):
    # clipping to [1e-8, 1 - 1e-8] moves the total by less than the rounding
    return _proper(_trained(spark, sf).of(training.BOOSTING))


@query("mod3_early_stopping", "SELECT 'fit' AS part, count(*) AS n_classes FROM (SELECT DISTINCT Emotion FROM cleaned)")
def _(spark, sf):
    dv = training.featurise_corpus(base.written(spark, sf), TRAIN)[0]
    k = dv.select("label").distinct().count()
    train = _part(dv, "train")
    rows, weight = models.with_validation(train, "None")
    fitted = models.fit_boosting(rows, k, models.BoostOptions(rounds=4, max_depth=2, tolerance=0.05), weight, "_held")
    scored = fitted.predict(_part(dv, "test"))
    return scored.agg(F.max(F.size("probability")).alias("n_classes")).select(F.lit("fit").alias("part"), "n_classes")


def _judged(df, train):
    """Rows, and whether the predictions are better than the largest class and than equal probabilities."""
    largest = train.groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("share"))
    loss = -F.log(F.get("probability", F.col("label").cast("int")))
    found = df.agg(F.count("*").alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                   F.avg(loss).alias("loss"), F.max(F.size("probability")).alias("k"))
    # one row each
    return found.crossJoin(F.broadcast(largest)).select(
        "n", (F.col("accuracy") > F.col("share")).alias("beats_largest_class"), (F.col("loss") < F.log("k")).alias("beats_equal_odds"))


# judged on the rows they learned from: the labels of this table say little about the rows that were held out
_BETTER = f"SELECT count(*) AS n, TRUE AS beats_largest_class, TRUE AS beats_equal_odds FROM ({_EMB_SPLIT}) WHERE split = 'train'"


@query("mod1_forest_accuracy", _BETTER)
def _(spark, sf):
    df = _vectors_table(spark, sf)
    train = _part(df, "train")
    return _judged(models.clip(models.fit_forest(train, models.ForestOptions(trees=30, max_depth=8)).predict(train)), train)


@query("mod2_softmax_accuracy", _BETTER)
def _(spark, sf):
    df = _vectors_table(spark, sf)
    train = _part(df, "train")
    return _judged(models.fit_boosting(train, 10, models.BoostOptions(rounds=8, max_depth=3, step=0.3, bins=32)).predict(train), train)


@query("mod3_best_round", "SELECT TRUE AS kept_to_the_least_loss, TRUE AS waited_for_patience, TRUE AS loss_recomputed")
def _(spark, sf):
    o = models.BoostOptions(rounds=12, max_depth=3, step=0.5, patience=2, bins=32)
    rows, weight = models.with_validation(_part(_vectors_table(spark, sf), "train"), "None")
    fitted = models.fit_boosting(rows, 10, o, weight, "_held")
    least = min(fitted.losses)
    scored = fitted.predict(rows.filter("_held"))
    return scored.agg(F.avg(-F.log(F.get("probability", F.col("label").cast("int")))).alias("loss")).select(
        F.lit(fitted.losses.index(least) + 1 == fitted.rounds).alias("kept_to_the_least_loss"),
        F.lit(len(fitted.losses) == min(fitted.rounds + o.patience, o.rounds)).alias("waited_for_patience"),
        (F.abs(F.col("loss") - least) < 1e-9).alias("loss_recomputed"))


@query("mod6_cross_validation", f"""SELECT label, (rk - 1) % 3 AS fold, count(*) AS n FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42')) AS rk
 FROM ({_EMB_SPLIT}) WHERE split = 'train') GROUP BY ALL""")
def _(spark, sf):
    train = _part(_vectors_table(spark, sf), "train")
    out = models.cross_validate(train, lambda rows, weight: models.fit_forest(rows, FOREST, weight), k=3)
    return out.groupBy("label", "fold").agg(F.count("*").alias("n"))


@query("mod6_cv_metrics")
def _(spark, sf):
    train = _part(_vectors_table(spark, sf), "train")
    return models.cv_metrics(models.cross_validate(train, lambda rows, weight: models.fit_forest(rows, FOREST, weight), k=3))


@query("mod6_cv_in_range", "SELECT 3 AS folds, TRUE AS in_range, TRUE AS better_than_chance")
def _(spark, sf):
    train = _part(_vectors_table(spark, sf), "train")
    found = models.cv_metrics(models.cross_validate(train, lambda rows, weight: models.fit_forest(rows, FOREST, weight), k=3))
    each = [F.col(c) for c in ("precision", "recall", "f1", "auc")]
    return found.select("folds", ((F.least(*each) >= 0) & (F.greatest(*each) <= 1)).alias("in_range"), (F.col("auc") > 0.5).alias("better_than_chance"))


@query("mod6_cv_recomputed", "SELECT unnest(['auc', 'f1', 'precision', 'recall']) AS metric, TRUE AS same")
def _(spark, sf):
    """The metrics of written predictions, class by class, without the library's own operators.

    The AUC counts the pairs of a class's rows with all others by running totals over the distinct probabilities: the rows
    below, in 4,097 ranges of probability and then inside a range, and half of those that are equal.
    """
    train = _part(_vectors_table(spark, sf), "train")
    out = cut_lineage(models.cross_validate(train, lambda rows, weight: models.fit_forest(rows, FOREST, weight), k=3))
    out.createOrReplaceTempView("cv_predictions")
    plain = spark.sql("""
      WITH c AS (SELECT DISTINCT fold, label AS c FROM cv_predictions),
      m AS (SELECT c.fold, c.c, sum(int(p.label = c AND p.prediction = c)) AS tp, sum(int(p.label = c)) AS t, sum(int(p.prediction = c)) AS p
        FROM c JOIN cv_predictions p ON p.fold = c.fold GROUP BY c.fold, c.c),
      f AS (SELECT fold, avg(coalesce(tp / nullif(p, 0), 0)) AS precision, avg(tp / t) AS recall, avg(2 * tp / (p + t)) AS f1 FROM m GROUP BY fold),
      v AS (SELECT x.fold, c.c AS label, x.probability[c.c] AS s, sum(int(x.label = c.c)) AS pos, sum(int(x.label <> c.c)) AS neg
        FROM cv_predictions x JOIN c ON x.fold = c.fold GROUP BY x.fold, c.c, x.probability[c.c]),
      g AS (SELECT fold, label, floor(s * 4096) AS g, sum(neg) AS neg FROM v GROUP BY fold, label, floor(s * 4096)),
      b AS (SELECT fold, label, g, sum(neg) OVER (PARTITION BY fold, label ORDER BY g) - neg AS below FROM g),
      w AS (SELECT v.fold, v.label, v.pos, v.neg, b.below + sum(v.neg) OVER (PARTITION BY v.fold, v.label, b.g ORDER BY v.s) - v.neg / 2D AS won
        FROM v JOIN b ON v.fold = b.fold AND v.label = b.label AND floor(v.s * 4096) = b.g),
      a AS (SELECT fold, label, sum(pos * won) / nullif(sum(pos) * double(sum(neg)), 0) AS auc FROM w GROUP BY fold, label)
      SELECT avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, (SELECT avg(auc) FROM (SELECT fold, avg(auc) AS auc FROM a GROUP BY fold)) AS auc FROM f""")
    names = ["auc", "f1", "precision", "recall"]
    long = lambda df, v: df.unpivot([], names, "metric", v)
    both = long(models.cv_metrics(out).select(*names), "a").join(long(plain.select(*names), "b"), "metric")
    return both.select("metric", (F.abs(F.col("a") - F.col("b")) < 1e-9).alias("same"))


@query("top7_strict_order", "SELECT range + 1 AS place, TRUE AS in_order FROM range(15)")
def _(spark, sf):
    values = _trained(spark, sf).importances[training.BOOSTING]
    want = sorted(((-v, f"dim_{i}") for i, v in enumerate(values)))[:15]
    top = [(r["feature"], r["importance"]) for r in models.importance_table(spark, values, 15).collect()]
    marks = [(k + 1, top[k][0] == name and top[k][1] == -v) for k, (v, name) in enumerate(want)]
    return spark.createDataFrame(marks, "place long, in_order boolean")


@query("mod7_importance_rules", "SELECT 'Random Forest' AS model, 16 AS n_features, 1.0::DOUBLE AS total, 0 AS n_negative UNION ALL SELECT 'Boosting', 16, 1.0::DOUBLE, 0")
def _(spark, sf):
    run, parts = _trained(spark, sf), []
    for name in (training.FOREST, training.BOOSTING):
        parts.append(models.importance_table(spark, run.importances[name]).agg(
            F.count("*").alias("n_features"), F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("n_negative")
        ).select(F.lit(name).alias("model"), "n_features", "total", "n_negative"))
    return parts[0].unionByName(parts[1])


@query("top7_importance_order", "SELECT 15 AS n, 15 AS n_distinct, TRUE AS not_below_the_rest")
def _(spark, sf):
    values = _trained(spark, sf).importances[training.BOOSTING]
    top = models.importance_table(spark, values, 15)
    return top.agg(F.count("*").alias("n"), F.count_distinct("feature").alias("n_distinct"), (F.min("importance") >= sorted(values)[0]).alias("not_below_the_rest"))


@query("mod7_importances")
def _(spark, sf):
    return models.importance_table(spark, _trained(spark, sf).importances[training.FOREST])


@query("top7_top_importances")
def _(spark, sf):
    return models.importance_table(spark, _trained(spark, sf).importances[training.BOOSTING], 15)


FULL = training.TrainOptions(vector_size=16, window=3, min_count=5, epochs=1, folds=2, balancing="Class weights", use_sif=True, remove_pc=True,
                             forest=FOREST, boost=models.BoostOptions(rounds=4, max_depth=3, patience=2))


@query("mod8_all_parts", """WITH codes AS (SELECT Emotion, dense_rank() OVER (ORDER BY Emotion) - 1 AS label FROM (SELECT DISTINCT Emotion FROM split))
 SELECT m.model, c.label, count(*) AS n, TRUE AS proper FROM split s JOIN codes c ON s.Emotion = c.Emotion JOIN (VALUES ('Random Forest'), ('Boosting'), ('Ensemble')) AS m(model) ON TRUE
 WHERE s.split = 'test' GROUP BY ALL""")
def _(spark, sf):
    # subsampling, weighting, component removal, cross-validation, class weights, early stopping and weight search
    run = training.train_and_evaluate(base.written(spark, sf), FULL)
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    marked = run.predictions.withColumn("ok", F.abs(total - 1) < 1e-4)
    return marked.groupBy("model", "label").agg(F.count("*").alias("n"), F.bool_and("ok").alias("proper"))


@query("mod8_smote_run", f"""SELECT m.model, label, count(*) AS n, TRUE AS proper FROM ({_EMB_SPLIT}) s
 JOIN (VALUES ('Random Forest', 'train'), ('Boosting', 'test')) AS m(model, split) ON s.split = m.split GROUP BY ALL""")
def _(spark, sf):
    # oversampling inside the folds of a cross-validation, and before a final fit that stops on real held-out rows
    df = _vectors_table(spark, sf)
    folds = models.cross_validate(_part(df, "train"), lambda rows, weight: models.fit_forest(rows, FOREST, weight), k=2, method="SMOTE")
    rows, weight = models.with_validation(_part(df, "train"), "SMOTE")
    fitted = models.fit_boosting(rows, 10, models.BoostOptions(rounds=4, max_depth=3, patience=2, bins=32), weight, "_held")
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    parts = [
        d.select("label", (F.abs(total - 1) < 1e-4).alias("ok"), F.lit(name).alias("model"))
        for name, d in ((training.FOREST, folds), (training.BOOSTING, fitted.predict(_part(df, "test"))))
    ]
    return parts[0].unionByName(parts[1]).groupBy("model", "label").agg(F.count("*").alias("n"), F.bool_and("ok").alias("proper"))


def _scorer(spark, sf) -> training.Scorer:
    def make():
        path = _trained(spark, sf).scorer.save(scratch_path(spark, "scorer"))
        return training.Scorer.load(spark, path)

    return _once(spark, sf, "scorer", make)


@query("mod8_model_persistence", "SELECT count(*) AS n, count(*) AS n_same FROM reviews")
def _(spark, sf):
    df = base.reviews(spark, sf).select("review_id", "Text")
    cols = ["review_id", "Predicted_Emotion", F.round("Confidence", 9).alias("c")]
    before = _trained(spark, sf).scorer.score(df).select(*cols)
    after = _scorer(spark, sf).score(df).select(*cols).toDF("review_id", "e2", "c2")
    same = (F.col("Predicted_Emotion") == F.col("e2")) & (F.col("c") == F.col("c2"))
    return before.join(after, "review_id").agg(F.count("*").alias("n"), F.count_if(same).alias("n_same"))


# --- scoring -------------------------------------------------------------------------------------

_TEXT_TOKENS = twin.keep_tokens(twin.split_words(twin.collapse(twin.strip_digits(twin.strip_punct(twin.strip_tags(twin.expand("lower(Text)")))))))
_TEXT_CLEAN = f"txt AS (SELECT review_id, {_TEXT_TOKENS} AS tk FROM reviews), vocab AS ({_TRAIN_VOCAB})"
_KNOWN = "known AS (SELECT t.review_id, count(v.token) AS n_known FROM (SELECT review_id, unnest(tk) AS token FROM txt) t LEFT JOIN vocab v ON t.token = v.token GROUP BY t.review_id)"


@query("prd1_batch_scoring", f"""WITH {_TEXT_CLEAN}, {_KNOWN} SELECT t.review_id, len(t.tk) AS n_tokens, coalesce(k.n_known, 0) AS n_in_vocab, CAST(1 AS DOUBLE) AS total_probability
 FROM txt t LEFT JOIN known k ON t.review_id = k.review_id""")
def _(spark, sf):
    out = _scorer(spark, sf).score(base.reviews(spark, sf).select("review_id", "Text"))
    total = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
    return out.select("review_id", "n_tokens", "n_in_vocab", total.alias("total_probability"))


@query("prd1_batch_scoring_by_role", "SELECT role, count(*) AS n FROM conversations GROUP BY role")
def _(spark, sf):
    df = derived.table(spark, sf, "conversations").select("role", "text", (F.col("conv_id") * 10_000 + F.col("turn")).alias("review_id"))
    out = _scorer(spark, sf).score(df, src.text_columns(df)[0], training.FOREST)
    return out.groupBy("role").agg(F.count("Predicted_Emotion").alias("n"))


@query("prd3_zero_vector_guard", f"""WITH {_TEXT_CLEAN}, {_KNOWN} SELECT t.review_id, coalesce(k.n_known, 0) = 0 AS no_known_words
 FROM txt t LEFT JOIN known k ON t.review_id = k.review_id""")
def _(spark, sf):
    out = _scorer(spark, sf).score(base.reviews(spark, sf).select("review_id", "Text"), model=training.FOREST)
    return out.select("review_id", "no_known_words")


@query("prd8_history_append", f"""WITH {_TEXT_CLEAN} SELECT r.review_id, CASE WHEN length(r.Text) > 50 THEN concat(substr(r.Text, 1, 50), '...') ELSE r.Text END AS text,
 m.model, len(t.tk) AS word_count FROM reviews r JOIN txt t ON r.review_id = t.review_id JOIN (SELECT unnest(['Random Forest', 'Boosting']) AS model) m ON TRUE""")
def _(spark, sf):
    path = scratch_path(spark, "history")
    scorer, df = _scorer(spark, sf), base.reviews(spark, sf).select("review_id", "Text")
    for model in (training.FOREST, training.BOOSTING):  # one append per model
        prediction.append_history(prediction.history_rows(scorer.score(df, model=model), model), path)
    return spark.read.parquet(path).select("review_id", "text", "model", "word_count")


_KNOWN_SQL = ", ".join(f"('{e}')" for _, e in lexicons.KNOWN_EXAMPLES)


@query("evl12_example_counts", f"""SELECT 'review' AS source, {twin.emotion('Score')} AS expected, count(*) AS n, TRUE AS n_passed_fits FROM reviews GROUP BY ALL
 UNION ALL SELECT 'known example', e, count(*), TRUE FROM (VALUES {_KNOWN_SQL}) AS t(e) GROUP BY ALL""")
def _(spark, sf):
    found = QUERIES["evl12_known_examples"](spark, sf)
    return found.select("source", "expected", "n", F.col("n_passed").between(0, F.col("n")).alias("n_passed_fits"))


@query("evl12_known_examples")
def _(spark, sf):
    known = spark.createDataFrame([(-1 - i, t, e) for i, (t, e) in enumerate(lexicons.KNOWN_EXAMPLES)],
                                  "review_id long, Text string, expected string")
    labelled = base.reviews(spark, sf).select("review_id", "Text", labels.emotion_mapped(F.col("Score")).alias("expected"))
    out = _scorer(spark, sf).score(labelled.unionByName(known))
    kind = F.when(F.col("review_id") < 0, "known example").otherwise("review")
    return out.groupBy(kind.alias("source"), "expected").agg(
        F.count("*").alias("n"), F.count_if(F.col("expected") == F.col("Predicted_Emotion")).alias("n_passed"))


# --- streaming -----------------------------------------------------------------------------------


@query("str1_stream_scoring", "SELECT review_id, 'Random Forest' AS model FROM reviews")
def _(spark, sf):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "scored")
    df = base.reviews(spark, sf).select("review_id", "Text")
    df.repartition(3, "review_id").write.parquet(source)
    stream = jobs.read_table_stream(spark, source, df.schema, files_per_trigger=2)
    jobs.score_stream(stream, _scorer(spark, sf), out, scratch_path(spark, "ckpt"), training.FOREST).awaitTermination()
    return spark.read.parquet(out).select("review_id", "model")


@query("str2_windowed_emotions", f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, prediction, count(*) AS n, {r('avg(confidence)')} AS mean_confidence FROM (
 SELECT *, time_bucket(INTERVAL 1 HOUR, to_timestamp(ts) AT TIME ZONE 'UTC') AS w FROM history)
 WHERE w + INTERVAL 1 HOUR <= (SELECT max(to_timestamp(ts) AT TIME ZONE 'UTC') FROM history) - INTERVAL 30 MINUTE GROUP BY w, prediction""")
def _(spark, sf):
    source, out = scratch_path(spark, "log"), scratch_path(spark, "windows")
    rows = derived.history(spark, sf)
    # files arrive in time order, so no row is late
    rows.repartitionByRange(3, "timestamp").sortWithinPartitions("timestamp").write.parquet(source)
    stats = jobs.windowed_emotions(jobs.read_table_stream(spark, source, rows.schema))
    jobs.write_windows(stats, out, scratch_path(spark, "ckpt")).awaitTermination()
    back = spark.read.schema(stats.schema).parquet(out)
    return back.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


