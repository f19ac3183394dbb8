"""Metrics against hand-computed or brute-force values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from moodlens.operators import diagnostics, ensemble, evaluation, keywords, prediction, profile


def scored(spark, rows):
    df = spark.createDataFrame([(i, y, [float(v) for v in p]) for i, (y, p) in enumerate(rows)], "review_id long, label int, probability array<double>")
    return evaluation.with_prediction(df)


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("grain", [5, 10_000])
def test_auc_with_and_without_ties(spark, grain):
    rng = random.Random(grain)
    rows = []
    for _ in range(600):
        p = [rng.randrange(1, grain) for _ in range(3)]
        rows.append((rng.randrange(3), [v / sum(p) for v in p]))
    df = scored(spark, rows)
    got = {r["class"]: r["auc"] for r in evaluation.auc_per_class(df).collect()}
    for c in range(3):
        assert math.isclose(got[c], brute_auc([(y == c, p[c]) for y, p in rows]), abs_tol=1e-12)
    assert math.isclose(evaluation.macro_auc(df).first()["auc"], sum(got.values()) / 3)


def test_absent_class_has_no_auc(spark):
    df = scored(spark, [(0, [0.6, 0.3, 0.1]), (1, [0.2, 0.7, 0.1])])
    assert math.isnan(evaluation.macro_auc(df).first()["auc"])


def test_roc_ends_at_one(spark):
    points = evaluation.roc_micro(scored(spark, [(0, [0.6, 0.4]), (1, [0.7, 0.3]), (1, [0.1, 0.9])])).orderBy(F.desc("threshold")).collect()
    assert (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0) and (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    assert [p["tpr"] for p in points] == sorted(p["tpr"] for p in points)


def test_macro_metrics_and_agreement(spark):
    # truth 0 0 0 1 1 2, predicted 0 0 1 1 0 0
    hot = lambda k: [1.0 if i == k else 0.0 for i in range(3)]
    df = scored(spark, [(0, hot(0)), (0, hot(0)), (0, hot(1)), (1, hot(1)), (1, hot(0)), (2, hot(0))])
    m = evaluation.macro_metrics(df).first()
    assert math.isclose(m["accuracy"], 3 / 6)
    assert math.isclose(m["precision"], (2 / 4 + 1 / 2 + 0) / 3)
    assert math.isclose(m["recall"], (2 / 3 + 1 / 2 + 0) / 3)
    assert math.isclose(m["f1"], (4 / 7 + 2 / 4 + 0) / 3)
    a = evaluation.agreement(df).first()
    pe = (3 * 4 + 2 * 2 + 1 * 0) / 36
    assert math.isclose(a["kappa"], (0.5 - pe) / (1 - pe))
    assert math.isclose(a["balanced_accuracy"], (2 / 3 + 1 / 2 + 0) / 3)
    cm = {(r["label"], r["prediction"]): r["n"] for r in evaluation.confusion_matrix(df, 3).collect()}
    assert len(cm) == 9 and cm[(0, 0)] == 2 and cm[(2, 2)] == 0
    ci = {r["class"]: r for r in evaluation.class_accuracy_interval(df).collect()}
    half = 1.959964 * math.sqrt(2 / 3 * 1 / 3 / 3)
    assert math.isclose(ci[0]["low"], 2 / 3 - half) and ci[0]["high"] == 1.0


def test_ensemble_ties_and_weights(spark):
    a, b = scored(spark, [(0, [0.5, 0.5]), (1, [0.9, 0.1])]), scored(spark, [(0, [0.5, 0.5]), (1, [0.1, 0.9])])
    assert [r["prediction"] for r in ensemble.combine(a, b, 0.5).orderBy("review_id").collect()] == [0, 0]
    only_first = ensemble.combine(a, b, 1.0, 0.0).orderBy("review_id").collect()
    assert [r["probability"] for r in only_first] == [[0.5, 0.5], [0.9, 0.1]]
    best = ensemble.best_weights(ensemble.weight_grid(a, b)).first()
    assert math.isclose(best["w1"], 0.1) and math.isclose(best["f1"], 1.0)


def test_degenerate_predictions(spark):
    one = scored(spark, [(0, [0.9, 0.1, 0.0]), (1, [0.8, 0.1, 0.1])])
    assert evaluation.distinct_predictions([one], 3).first()["verdict"] == "one"


def test_tfidf_on_three_documents(spark):
    docs = [(1, "good tea"), (2, "good good"), (3, "bad")]
    df = spark.createDataFrame([(i, t) for i, t in docs], "review_id long, clean_text string")
    idf = {w: math.log(4 / (1 + d)) + 1 for w, d in (("good", 2), ("tea", 1), ("bad", 1))}
    n1 = math.hypot(idf["good"], idf["tea"])
    want = {"good": (idf["good"] / n1 + 1) / 3, "tea": idf["tea"] / n1 / 3, "bad": 1 / 3}
    got = {r["token"]: r["mean_tfidf"] for r in diagnostics.mean_tfidf(df).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[w], want[w]) for w in want)


def test_log_odds_on_two_words(spark):
    counts = spark.createDataFrame([("Positive", "nice", 8), ("Positive", "box", 2), ("Negative", "box", 5), ("Negative", "nice", 1)], "Emotion string, token string, n long")
    got = {(r["Emotion"], r["token"]): r["score"] for r in keywords.log_odds(counts, 1).collect()}
    assert math.isclose(got["Positive", "nice"], math.log(9 / 3) - math.log(2 / 6))
    assert math.isclose(got["Negative", "nice"], math.log(2 / 6) - math.log(9 / 3))


def test_single_emotion_has_no_log_odds(spark):
    counts = spark.createDataFrame([("Positive", "nice", 8)], "Emotion string, token string, n long")
    assert keywords.log_odds(counts, 1).count() == 0


def test_emotion_counts_count_words_and_documents(spark):
    df = spark.createDataFrame(
        [("Positive", ["nice", "nice", "box"]), ("Negative", ["box", "nice"]), ("Unknown", ["rare", "rare"]), ("Neutral", ["rare"])],
        "Emotion string, tokens array<string>")
    got = {(r["Emotion"], r["token"]): r["n"] for r in keywords.emotion_counts(df, min_df=2).collect()}
    assert got == {("Positive", "nice"): 2, ("Positive", "box"): 1, ("Negative", "box"): 1, ("Negative", "nice"): 1, ("Neutral", "rare"): 1}


def test_polarity_gate_limits_are_inclusive(spark):
    scores = spark.createDataFrame([(e, t, 1, 1.0) for e in ("Positive", "Negative", "Neutral") for t in "abcde"], "Emotion string, token string, n long, score double")
    lex = spark.createDataFrame([("a", 0.5), ("b", -0.5), ("c", 0.2), ("d", -0.2), ("e", 3.0)], "token string, valence double")
    got = {(r["Emotion"], r["token"]) for r in keywords.polarity_gate(scores, lex).collect()}
    assert got == {("Positive", "a"), ("Positive", "e"), ("Negative", "b"), ("Neutral", "c"), ("Neutral", "d")}
    # without any negative word the negative gate stays open
    open_ = keywords.polarity_gate(scores, lex.filter("valence > 0")).filter("Emotion = 'Negative'")
    assert open_.count() == 5


def test_cloud_shift_and_hidden_words(spark):
    scores = spark.createDataFrame([("Positive", "coffee", 1, 2.0), ("Positive", "nice", 1, -1.0)], "Emotion string, token string, n long, score double")
    cloud = keywords.cloud(scores)
    assert {r["Word"]: round(r["Weight"], 3) for r in cloud.collect()} == {"coffee": 3.001, "nice": 0.001}
    assert [r["Word"] for r in keywords.render_weights(cloud).collect()] == ["nice"]


def test_prediction_tables(spark):
    df = scored(spark, [(0, [0.85, 0.1, 0.05]), (1, [0.3, 0.4, 0.3])])
    names = ["Negative", "Neutral", "Positive"]
    out = prediction.label_predictions(df, names, True, True)
    assert {c for c in out.columns if c.startswith("Prob_")} == {"Prob_Negative", "Prob_Neutral", "Prob_Positive"}
    ranks = prediction.ranked_probabilities(df, names).filter("review_id = 1").orderBy("rank").collect()
    assert [r["label"] for r in ranks] == ["Neutral", "Negative", "Positive"]
    q = prediction.batch_quality(out).first()
    assert (q["n_high"], q["n_low"], q["pct_low"]) == (1, 1, 50.0)


def test_history_append_and_reset(spark, tmp_path):
    path = str(tmp_path / "history")
    row = spark.range(1)
    prediction.append_history(row, path)
    prediction.append_history(row, path)
    assert spark.read.parquet(path).count() == 2
    prediction.reset_history(row, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id"]


def test_profiles_of_empty_table(spark):
    empty = spark.createDataFrame([], "review_id long, Score long")
    assert profile.duplicate_row_count(empty).first()[0] == 0
    assert [r["non_null"] for r in profile.column_profile(empty).collect()] == [0, 0]
    assert profile.dataset_summary(empty).first()["completeness_pct"] is None


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 10)], "n_tokens int")
    got = [r["tokens"] for r in diagnostics.length_quantiles(df, (0.1, 0.5, 0.9)).orderBy("quantile").collect()]
    assert [round(v, 9) for v in got] == [1.3, 2.5, 7.9]


def test_the_cross_validation_check_pairs_no_rows(spark, sf_dir):
    """The recomputed AUC must not join rows with the other labels' rows, whose number grows with the square."""
    from moodlens.plans.catalog import QUERIES

    found = QUERIES["mod6_cv_recomputed"](spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "NOT (label" in line]
    assert {r["metric"]: r["same"] for r in found.collect()} == dict.fromkeys(("auc", "f1", "precision", "recall"), True)
