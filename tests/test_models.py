"""Training operators: exact neighbours, vectors, classifiers, streams."""

from __future__ import annotations

import math
import os
import tracemalloc
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodlens.operators import embeddings, models, negative_sampling, packing, prediction, smote, splits
from moodlens.plans import base, training
from moodlens.plans.catalog import QUERIES
from moodlens.session import shared_dir
from moodlens.streaming import jobs


@pytest.fixture(scope="module")
def points(spark):
    """Two classes in 6 dimensions; a third of the rows are copies of one point."""
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 4 == 0), [float(v) for v in rng.normal(size=6) + 3 * (i % 4 == 0)]) for i in range(300)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(150)]
    return spark.createDataFrame(rows, "id long, label int, features array<double>").repartition(4).cache()


def brute_neighbours(rows, k):
    out = {}
    for label in {r["label"] for r in rows}:
        mine = [r for r in rows if r["label"] == label]
        x = np.array([r["features"] for r in mine])
        for i, r in enumerate(mine):
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            d[i] = np.inf
            out[r["id"]] = np.sort(d)[:k]
    return out


@pytest.mark.parametrize("block_rows,n_pivots", [(2048, 64), (16, 5)])
def test_neighbours_are_exact(points, block_rows, n_pivots):
    want = brute_neighbours(points.collect(), 5)
    got = {}
    for r in smote.nearest_same_class(points, 5, block_rows, n_pivots).collect():
        assert r["id"] != r["neighbour"]
        got.setdefault(r["id"], []).append(r["distance"])
    assert got.keys() == want.keys()
    for i, d in want.items():
        assert np.allclose(sorted(got[i]), d, atol=1e-6)


def test_smote_balances_on_segments(points):
    real = {r["id"]: r for r in points.collect()}
    out = smote.smote(points, seed=1, block_rows=64).collect()
    sizes = {c: sum(r["label"] == c for r in out) for c in (0, 1)}
    assert sizes[0] == sizes[1]
    for r in (r for r in out if r["synthetic"]):
        a, b = real[r["base"]], real[r["neighbour"]]
        assert a["label"] == b["label"] == r["label"]
        x, y, s = (np.array(v["features"]) for v in (a, b, r))
        assert math.isclose(np.linalg.norm(s - x) + np.linalg.norm(y - s), np.linalg.norm(y - x), abs_tol=1e-9)


def test_smote_needs_enough_rows(spark):
    df = spark.createDataFrame([(i, int(i < 3), [float(i)]) for i in range(20)], "id long, label int, features array<double>")
    with pytest.raises(ValueError, match="too few"):
        smote.smote(df)


def test_document_vectors_skip_unknown_words(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b", "zzz"]), (2, ["zzz"]), (3, ["b"])], "review_id long, tokens array<string>")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "token string, vector array<double>")
    got = {r["review_id"]: r for r in embeddings.document_vectors(df, vec, 2).collect()}
    assert np.allclose(got[1]["features"], [2 / 3, 2 / 3]) and got[1]["n_in_vocab"] == 3
    assert got[2]["features"] == [0.0, 0.0] and got[2]["zero_vector"]
    weights = spark.createDataFrame([("a", 0.5)], "token string, weight double")
    got = {r["review_id"]: r["features"] for r in embeddings.document_vectors(df, vec, 2, weights).collect()}
    assert np.allclose(got[1], [1 / 3, 2 / 3])  # divided by the count, not by the weights


def test_principal_direction_is_uncentred(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4)) + np.array([5.0, 0, 0, 0])
    df = spark.createDataFrame([(i, "train" if i < 150 else "test", [float(v) for v in row]) for i, row in enumerate(x)],
                               "review_id long, split string, features array<double>")
    u = np.array(embeddings.principal_direction(df.filter("split = 'train'")))
    v = np.linalg.svd(x[:150])[2][0]
    assert math.isclose(abs(u @ v), 1.0, abs_tol=1e-9)
    left = np.array([r["features"] for r in embeddings.remove_principal_component(df).filter("split = 'train'").collect()])
    assert np.abs(left @ u).max() < 1e-6


def test_subsampling_follows_the_rule(spark):
    toks = spark.range(20000).select((F.col("id") / 10).cast("long").alias("review_id"), (F.col("id") % 10).cast("int").alias("pos"),
                                     F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("token"))
    kept = {r["hot"]: r["count"] for r in embeddings.subsample_frequent(toks, 1e-2).groupBy((F.col("token") == "hot").alias("hot")).count().collect()}
    f = 0.5
    assert kept[False] == 10000 and abs(kept[True] / 10000 - (math.sqrt(1e-2 / f) + 1e-2 / f)) < 0.02


@pytest.mark.parametrize("architecture", negative_sampling.ARCHITECTURES)
def test_sampled_vectors_learn_cooccurrence(spark, architecture):
    """Words of one topic end up closer to each other than to the other topic."""
    rng = np.random.default_rng(0)
    topics = [["tea", "cup", "leaf", "brew"], ["dog", "bone", "bark", "tail"]]
    rows = [(i, [str(w) for w in rng.choice(topics[i % 2], 12)]) for i in range(400)]
    df = spark.createDataFrame(rows, "review_id long, tokens array<string>")
    o = negative_sampling.SamplingOptions(architecture, size=12, window=3, min_count=2, rounds=3, negative=4, step=0.1, chunk_tokens=1500, batch=64)
    vec, docs = negative_sampling.fit_vectors(df, o)
    v = {r["token"]: np.array(r["vector"]) for r in vec.collect()}
    assert set(v) == {w for t in topics for w in t}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    same = np.mean([cos(v[a], v[b]) for t in topics for a in t for b in t if a < b])
    across = np.mean([cos(v[a], v[b]) for a in topics[0] for b in topics[1]])
    assert same > across + 0.3
    if architecture == "document":
        assert docs.count() == 400
    again, _ = negative_sampling.fit_vectors(df, o)
    w = {r["token"]: np.array(r["vector"]) for r in again.collect()}
    assert all(np.allclose(v[t], w[t], atol=1e-9) for t in v)


def test_word2vec_vocabulary(spark):
    df = spark.createDataFrame([(i, ["good", "tea", "cup"] + (["once"] if i == 0 else [])) for i in range(30)], "review_id long, tokens array<string>")
    vec = embeddings.word_vectors(embeddings.fit_word2vec(df, size=8, min_count=2, epochs=1))
    assert {r["token"] for r in vec.collect()} == {"good", "tea", "cup"}
    near = embeddings.nearest_words(vec, ["good"], 2).collect()
    assert {r["token"] for r in near} == {"tea", "cup"}


@pytest.fixture(scope="module")
def separable(spark):
    rows = [(i, i % 3, [float(i % 3 == c) + 0.01 * ((i * 7 + c) % 11) for c in range(3)]) for i in range(90)]
    return spark.createDataFrame(rows, "review_id long, label int, features array<double>").cache()


def test_classifiers_on_separable_data(separable):
    forest = models.fit_forest(separable, models.ForestOptions(trees=10, max_depth=4))
    boost = models.fit_boosting(separable, 3, models.BoostOptions(rounds=3, max_depth=2))
    both = models.Ensemble(forest, boost, 1.0, 0.0)
    for m in (forest, boost, both):
        out = m.predict(separable).collect()
        assert all(r["prediction"] == r["label"] for r in out)
        assert all(math.isclose(sum(r["probability"]), 1.0, abs_tol=1e-9) for r in out)
    a = {r["review_id"]: r["probability"] for r in forest.predict(separable).collect()}
    b = {r["review_id"]: r["probability"] for r in both.predict(separable).collect()}
    assert a == b
    assert len(forest.importances()) == 3 and len(boost.importances()) == 3


def test_cross_validation_covers_train_once(separable):
    out = models.cross_validate(separable, lambda r, w: models.fit_forest(r, models.ForestOptions(5, 3), w), k=3, method="Class weights")
    assert out.count() == 90 and out.select("review_id").distinct().count() == 90
    m = models.cv_metrics(out).first()
    assert m["folds"] == 3 and m["f1"] > 0.9 and m["auc"] > 0.95


def test_validation_rows_are_real(separable):
    skewed = separable.filter("label < 2").filter("label = 0 or review_id < 40")
    rows, _ = models.with_validation(skewed, "SMOTE", 0.15, 1)
    held = rows.filter("_held")
    assert held.filter("review_id is null").count() == 0
    fit_sizes = {r["label"]: r["count"] for r in rows.filter("not _held").groupBy("label").count().collect()}
    assert fit_sizes[0] == fit_sizes[1]
    with pytest.raises(ValueError, match="unknown balancing"):
        models.balanced(skewed, "magic")


@pytest.fixture(scope="module")
def small_run(spark):
    words = {"Negative": ["awful", "bad", "stale"], "Neutral": ["box", "label", "size"], "Positive": ["love", "great", "fresh"]}
    rows = [(i, e, [words[e][(i + j) % 3] for j in range(6)]) for i in range(150) for e in [list(words)[i % 3]]]
    df = spark.createDataFrame(rows, "review_id long, Emotion string, tokens array<string>").repartition(4).cache()
    o = training.TrainOptions(
        vector_size=8, window=3, min_count=1, epochs=3, sample=0.0, folds=2, use_sif=True, remove_pc=True, balancing="Class weights",
        forest=models.ForestOptions(10, 4), boost=models.BoostOptions(3, max_depth=2))
    return training.train_and_evaluate(df, o)


def test_training_run(small_run):
    assert small_run.labels == ["Negative", "Neutral", "Positive"]
    assert small_run.embedding == "Word2Vec(SIF-PCrm-L2)"
    got = {r["model"]: r for r in small_run.metrics.collect()}
    assert set(got) == {training.FOREST, training.BOOSTING, training.ENSEMBLE}
    assert got[training.ENSEMBLE]["f1"] > 0.9
    assert small_run.confusion(training.FOREST).agg(F.sum("n")).first()[0] == 30
    assert small_run.roc(training.FOREST).count() > 2
    assert {c.first()["folds"] for c in small_run.cv.values()} == {2}
    assert small_run.scorer.w1 + small_run.scorer.w2 == pytest.approx(1.0)


def test_saved_scorer_scores_alike_in_batch_and_stream(spark, small_run, tmp_path):
    scorer = training.Scorer.load(spark, small_run.scorer.save(str(tmp_path / "scorer")))
    df = spark.createDataFrame([(1, "I love it: great, FRESH!"), (2, "awful, BAD and stale"), (3, "zzz qqq"), (4, None)], "review_id long, Text string")
    got = {r["review_id"]: r for r in scorer.score(df, all_probabilities=True).collect()}
    before = {r["review_id"]: r for r in small_run.scorer.score(df).collect()}
    assert got[1]["Predicted_Emotion"] == "Positive" and got[2]["Predicted_Emotion"] == "Negative"
    assert got[3]["no_known_words"] and got[4]["no_known_words"] and not got[1]["no_known_words"]
    assert all(got[i]["probability"] == before[i]["probability"] for i in got)
    assert scorer.score(df, max_rows=2).count() == 2
    assert scorer.score(df, serve_plain_mean=True).count() == 4
    with pytest.raises(ValueError, match="model must be"):
        scorer.predictor("other")
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    df.repartition(2).write.parquet(source)
    run = lambda: jobs.score_stream(jobs.read_table_stream(spark, source, df.schema, 1), scorer, out, ckpt).awaitTermination()
    run()
    streamed = {r["review_id"]: r for r in spark.read.parquet(out).collect()}
    assert {i: r["prediction"] for i, r in streamed.items()} == {i: r["Predicted_Emotion"] for i, r in got.items()}
    run()  # nothing new: nothing is scored twice
    assert spark.read.parquet(out).count() == 4


def test_stream_windows_equal_closed_batch_windows(spark, tmp_path):
    rows = spark.range(240).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("timestamp"), (F.col("id") % 3).cast("string").alias("prediction"),
        (F.col("id") / 240.0).alias("confidence"))
    source, out = str(tmp_path / "log"), str(tmp_path / "windows")
    for part in range(3):  # separate files in time order
        rows.filter(F.floor((F.unix_timestamp("timestamp") - 1704067200) / 4800) == part).coalesce(1).write.mode("append").parquet(source)
    stats = jobs.windowed_emotions(jobs.read_table_stream(spark, source, rows.schema, 1))
    jobs.write_windows(stats, out, str(tmp_path / "ckpt")).awaitTermination()
    got = {tuple(r)[:3]: round(r["mean_confidence"], 9) for r in spark.read.schema(stats.schema).parquet(out).collect()}
    batch = {tuple(r)[:3]: round(r["mean_confidence"], 9) for r in jobs.windowed_emotions(rows, lateness=None).collect()}
    closed = {k: v for k, v in batch.items() if k[0].timestamp() + 3600 <= 1704067200 + 239 * 60 - 1800}
    assert got == closed and len(got) == 9


def test_history_rows(spark):
    df = spark.createDataFrame([(1, "x" * 60, "Positive", 0.9, 4, 3), (2, "short", "Neutral", 0.5, 0, 0)],
                               "review_id long, Text string, Predicted_Emotion string, Confidence double, n_tokens int, n_in_vocab long")
    got = {r["review_id"]: r for r in prediction.history_rows(df, "Ensemble").collect()}
    assert got[1]["text"] == "x" * 50 + "..." and got[1]["vocab_coverage"] == 0.75
    assert got[2]["text"] == "short" and got[2]["vocab_coverage"] == 0.0


def test_default_balancing(spark):
    df = spark.createDataFrame([(0,)] * 7 + [(1,)] * 3, "label int")
    assert splits.default_balancing(df, "label").first()["method"] == "SMOTE"


def test_word_vectors_have_no_size_switch(spark, monkeypatch):
    df = spark.createDataFrame([(i, ["good", "tea", "cup"] + (["once"] if i == 0 else [])) for i in range(30)], "review_id long, tokens array<string>")
    plain = dict(vector_size=4, min_count=2, epochs=1, window=2)
    rows = lambda o: {r["token"]: r["vector"] for r in training.fit_word_vectors(df, o).collect()}
    small = rows(training.TrainOptions(**plain))
    assert set(small) == {"good", "tea", "cup"} == set(rows(training.TrainOptions(**plain, negative=0)))
    monkeypatch.setattr(training, "DRIVER_FLOATS", 1)
    assert rows(training.TrainOptions(**plain)) == small
    with pytest.raises(ValueError, match="too many"):
        training.fit_word_vectors(df, training.TrainOptions(**plain, negative=0))
    with pytest.raises(ValueError, match="no word occurs"):
        training.fit_word_vectors(df, training.TrainOptions(min_count=99))


def test_best_round_has_patience():
    losses = [5, 4, 4.5, 4.4, 3, 3.5, 3.6, 3.7, 1]
    assert models.best_round(losses, 3) == 5
    assert models.best_round(losses, 4) == 9
    assert models.best_round([3, 2, 1], 30) == 3
    assert models.best_round([1, 2, 3], 1) == 1


def test_boosting_stops_early(spark):
    """Labels without a pattern: more rounds only fit noise, so the validation loss rises soon."""
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.integers(0, 2)), [float(x) for x in rng.normal(size=3)], i % 4 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "review_id long, label int, features array<double>, held boolean")
    full = models.BoostOptions(rounds=12, max_depth=4, step=0.5, patience=2)
    fitted = models.fit_boosting(df, 2, full, None, "held")
    assert fitted.rounds < 12 and len(fitted.losses) == min(fitted.rounds + 2, 12)


def test_scorer_with_lemmas_and_stems(spark, tmp_path):
    """Train on reduced words; the saved scorer reduces new texts in the same way."""
    from moodlens.functions.text import CleanOptions
    from moodlens.operators import cleaning, vocabulary

    words = {1: ["awful hating", "stale boxes"], 3: ["plain box", "sized labels"], 5: ["loving teas", "great treats"]}
    rows = [(i, s, " ".join(words[s])) for i in range(90) for s in [(1, 3, 5)[i % 3]]]
    raw = spark.createDataFrame(rows, "review_id long, Score long, Summary string").withColumn("Text", F.col("Summary"))
    lemmas = spark.createDataFrame([("teas", "tea"), ("hating", "hate"), ("great", "never used")], "token string, lemma string")
    options = CleanOptions(stem=True)
    plain = cleaning.clean_reviews(raw)
    reduced = vocabulary.reduce_words(plain, lemmas, True).cache()
    got = {r["review_id"]: r for r in reduced.collect()}
    assert got[2]["tokens"] == ["love", "tea", "great", "treat"] and got[2]["clean_text"] == "love tea great treat" and got[2]["n_tokens"] == 4
    stemmed = {r["review_id"]: r["tokens"] for r in cleaning.clean_reviews(raw, options).collect()}
    assert stemmed[0] == ["aw", "hate", "stale", "box"] or stemmed[0] == ["awful", "hate", "stale", "box"]
    o = training.TrainOptions(vector_size=8, window=2, min_count=1, epochs=2, sample=0.0, folds=0, early_stop=False, optimise_weights=False,
                              balancing="None", forest=models.ForestOptions(10, 4), boost=models.BoostOptions(3, max_depth=2))
    run = training.train_and_evaluate(reduced, o, options, lemmas)
    scorer = training.Scorer.load(spark, run.scorer.save(str(tmp_path / "scorer")))
    new = spark.createDataFrame([(1, "loved the tea"), (2, "hate, stale box")], "review_id long, Text string")
    scored = {r["review_id"]: r for r in scorer.score(new).collect()}
    assert scored[1]["n_in_vocab"] == 2 and scored[2]["n_in_vocab"] == 3
    assert scorer.clean.stem and scorer.lemmas.count() == 3


def test_vectors_beyond_the_broadcast_meet_the_reviews_in_chunks(spark, monkeypatch):
    """Repeated and null ids, null tokens, repeated words and words without a vector: as the broadcast path gives them."""
    rng = np.random.default_rng(2)
    rows = [(i // 2, [f"w{k}" for k in rng.integers(0, 60, int(rng.integers(1, 40)))]) for i in range(80)]
    rows += [(None, ["w1"]), (500, None), (501, []), (502, [None, "w1"]), (503, ["zzz"]), (504, ["w3"] * 700)]
    df = spark.createDataFrame(rows, "review_id long, tokens array<string>")
    table = [(f"w{k}", [float(v) for v in rng.normal(size=3)]) for k in range(50)] + [("w1", [1.0, 2.0, 3.0]), ("w2", None)]
    vec = spark.createDataFrame(table, "token string, vector array<double>")
    weights = spark.createDataFrame([(f"w{k}", k / 10) for k in range(20)], "token string, weight double")
    found = lambda w: sorted(map(tuple, embeddings.document_vectors(df, vec, 3, w).collect()), key=repr)
    flat = lambda rows: np.array([[-1 if r[0] is None else r[0], r[1], r[2], *r[3], r[4]] for r in rows], float)
    before = [found(None), found(weights)]
    monkeypatch.setattr(embeddings.joins, "fits_broadcast", lambda small, *_: (small, False))
    monkeypatch.setattr(embeddings.joins, "salted_join", lambda *_: pytest.fail("a row for every token was shuffled"))
    monkeypatch.setattr(embeddings, "CHUNK_TOKENS", 200)
    monkeypatch.setattr(embeddings, "CHUNK_NUMBERS", 0)
    monkeypatch.setattr(embeddings, "BLOCK_TOKENS", 64)
    after = [found(None), found(weights)]
    for a, b in zip(before, after):
        assert np.allclose(flat(a), flat(b))
    pairs = {(r, t) for r, ts in rows if r is not None for t in ts or [] if t in {x for x, _ in table}}
    full = embeddings.token_sums(df, vec.dropDuplicates(["token"]).withColumn("weight", F.lit(1.0)), 3)
    assert {r["review_id"]: r["n_types"] for r in full.collect() if r["n_types"]} == {i: sum(p[0] == i for p in pairs) for i in {p[0] for p in pairs}}


def test_large_corpora_get_larger_chunks_and_leave_little_on_disk(spark):
    o = negative_sampling.SamplingOptions(architecture="document", size=4, window=2, negative=2, rounds=2, min_count=1, chunk_tokens=10)
    assert [negative_sampling.chunk_count(n, o) for n in (5, 100, 6_400, 10**9)] == [1, 10, 64, 500]
    df = spark.createDataFrame([(i, [f"w{(i * k) % 30}" for k in range(12)]) for i in range(120)], "review_id long, tokens array<string>")
    tables = lambda: {d for d in os.listdir(shared_dir(spark).removeprefix("file:")) if d.startswith("vectors-")}
    before = tables()
    vectors, docs = negative_sampling.fit_vectors(df, o)
    assert vectors.count() == 30 and docs.count() == 120
    assert len(tables() - before) == 1  # the table that the document vectors are read from


def test_tokens_travel_packed(spark):
    rows = [(i, [f"word{(i * k) % 50}" for k in range(300)]) for i in range(400)] + [(900, None), (901, []), (902, [None, "word1", "é"]), (902, ["again"])]
    df = spark.createDataFrame(rows, "review_id long, tokens array<string>").repartition(2)
    blocks = embeddings.chunked(df, 40_000)
    assert blocks.columns == ["chunk", "block"]
    found = blocks.toArrow()
    assert len(set(found["chunk"].to_pylist())) == 4 and len(found) <= 8
    assert sum(map(len, found["block"].to_pylist())) < sum(len(t or "") for _, ts in rows for t in ts or []) / 5
    back = packing.unpacked(found).to_pylist()
    assert sorted(map(repr, ((r["review_id"], r["tokens"]) for r in back))) == sorted(map(repr, ((i, t or []) for i, t in rows)))


@pytest.mark.parametrize("sample", [0.0, 1e-3])
def test_tables_of_tokens_are_no_checkpoints(spark, monkeypatch, sample):
    """A checkpoint holds every token uncompressed; vectors are the same from packed reviews."""
    cut = training.cut_lineage
    monkeypatch.setattr(training, "cut_lineage", lambda df: pytest.fail("tokens in a checkpoint") if "tokens" in df.columns else cut(df))
    rows = [(i, ("Negative", "Positive")[i % 2], [f"w{(i * k) % 30}" for k in range(12)]) for i in range(60)]
    df = spark.createDataFrame(rows, "review_id long, Emotion string, tokens array<string>")
    o = training.TrainOptions(vector_size=4, window=2, min_count=1, epochs=1, sample=sample)
    dv, _ = training.featurise_corpus(df, o)
    assert dv.count() == 60 and dv.filter("n_tokens = 12").count() == 60


def test_chunks_are_looked_up_without_strings(spark):
    """Four bytes a token: the strings of a chunk with their offsets would take three times as much, and copies of them more."""
    rng = np.random.default_rng(4)
    lists = [[f"longer-word-{k}" for k in rng.integers(0, 3000, 500)] for _ in range(200)]
    rows = [(i % 150, t) for i, t in enumerate(lists)] + [(900, None), (901, [None, "longer-word-1", "é"])]
    df = spark.createDataFrame(rows, "review_id long, tokens array<string>").repartition(3)
    blocks = embeddings.chunked(df, 10**9).toArrow()["block"]
    vocab = pa.array(["é"] + [f"longer-word-{k}" for k in range(2000)])
    assert set(packing.words(blocks).to_pylist()) == {w for _, t in rows for w in t or [] if w}
    pool = pa.default_memory_pool()
    before = pool.bytes_allocated()
    tracemalloc.start()
    ids, sizes, at = packing.coded(blocks, vocab)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pool.bytes_allocated() - before < 100_000 and at.dtype == np.int32 and most < 30 * len(at)
    assert ids.to_pylist() == sorted(i for i, _ in rows)
    place = {w: k for k, w in enumerate(vocab.to_pylist())}
    found, low = {}, 0
    for i, n in zip(ids.to_pylist(), sizes):
        found.setdefault(i, []).append(at[low : low + n].tolist())
        low += n
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([place.get(w, len(vocab)) for w in t or [] if w])
    assert {i: sorted(v) for i, v in found.items()} == {i: sorted(v) for i, v in want.items()}
    words, n = packing.counts(blocks)
    assert dict(zip(words.to_pylist(), n.tolist())) == dict(Counter(w for _, t in rows for w in t or [] if w))


@pytest.mark.parametrize("name", ["emb2_cbow", "emb6_sif_document_vectors", "jn1_token_vectors", "mod3_early_stopping"])
def test_python_steps_do_not_share_executors_with_kept_tokens(spark, sf_dir, monkeypatch, name):
    """Rows kept in memory fill the heap of an executor, whose Python needs what is left."""
    monkeypatch.setattr(base, "kept", lambda df: pytest.fail("tokens are kept") if "tokens" in df.columns else df)
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_words_are_counted_once_before_training(spark, monkeypatch):
    """Training counts the words of its chunks; a count of all tokens before it read the corpus once more."""
    df = spark.createDataFrame([(i, [f"w{(i * k) % 30}" for k in range(12)]) for i in range(60)], "review_id long, tokens array<string>")
    monkeypatch.setattr(F, "explode_outer", lambda *_: pytest.fail("a row for every token"))
    o = training.TrainOptions(vector_size=4, window=2, min_count=1, epochs=1)
    assert training.fit_word_vectors(df, o).count() == 30
    for tokens in ([], [None], ["once"]):
        with pytest.raises(ValueError, match="no word occurs 5 times"):
            training.fit_word_vectors(spark.createDataFrame([(1, tokens)], "review_id long, tokens array<string>"), replace(o, min_count=5))


def test_an_update_meets_each_pair_as_one_by_one():
    """One batch against plain loops: repeated rows, targets that are negatives, masked places."""
    rng = np.random.default_rng(3)
    o = negative_sampling.SamplingOptions(negative=3, shared=5)
    inp, out = (rng.normal(size=(9, 4)).astype(np.float32) for _ in range(2))
    rows, target = rng.integers(0, 9, (12, 2)), rng.integers(0, 9, (12, 3))
    row_mask, target_mask = (np.concatenate([np.ones((12, 1)), rng.integers(0, 2, (12, k - 1))], 1).astype(np.float32) for k in (2, 3))
    noise = rng.integers(0, 9, 5)
    din, dout, nin, nout = np.zeros((9, 4)), np.zeros((9, 4)), np.zeros(9), np.zeros(9)
    for i in range(12):
        own, used = [k for k in range(2) if row_mask[i, k]], [k for k in range(3) if target_mask[i, k]]
        hidden = sum(inp[rows[i, k]] for k in own) / len(own)
        pulls = [(target[i, k], 0.1 / (1 + np.exp(hidden @ out[target[i, k]])), 1) for k in used]
        for w in noise:
            push = 0 if w in target[i] else -len(used) * 0.1 * 3 / 5 / (1 + np.exp(-hidden @ out[w]))
            pulls.append((w, push, len(used) * 3 / 5))
        for w, g, n in pulls:
            dout[w] += g * hidden
            nout[w] += n
            for k in own:
                din[rows[i, k]] += g * out[w] / len(own)
        for k in own:
            nin[rows[i, k]] += len(used) / len(own)
    want = [x + d / np.maximum(n / negative_sampling.STEADY, 1)[:, None] for x, d, n in ((inp, din, nin), (out, dout, nout))]
    drawn = np.zeros(9, bool)
    negative_sampling._update(inp, out, rows, row_mask, target, target_mask, noise, o, 0.1, drawn)
    assert np.allclose(inp, want[0], atol=1e-5) and np.allclose(out, want[1], atol=1e-5) and not drawn.any()
