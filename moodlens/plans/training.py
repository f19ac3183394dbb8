"""The whole training run, from cleaned reviews to a results bundle, and the fitted scorer."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.functions import text
from moodlens.operators import embeddings, evaluation, models, negative_sampling, prediction, splits, vocabulary
from moodlens.session import cut_lineage, scratch_path
from moodlens.sources import sinks

FOREST, BOOSTING, ENSEMBLE = "Random Forest", "Boosting", "Ensemble"
DRIVER_FLOATS = 100_000_000  # largest word vector table MLlib may hold on the driver; more is an error


@dataclass(frozen=True)
class TrainOptions:
    vector_size: int = 200
    window: int = 5
    min_count: int = 5
    epochs: int = 10
    architecture: str = "skipgram"
    negative: int = 10  # 0 trains skip-gram by MLlib's hierarchical softmax, whose table must fit the driver
    chunk_tokens: int = 4_000_000  # larger chunks exchange fewer vectors, smaller ones give a small corpus more tasks
    word2vec_partitions: int = 8  # of MLlib's trainer only
    sample: float = 1e-3
    test_size: float = 0.2
    seed: int = 42
    use_sif: bool = False
    remove_pc: bool = False
    l2: bool = True
    folds: int = 5
    balancing: str | None = None  # None picks by the largest class share
    early_stop: bool = True
    early_stop_rows: int = 100  # train rows up to which boosting runs all its rounds
    optimise_weights: bool = True
    drop_unknown: bool = False
    forest: models.ForestOptions = models.ForestOptions()
    boost: models.BoostOptions = models.BoostOptions()


@dataclass
class Scorer:
    """Everything needed to score new texts the way training vectors were made."""

    vectors: DataFrame
    labels: list[str]
    dim: int
    forest: models.Forest
    boosting: models.Boosting
    w1: float = 0.5
    w2: float = 0.5
    weights: DataFrame | None = None
    direction: list[float] | None = None
    l2: bool = True
    clean: text.CleanOptions = field(default_factory=text.CleanOptions)
    lemmas: DataFrame | None = None

    def featurise(self, df: DataFrame, text_col: str, serve_plain_mean: bool = False) -> DataFrame:
        """``serve_plain_mean`` leaves out weighting, component removal and scaling.

        With lemmas the tokens of a review are put together again after the lookup, which streams cannot do.
        """
        cleaner = self.clean if self.lemmas is None else replace(self.clean, stem=False)
        rows = df.withColumn("tokens", text.clean_tokens(F.coalesce(F.col(text_col), F.lit("")), cleaner))
        if self.lemmas is not None:
            rows = vocabulary.reduce_words(rows, self.lemmas, self.clean.stem)
        plain = serve_plain_mean
        vecs = embeddings.document_vectors(rows, self.vectors, self.dim, None if plain else self.weights)
        if self.direction is not None and not plain:
            vecs = embeddings.remove_direction(vecs, self.direction)
        if self.l2 and not plain:
            vecs = embeddings.l2_normalise(vecs)
        return rows.drop("tokens").join(vecs, "review_id")

    def predictor(self, model: str = ENSEMBLE):
        chosen = {FOREST: self.forest, BOOSTING: self.boosting,
                  ENSEMBLE: models.Ensemble(self.forest, self.boosting, self.w1, self.w2)}
        if model not in chosen:
            raise ValueError(f"model must be one of {sorted(chosen)}")
        return chosen[model]

    def score(
        self, df: DataFrame, text_col: str = "Text", model: str = ENSEMBLE, max_rows: int | None = None,
        all_probabilities: bool = False, serve_plain_mean: bool = False,
    ) -> DataFrame:
        """Adds ``Predicted_Emotion, Confidence, no_known_words`` and the vector columns.

        Rows need a unique ``review_id``. ``max_rows`` takes the first rows by it.
        """
        rows = df.orderBy("review_id").limit(max_rows) if max_rows else df
        out = self.predictor(model).predict(self.featurise(rows, text_col, serve_plain_mean))
        out = prediction.label_predictions(out.drop("confidence"), self.labels, True, all_probabilities)
        return prediction.zero_vector_guard(out)

    def save(self, path: str) -> str:
        """Tables and models below one folder; a table holds the scalar settings."""
        spark = self.vectors.sparkSession
        sinks.write_table(self.vectors, f"{path}/vectors")
        if self.weights is not None:
            sinks.write_table(self.weights, f"{path}/weights")
        if self.lemmas is not None:
            sinks.write_table(self.lemmas.select("token", "lemma"), f"{path}/lemmas")
        self.forest.save(f"{path}/forest")
        self.boosting.save(f"{path}/boosting")
        row = (self.labels, self.dim, self.w1, self.w2, self.direction, self.l2, self.weights is not None,
               self.clean.lower, self.clean.strip_tags, self.clean.strip_punctuation, self.clean.strip_digits,
               self.clean.collapse_space, list(self.clean.stopwords) if self.clean.stopwords is not None else None,
               self.clean.stem, self.lemmas is not None)
        schema = ("labels array<string>, dim int, w1 double, w2 double, direction array<double>, l2 boolean, weighted boolean, "
                  "lower boolean, tags boolean, punctuation boolean, digits boolean, space boolean, stopwords array<string>, stem boolean, lemmatised boolean")
        sinks.write_table(spark.createDataFrame([row], schema).coalesce(1), f"{path}/settings")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorer:
        s = spark.read.parquet(f"{path}/settings").first()
        clean = text.CleanOptions(s["lower"], s["tags"], s["punctuation"], s["digits"], s["space"],
                                  tuple(s["stopwords"]) if s["stopwords"] is not None else None, s["stem"])
        return Scorer(
            spark.read.parquet(f"{path}/vectors"), list(s["labels"]), s["dim"], models.Forest.load(f"{path}/forest"),
            models.Boosting.load(f"{path}/boosting"), s["w1"], s["w2"],
            spark.read.parquet(f"{path}/weights") if s["weighted"] else None,
            list(s["direction"]) if s["direction"] is not None else None, s["l2"], clean,
            spark.read.parquet(f"{path}/lemmas") if s["lemmatised"] else None,
        )


@dataclass
class Results:
    """One table per kind of result; ``predictions`` stacks the models' test predictions."""

    metrics: DataFrame
    cv: dict[str, DataFrame]
    predictions: DataFrame
    importances: dict[str, list[float]]
    labels: list[str]
    embedding: str
    scorer: Scorer

    def of(self, model: str) -> DataFrame:
        return self.predictions.filter(F.col("model") == model)

    def confusion(self, model: str) -> DataFrame:
        return evaluation.confusion_matrix(self.of(model), len(self.labels))

    def roc(self, model: str) -> DataFrame:
        return evaluation.roc_micro(self.of(model))


def fit_word_vectors(corpus: DataFrame, o: TrainOptions) -> DataFrame:
    """Word vectors of the train rows as a written table.

    Negative sampling, at every size; ``negative=0`` asks for MLlib's trainer, which fails beyond a checked size.
    """
    none = f"no word occurs {o.min_count} times in the train rows"
    if o.negative == 0:
        tokens = corpus.select(F.explode_outer("tokens").alias("token")).filter(F.col("token").isNotNull())
        words = tokens.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= o.min_count).count()
        if words == 0:
            raise ValueError(none)
        if o.architecture != "skipgram":
            raise ValueError("hierarchical softmax trains skip-gram only")
        if words * o.vector_size > DRIVER_FLOATS:
            raise ValueError(f"{words} words of {o.vector_size} numbers are too many for MLlib's driver table; use negative sampling")
        model = embeddings.fit_word2vec(corpus, o.vector_size, o.window, o.min_count, o.epochs, o.seed, o.word2vec_partitions)
        return cut_lineage(embeddings.word_vectors(model))
    if corpus.filter(F.size("tokens") > 0).isEmpty():
        raise ValueError(none)
    options = negative_sampling.SamplingOptions(
        o.architecture, o.vector_size, o.window, o.min_count, o.epochs, o.negative, seed=o.seed, chunk_tokens=o.chunk_tokens)
    vectors = negative_sampling.fit_vectors(corpus, options)[0]
    if vectors.isEmpty():  # found while training, which counts the words anyway
        raise ValueError(none)
    return vectors


def featurise_corpus(cleaned: DataFrame, o: TrainOptions) -> tuple[DataFrame, dict]:
    """Split, train word vectors on the train part, and make the vectors of all reviews.

    ``cleaned`` is read several times and should be a written stage. Adds ``label, split, features``.
    """
    df = cleaned.filter(F.col("Emotion") != "Unknown") if o.drop_unknown else cleaned
    df = splits.stratified_split(df.select("review_id", "Emotion", "tokens"), "Emotion", o.test_size, o.seed)
    codes = vocabulary.label_codes(df.select("Emotion").distinct())
    names = [r["Emotion"] for r in codes.orderBy("label").collect()]  # one row per class
    # tables of tokens are written as Parquet, as a checkpoint is not compressed
    df = sinks.save_stage(df.join(F.broadcast(codes), "Emotion"), scratch_path(cleaned.sparkSession, "corpus"), "zstd")
    train = df.filter(F.col("split") == "train")
    corpus = train.select("review_id", "tokens")
    if o.sample > 0:
        corpus = sinks.save_stage(embeddings.subsample_rows(corpus, o.sample, o.seed), scratch_path(cleaned.sparkSession, "corpus"), "zstd")
    vectors = fit_word_vectors(corpus, o)
    weights = None
    if o.use_sif:
        freq = embeddings.tokens_long(train).groupBy("token").agg(F.count("*").alias("n"))
        weights = cut_lineage(embeddings.sif_weights(freq).join(vectors.select("token"), "token", "left_semi"))
    dv = embeddings.document_vectors(df, vectors, o.vector_size, weights, written=True)
    dv = dv.join(df.select("review_id", "Emotion", "label", "split"), "review_id")
    direction = None
    if o.use_sif and o.remove_pc:
        dv = cut_lineage(dv)
        fit_rows = dv.filter(F.col("split") == "train")
        if fit_rows.limit(3).count() > 2:
            direction = embeddings.principal_direction(fit_rows)
            dv = embeddings.remove_direction(dv, direction)
    if o.l2:
        dv = embeddings.l2_normalise(dv)
    return cut_lineage(dv), {"names": names, "vectors": vectors, "weights": weights, "direction": direction}


def train_and_evaluate(
    cleaned: DataFrame, o: TrainOptions = TrainOptions(), clean: text.CleanOptions = text.CleanOptions(), lemmas: DataFrame | None = None,
) -> Results:
    """Cross-validate and fit forest and boosting, tune the ensemble, evaluate all on the held-out part.

    ``clean`` and ``lemmas`` say how the tokens of ``cleaned`` were made; the scorer repeats it.
    """
    dv, fitted = featurise_corpus(cleaned, o)
    names, k = fitted["names"], len(fitted["names"])
    cols = ["review_id", "label", "features"]
    train = dv.filter(F.col("split") == "train").select(*cols)
    test = dv.filter(F.col("split") == "test").select(*cols)
    method = o.balancing or splits.default_balancing(train, "label").first()["method"]

    def forest_fit(rows, weight):
        return models.fit_forest(rows, o.forest, weight)

    def boost_fit(rows, weight):
        return models.fit_boosting(rows, k, o.boost, weight)

    cv = {}
    if o.folds > 1:
        for name, fit in ((FOREST, forest_fit), (BOOSTING, boost_fit)):
            cv[name] = models.cv_metrics(cut_lineage(models.cross_validate(train, fit, o.folds, method, o.seed)))
    rows, weight = models.balanced(train, method, o.seed)
    forest = models.fit_forest(rows, o.forest, weight)
    if o.early_stop and train.limit(o.early_stop_rows + 1).count() > o.early_stop_rows:
        rows, weight = models.with_validation(train, method, seed=o.seed)
        boosting = models.fit_boosting(rows, k, o.boost, weight, "_held")
    else:
        boosting = models.fit_boosting(rows, k, o.boost, weight)
    w1, w2 = models.optimise_weights(train, k, o.forest, o.boost, o.seed, method) if o.optimise_weights else (0.5, 0.5)
    scorer = Scorer(fitted["vectors"], names, o.vector_size, forest, boosting, w1, w2, fitted["weights"], fitted["direction"], o.l2, clean, lemmas)
    keep = ["review_id", "label", "probability", "prediction"]
    tested = [
        models.clip(m.predict(test)).select(*keep, F.lit(name).alias("model"))
        for name, m in ((FOREST, forest), (BOOSTING, boosting), (ENSEMBLE, scorer.predictor()))
    ]
    predictions = cut_lineage(tested[0].unionByName(tested[1]).unionByName(tested[2]))
    return Results(
        evaluation.metrics_table(predictions), cv, predictions,
        {FOREST: forest.importances(), BOOSTING: boosting.importances()}, names,
        embeddings.describe(o.use_sif, o.remove_pc, o.l2), scorer,
    )
