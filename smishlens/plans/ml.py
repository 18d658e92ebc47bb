"""Spark ML members of the comparison (inventory H2-H7, H9, M1, M4) and model
persistence (A5, A6).

Features are computed once per comparison: the vocabulary and IDF weights come
from the SQL fit (``fit_tfidf``: top 10,000 terms, ties by term), and are turned
into Spark ML stages ``CountVectorizerModel.from_vocabulary`` ->
``ElementwiseProduct(idf)`` -> ``Normalizer(p=2)``, all narrow row-wise stages.
Every classifier then runs as a Spark ML estimator, distributed as usual.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    LinearSVC, LinearSVCModel, LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.functions.scores import threshold_decision
from smishlens.operators.forest import SparseForest
from smishlens.operators.tfidf import MAX_FEATURES, TfidfModel, fit_tfidf
from smishlens.operators import metrics as M
from smishlens.operators.urls import tokenise_urls
from smishlens.operators.vocabulary import normalise_texts
from smishlens.session import path_exists, shared_table

# The reference's model settings.
C = 1.0
N_TREES = 100
FOREST_SEED = 42
LR_MAX_ITER = 1000
# Stopping tolerances. The reference's are bounds on a gradient, Spark's on the
# relative change of the objective; this one brings the gradient's norm under 1e-3.
LR_TOL = 1e-5
SVM_TOL = 1e-3
# The reference sets no iteration limit for the SVM and no depth for the trees.
# Spark needs both: these are parameters; 30 is the deepest that Spark allows.
SVM_MAX_ITER = 1000
FOREST_MAX_DEPTH = 30
# Spark's forest keeps a dense row of all binned features, 40 KB a message; beyond so many
# training rows the same forest is grown over sparse rows.
FOREST_DENSE_ROWS = 16_384
PLATT_FOLDS = 5
MODEL_ORDER = ("random_forest", "logistic_regression", "naive_bayes", "svm")
# Independent fits are submitted from a small thread pool, as Spark's own
# CrossValidator does with its ``parallelism`` param: iterative solvers on
# small data are bound by per-iteration job latency, not by the cluster.
FIT_PARALLELISM = 6


def fit_all(pairs):
    """Fit ``[(estimator, dataframe), ...]`` concurrently; models in order."""
    with ThreadPoolExecutor(max_workers=max(1, min(FIT_PARALLELISM, len(pairs)))) as pool:
        return list(pool.map(lambda p: p[0].fit(p[1]), pairs))


class TextPreprocessor(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """M1: clean text (URL tokens, accents, numbers, punctuation, case) and
    re-join whitespace tokens with one blank. URLs listed in the ``(url,
    threat_type)`` parquet table at ``threatsPath`` are suspicious, all others
    (or all, without a table) trusted. Then, as in the reference, lemmas before
    stems: ``useLemma`` looks tokens up in the ``(word, lemma)`` parquet table at
    ``lemmaPath`` (no lexicon is bundled, so the table is required); ``useStem``
    Porter-stems every token (always the English rules, as the reference
    does, whatever ``language`` says)."""

    useLemma = Param(Params._dummy(), "useLemma", "lemmatise tokens", TypeConverters.toBoolean)
    useStem = Param(Params._dummy(), "useStem", "stem tokens", TypeConverters.toBoolean)
    language = Param(Params._dummy(), "language", "language name", TypeConverters.toString)
    lemmaPath = Param(Params._dummy(), "lemmaPath", "parquet table (word, lemma) used by useLemma",
                      TypeConverters.toString)
    threatsPath = Param(Params._dummy(), "threatsPath", "parquet table (url, threat_type) of listed URLs",
                        TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="message", outputCol="clean", useLemma=False, useStem=False, language="english",
                 lemmaPath="", threatsPath=""):
        super().__init__()
        self._setDefault(inputCol="message", outputCol="clean", useLemma=False, useStem=False, language="english",
                         lemmaPath="", threatsPath="")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, source = dataset.sparkSession, self.getInputCol()
        path, threats = self.getOrDefault(self.threatsPath), None
        if path:
            threats = spark.read.parquet(path).select("url", "threat_type")
        # No row id here: equal texts share their URL flags, so the text's hash is id enough.
        # The URL join takes a second hash of the text beside this one, with another seed.
        keyed = dataset.withColumn("_rid", F.xxhash64(F.lit("row"), source))
        tokenised = tokenise_urls(keyed, threats, source, "_rid", "_url_text")
        cleaned = T.join_tokens(T.whitespace_tokens(T.clean_after_urls(F.col("_url_text"))))
        out = tokenised.withColumn(self.getOutputCol(), cleaned).drop("_rid", "_url_text")
        lemmas = None
        if self.getOrDefault(self.useLemma):
            path = self.getOrDefault(self.lemmaPath)
            if not path:
                raise ValueError("useLemma needs lemmaPath: a parquet table (word, lemma); no lexicon is bundled")
            lemmas = spark.read.parquet(path).select("word", "lemma")
        # Lookups run on the distinct texts and join back on a hash of the text.
        return normalise_texts(out, self.getOutputCol(), lemmas, self.getOrDefault(self.useStem))


class TopTermsTfidf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Vectoriser estimator: SQL vocabulary fit, Spark ML stages for transform.
    Its fitted model is a ``PipelineModel`` (writable as any pipeline)."""

    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary cap", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="clean", outputCol="features", maxFeatures=MAX_FEATURES):
        super().__init__()
        self._setDefault(inputCol="clean", outputCol="features", maxFeatures=MAX_FEATURES)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        with_id = dataset.select(F.col(self.getInputCol()).alias("message"),
                                 F.xxhash64(self.getInputCol()).alias("_rid"))
        model = fit_tfidf(with_id, id_col="_rid", max_features=self.getOrDefault(self.maxFeatures))
        return tfidf_stages(model, self.getInputCol(), self.getOutputCol())


#: Stands in a vocabulary without terms; tokens are word characters only.
NO_TERM = " "


def tfidf_stages(model: TfidfModel, input_col: str = "clean", output_col: str = "features") -> PipelineModel:
    """F4/F5 as Spark ML stages from a fitted vocabulary (at most 10,000
    terms, collected like any fitted vectoriser)."""
    rows = model.vocabulary.select("term", "idf").orderBy(F.col("total").desc(), "term").collect()
    vocab = [r["term"] for r in rows]
    if not vocab:  # no text: a term that no token equals, so that every row is the zero vector
        vocab, rows = [NO_TERM], [{"idf": 1.0}]
    idf = Vectors.dense([float(r["idf"]) for r in rows])
    tok = RegexTokenizer(inputCol=input_col, outputCol="_tokens", pattern=T.TOKEN_PATTERN, gaps=False,
                         toLowercase=True, minTokenLength=1)
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol="_tokens", outputCol="_tf")
    ew = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_tfidf_raw")
    norm = Normalizer(p=2.0, inputCol="_tfidf_raw", outputCol=output_col)
    return PipelineModel([tok, cv, ew, norm])


class NaiveBayesPrior(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Moves a naive Bayes stage to the unsmoothed class prior: Spark smooths it,
    so each class's raw score is off by a constant, the ``shift`` added here;
    probability and prediction are taken from the moved scores."""

    shift = Param(Params._dummy(), "shift", "added to the raw score of each class", TypeConverters.toListFloat)
    prefix = Param(Params._dummy(), "prefix", "prefix of the output columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, shift=None, prefix=""):
        super().__init__()
        self._setDefault(prefix="")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        prefix, shift = self.getOrDefault(self.prefix), self.getOrDefault(self.shift)
        raw = vector_to_array(F.col(f"{prefix}raw"))
        moved = F.array(*[raw[k] + F.lit(x) for k, x in enumerate(shift)])
        out = dataset.withColumn("_moved", moved)
        top = F.array_max("_moved")
        e = F.transform("_moved", lambda x: F.exp(x - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        return (out.withColumn(f"{prefix}raw", array_to_vector("_moved"))
                .withColumn(f"{prefix}probability", array_to_vector(F.transform(e, lambda x: x / total)))
                .withColumn(f"{prefix}prediction", (F.array_position("_moved", top) - 1).cast("double")).drop("_moved"))


class ExactNaiveBayes(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """H1 as a pipeline stage: multinomial naive Bayes (alpha 1) with the prior ln(n_c / n)."""

    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the output columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", prefix=""):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", prefix="")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        features, label, prefix = (self.getOrDefault(p) for p in (self.featuresCol, self.labelCol, self.prefix))
        model = NaiveBayes(smoothing=1.0, modelType="multinomial", featuresCol=features, labelCol=label,
                           predictionCol=f"{prefix}prediction", probabilityCol=f"{prefix}probability",
                           rawPredictionCol=f"{prefix}raw").fit(dataset)
        counts = {int(r[0]): int(r[1]) for r in dataset.groupBy(label).count().collect()}
        n = sum(counts.values())
        prior = [math.log(counts[k] / n) if counts.get(k) else -math.inf for k in range(model.numClasses)]
        shift = [float(x - p) for x, p in zip(prior, model.pi.toArray())]
        return PipelineModel([model, NaiveBayesPrior(shift=shift, prefix=prefix)])


class PlattSvm(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """H3: linear SVM whose margin is calibrated by Platt scaling.

    Out-of-fold margins (5 folds by a hash of the features) are fitted by a
    logistic regression on the margin with the smoothed Platt targets (N+ + 1)/(N+ + 2)
    and 1/(N- + 2), expressed as two weighted rows per message. The label is the
    sign of the margin; the probability may disagree with it, as in the
    reference. The fitted model is a pipeline of two stock stages (SVM, logistic
    regression on its raw scores), so it saves and loads as any pipeline."""

    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the output columns", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "iteration limit of the solver", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "folds of the calibration", TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", prefix="", maxIter=SVM_MAX_ITER, folds=PLATT_FOLDS):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", prefix="", maxIter=SVM_MAX_ITER, folds=PLATT_FOLDS)
        self._set(**self._input_kwargs)

    def _svm(self, n: int) -> LinearSVC:
        prefix = self.getOrDefault(self.prefix)
        return LinearSVC(regParam=1.0 / (C * max(n, 1)), standardization=False, tol=SVM_TOL,
                         maxIter=self.getOrDefault(self.maxIter), featuresCol=self.getOrDefault(self.featuresCol),
                         labelCol=self.getOrDefault(self.labelCol), predictionCol=f"{prefix}prediction",
                         rawPredictionCol=f"{prefix}raw")

    def _warn_at_limit(self, model: LinearSVCModel) -> LinearSVCModel:
        if model.hasSummary and model.summary().totalIterations >= self.getOrDefault(self.maxIter):
            warnings.warn(f"the SVM stopped at its limit of {self.getOrDefault(self.maxIter)} iterations", stacklevel=2)
        return model

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        label, prefix, folds = (self.getOrDefault(p) for p in (self.labelCol, self.prefix, self.folds))
        # of the sparse row: its indices and values, not an array of all features
        key = F.xxhash64(F.unwrap_udt(F.col(self.getOrDefault(self.featuresCol))), F.lit(FOREST_SEED))
        tagged = dataset.withColumn("_fold", F.pmod(key, F.lit(folds)))
        sizes = tagged.groupBy("_fold", label).count().collect()  # folds x classes
        n = sum(r["count"] for r in sizes)
        by_class = {k: sum(r["count"] for r in sizes if int(r[label]) == k) for k in (0, 1)}
        jobs = [(self._svm(n), dataset)]
        used = []
        for k in range(folds):
            held = sum(r["count"] for r in sizes if r["_fold"] == k)
            left = {int(r[label]) for r in sizes if r["_fold"] != k}
            if held and len(left) == 2:  # a fold without one of the classes can't be fitted
                jobs.append((self._svm(n - held), tagged.filter(F.col("_fold") != k)))
                used.append(k)
        svm, *parts = [self._warn_at_limit(m) for m in fit_all(jobs)]
        scored = None
        for k, m in zip(used, parts):
            part = m.transform(tagged.filter(F.col("_fold") == k)).select(label, f"{prefix}raw")
            scored = part if scored is None else scored.unionByName(part)
        if scored is None:
            scored = svm.transform(dataset).select(label, f"{prefix}raw")
        target = F.when(F.col(label) == 1, (by_class[1] + 1.0) / (by_class[1] + 2.0)).otherwise(1.0 / (by_class[0] + 2.0))
        pairs = scored.select(f"{prefix}raw", target.alias("_t")).select(
            f"{prefix}raw", F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("_t").alias("w")),
                                              F.struct(F.lit(0.0).alias("y"), (1 - F.col("_t")).alias("w")))).alias("_p"))
        platt = LogisticRegression(featuresCol=f"{prefix}raw", labelCol="y", weightCol="w", regParam=0.0,
                                   standardization=False, predictionCol=f"{prefix}platt_prediction",
                                   probabilityCol=f"{prefix}probability", rawPredictionCol=f"{prefix}platt_raw")
        return PipelineModel([svm, platt.fit(pairs.select(f"{prefix}raw", "_p.y", "_p.w"))])


class MeanProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """H5: the mean of the members' class probabilities (equal weights); class 1
    when its mean is above 0.5."""

    members = Param(Params._dummy(), "members", "prefixes of the members", TypeConverters.toListString)

    @keyword_only
    def __init__(self, members=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        members = self.getOrDefault(self.members)
        p = sum((vector_to_array(F.col(f"{m}_probability"))[1] for m in members), F.lit(0.0)) / F.lit(float(len(members)))
        out = dataset.withColumn("_p", p)
        return (out.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))))
                .withColumn("prediction", F.when(F.col("_p") > 0.5, 1.0).otherwise(0.0)).drop("_p"))


class SoftVote(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """H5: all members fitted on the same features, then the mean probability."""

    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    members = Param(Params._dummy(), "members", "model names", TypeConverters.toListString)
    nTrain = Param(Params._dummy(), "nTrain", "training rows", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth limit of the trees", TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", members=None, nTrain=1, maxDepth=FOREST_MAX_DEPTH):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", members=list(MODEL_ORDER), nTrain=1,
                         maxDepth=FOREST_MAX_DEPTH)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        names, n = self.getOrDefault(self.members), self.getOrDefault(self.nTrain)
        columns = dict(features=self.getOrDefault(self.featuresCol), label=self.getOrDefault(self.labelCol))
        depth = self.getOrDefault(self.maxDepth)
        return self.of(dict(zip(names, fit_all([(estimator(m, n, max_depth=depth, **columns), dataset) for m in names]))))

    def of(self, fitted: dict[str, Model]) -> PipelineModel:
        """The ensemble of members that are fitted already, on the same features with the same settings."""
        names = self.getOrDefault(self.members)
        return PipelineModel([*[prefixed(fitted[m], f"{m}_") for m in names], MeanProbability(members=names)])


#: Columns that the models of the registry write, without a prefix.
_WRITTEN = ("prediction", "probability", "raw", "platt_prediction", "platt_raw")


def prefixed(model: Model, prefix: str) -> Model:
    """A copy of a fitted model without a prefix that writes its columns with one."""
    if isinstance(model, PipelineModel):
        return PipelineModel([prefixed(stage, prefix) for stage in model.stages])
    out = model.copy()
    if isinstance(out, NaiveBayesPrior):
        return out._set(prefix=prefix)
    names = [n for n in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol") if out.hasParam(n)]
    return out._set(**{n: prefix + out.getOrDefault(n) for n in names if out.getOrDefault(n) in _WRITTEN})


ENSEMBLE = "ensemble"


def estimator(name: str, n_train: int, features: str = "features", label: str = "label", prefix: str = "",
              max_depth: int = FOREST_MAX_DEPTH, svm_max_iter: int = SVM_MAX_ITER) -> Estimator:
    """M4: model registry, name -> configured estimator. Every fitted model writes
    ``{prefix}prediction`` and ``{prefix}probability`` and can be saved."""
    cols = dict(featuresCol=features, labelCol=label)
    out = dict(predictionCol=f"{prefix}prediction", probabilityCol=f"{prefix}probability", rawPredictionCol=f"{prefix}raw")
    if name == "random_forest":
        forest = SparseForest if n_train > FOREST_DENSE_ROWS else RandomForestClassifier
        return forest(numTrees=N_TREES, seed=FOREST_SEED, featureSubsetStrategy="sqrt", impurity="gini",
                      maxDepth=max_depth, **cols, **out)
    if name == "logistic_regression":
        return LogisticRegression(maxIter=LR_MAX_ITER, tol=LR_TOL, regParam=1.0 / (C * max(n_train, 1)),
                                  elasticNetParam=0.0, standardization=False, **cols, **out)
    if name == "naive_bayes":
        return ExactNaiveBayes(prefix=prefix, **cols)
    if name == "svm":
        return PlattSvm(prefix=prefix, maxIter=svm_max_iter, **cols)
    if name == ENSEMBLE:
        return SoftVote(nTrain=n_train, maxDepth=max_depth, **cols)
    raise ValueError(f"unknown model {name!r}")


def positive_probability(prob_col: str) -> F.Column:
    return vector_to_array(F.col(prob_col))[1]


def scores(model: Model, df: DataFrame, id_col: str = "msg_id") -> DataFrame:
    """``(id, label, prediction, p)`` of a fitted model or pipeline."""
    return model.transform(df).select(id_col, "label", F.col("prediction").cast("int").alias("prediction"),
                                      positive_probability("probability").alias("p"))


def fit_models(train: DataFrame, n_train: int, models: tuple[str, ...] = MODEL_ORDER,
               max_depth: int = FOREST_MAX_DEPTH) -> dict[str, Model]:
    """H7: every configured model, fitted on the same features. An ensemble beside all its members is made of
    those, which are fitted once: it would fit each again on the same rows with the same settings and seeds."""
    todo = {m: estimator(m, n_train, max_depth=max_depth) for m in models}
    vote = todo.get(ENSEMBLE)
    if vote is not None and set(vote.getOrDefault(vote.members)) <= set(models):
        del todo[ENSEMBLE]
    fitted = dict(zip(todo, fit_all([(e, train) for e in todo.values()])))
    return {m: fitted[m] if m in fitted else vote.of(fitted) for m in models}


def ml_predictions(fitted: dict[str, Model], test: DataFrame, id_col: str = "msg_id") -> DataFrame:
    """H7: long ``(model, id, label, prediction, p)`` table of the test part."""
    out = None
    for name, model in fitted.items():
        scored = scores(model, test, id_col).select(F.lit(name).alias("model"), "*")
        out = scored if out is None else out.unionByName(scored)
    return out


def soft_vote(preds: DataFrame, id_col: str = "msg_id") -> DataFrame:
    """H5 on a long probability table: mean class-1 probability per message
    (equal weights); class 1 iff mean p1 > mean p0, i.e. mean p1 > 0.5."""
    agg = preds.groupBy(id_col).agg(F.first("label").alias("label"), F.avg("p").alias("p"))
    return agg.withColumn("prediction", F.when(F.col("p") > F.lit(0.5), 1).otherwise(0))


# ---- A5 / A6 / H6 / H9: pipelines, persistence, comparison and production refit ---------
def text_pipeline(model_name: str, n_train: int, use_lemma: bool = False, use_stem: bool = False,
                  language: str = "english", lemma_path: str = "", threats_path: str = "",
                  max_depth: int = FOREST_MAX_DEPTH) -> Pipeline:
    """H6: preprocess -> TF-IDF -> classifier (any of M4, the ensemble included)."""
    return Pipeline(stages=[
        TextPreprocessor(inputCol="message", outputCol="clean", useLemma=use_lemma, useStem=use_stem,
                         language=language, lemmaPath=lemma_path, threatsPath=threats_path),
        TopTermsTfidf(inputCol="clean", outputCol="features"),
        estimator(model_name, n_train, max_depth=max_depth),
    ])


def save_model(spark: SparkSession, model: PipelineModel, path: str, meta: dict) -> None:
    """A5: pipeline directory plus a one-row JSON metadata table next to it."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """A5: load a saved pipeline; a missing artefact raises FileNotFoundError,
    any other failure is raised as it is."""
    if not path_exists(spark, f"{path}/meta"):
        raise FileNotFoundError(f"no saved model at {path}: run the comparison first")
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return PipelineModel.load(f"{path}/model"), meta


@dataclass
class Comparison:
    table: DataFrame     # I8: one row per model
    best: str            # H8: highest accuracy, first in the order on ties
    predictions: DataFrame
    pipelines: dict[str, PipelineModel]


def best_path(model_dir: str, language: str) -> str:
    return f"{model_dir}/best_{language}"


def compare_and_save(spark: SparkSession, train: DataFrame, test: DataFrame, model_dir: str, language: str = "english",
                     models: tuple[str, ...] = MODEL_ORDER, use_lemma: bool = False, use_stem: bool = False,
                     lemma_path: str = "", threats_path: str = "", max_depth: int = FOREST_MAX_DEPTH,
                     id_col: str = "msg_id") -> Comparison:
    """Compare entry: features are fitted once on the train part, every model on
    them; the test part is scored; the best model's whole pipeline is saved
    with its name as the best model of the language."""
    text = TextPreprocessor(inputCol="message", outputCol="clean", useLemma=use_lemma, useStem=use_stem,
                            language=language, lemmaPath=lemma_path, threatsPath=threats_path)
    clean = shared_table(text.transform(train.select(id_col, "message", F.col("label").cast("double").alias("label"))),
                         "compare_clean")
    features = TopTermsTfidf(inputCol="clean", outputCol="features").fit(clean)
    ready = shared_table(features.transform(clean).select(id_col, "label", "features"), "compare_train")
    fitted = fit_models(ready, ready.count(), models, max_depth)
    tested = text.transform(test.select(id_col, "message", F.col("label").cast("double").alias("label")))
    tested = shared_table(features.transform(tested).select(id_col, "label", "features"), "compare_test")
    preds = shared_table(ml_predictions(fitted, tested, id_col), "compare_predictions")
    table = shared_table(M.compare_models(preds), "compare_table")
    best = M.best_model(table, {m: k for k, m in enumerate(models)}).first()["model"]
    pipelines = {m: PipelineModel([text, features, fitted[m]]) for m in models}
    save_model(spark, pipelines[best], best_path(model_dir, language),
               {"model_key": best, "language": language, "use_lemma": use_lemma, "use_stem": use_stem,
                "lemma_path": lemma_path, "threats_path": threats_path})
    return Comparison(table, best, preds, pipelines)


def refit_production(spark: SparkSession, messages: DataFrame, model_dir: str, language: str,
                     model_key: str | None = None, threshold: float = 0.5, today: dt.date | None = None,
                     use_lemma: bool | None = None, use_stem: bool | None = None, lemma_path: str | None = None,
                     threats_path: str | None = None, max_depth: int = FOREST_MAX_DEPTH) -> PipelineModel:
    """Refit the chosen pipeline on all rows; save it as
    ``pipeline_{language}`` and ``{language}/production/{key}_prod_{yyyymmdd}``,
    the threshold stored in the metadata. Without ``model_key`` the saved
    best model's name and flags are used (each flag can be overridden)."""
    known = {}
    if model_key is None:
        _, known = load_model(spark, best_path(model_dir, language))
        model_key = known["model_key"]
    flags = {name: known.get(name, default) if value is None else value for name, value, default in (
        ("use_lemma", use_lemma, False), ("use_stem", use_stem, False),
        ("lemma_path", lemma_path, ""), ("threats_path", threats_path, ""))}
    # the text is cleaned once and the features are written once, whatever passes the fit makes
    text, vectoriser, classifier = text_pipeline(model_key, messages.count(), language=language, max_depth=max_depth, **flags).getStages()
    clean = shared_table(text.transform(messages.select("message", "label")).select("clean", "label"), "refit_clean")
    features = vectoriser.fit(clean)
    ready = shared_table(features.transform(clean).select("features", "label"), "refit_features")
    model = PipelineModel([text, features, classifier.fit(ready)])
    stamp = (today or dt.date.today()).strftime("%Y%m%d")
    meta = {"model_key": model_key, "threshold": threshold, "language": language, "date": stamp, **flags}
    save_model(spark, model, f"{model_dir}/pipeline_{language}", meta)
    save_model(spark, model, f"{model_dir}/{language}/production/{model_key}_prod_{stamp}", meta)
    return model


@dataclass
class Evaluation:
    predictions: DataFrame  # id, label, p, prediction
    report: DataFrame       # I5 class report
    confusion: DataFrame    # I1
    auc: DataFrame          # I6
    roc: DataFrame          # I7
    meta: dict


def evaluate(spark: SparkSession, messages: DataFrame, model_path: str, id_col: str = "msg_id",
             label_col: str = "label", threshold: float | None = None) -> Evaluation:
    """Evaluate entry: a saved pipeline (A5; missing artefact ->
    FileNotFoundError) scores preprocessed, labelled messages; the class
    report, confusion matrix, ROC AUC and ROC points are small aggregations
    over one written prediction table (scored once, read four times).

    The prediction is the model's own, or ``p >= threshold`` (H10) when one is given."""
    model, meta = load_model(spark, model_path)
    scored = model.transform(messages.withColumn("_label", F.col(label_col).cast("int")))
    p = positive_probability("probability")
    prediction = F.col("prediction").cast("int") if threshold is None else threshold_decision(p, threshold)
    preds = shared_table(scored.select(id_col, F.col("_label").alias("label"), p.alias("p"),
                                       prediction.alias("prediction")), "evaluation")
    return Evaluation(preds, M.class_report(preds), M.confusion_matrix(preds), M.roc_auc(preds),
                      M.roc_points(preds), meta)
