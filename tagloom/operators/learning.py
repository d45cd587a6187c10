"""Classifiers on ``pyspark.ml``, their training, comparison and cross-validation.

A training frame holds ``features`` (vector), ``label_idx`` (double) and ``weight`` (balanced).
Every fitted model's ``transform`` adds ``prediction`` and the array ``proba``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from importlib import import_module
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions.vectors import softmax
from ..scratch import Scratch, compact, settled
from .aggregates import with_class_weight
from .articles import encode_labels
from .boosting import GradientBoosting, fit_gbm  # noqa: F401
from .evaluation import classification_scores
from .features import packed_terms, packed_tfidf, row_count, unpacked, vocabulary
from .ffnn import FeedForward, fit_ffnn  # noqa: F401
from .forest import RandomForest, fit_forest
from .passes import vector_columns
from .ranking import stratified_kfold
from .svm import CalibratedSvc, fit_svc_calibrated  # noqa: F401

_COLUMNS = dict(featuresCol="features", labelCol="label_idx")
_SCORES = ("rawPrediction", "probability")
_PARALLEL_FITS = 8
FOREST_WIDTH = 2048  # columns up to which the forest holds rows densely


def training_frame(df: DataFrame, label: str, codes: DataFrame | None = None) -> DataFrame:
    """Adds ``label_idx`` by sorted label and the balanced ``weight``."""
    codes = settled(encode_labels(df, label)) if codes is None else codes
    coded = df.join(codes.select(label, F.col("label_idx").cast("double").alias("label_idx")), label)
    return with_class_weight(coded, "label_idx")


def vector_features(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def _columns(train: DataFrame, *more: str) -> DataFrame:
    return train.select("features", "label_idx", "weight", *more)


class FittedClassifier:
    """A fitted model whose output carries ``prediction`` and ``proba``."""

    def __init__(self, model):
        self.model = model

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        if "probability" in out.columns:
            proba = vector_to_array("probability")
        else:
            proba = softmax(vector_to_array("rawPrediction"))
        return out.withColumn("proba", proba).drop(*_SCORES)

    def save(self, path: str) -> None:
        self.model.write().save(path)


def fit_lr(train: DataFrame, max_iter: int = cfg.LR_MAX_ITER, c: float = cfg.PENALTY_C,
           tol: float = cfg.LR_TOLERANCE) -> FittedClassifier:
    """Balanced multinomial regression; the penalty equals ``C`` on the sum of weighted losses."""
    with compact(_columns(train)) as rows:
        total = rows.agg(F.sum("weight")).first()[0]
        lr = LogisticRegression(maxIter=max_iter, tol=tol, regParam=1.0 / (c * total), standardization=False,
                                family="multinomial", weightCol="weight", **_COLUMNS)
        return FittedClassifier(lr.fit(rows))


def fit_rf(train: DataFrame, trees: int = cfg.RF_TREES, depth: int = cfg.RF_MAX_DEPTH,
           seed: int = cfg.SEED) -> RandomForest | FittedClassifier:
    """Balanced forest; rows of very many columns, as of sparse terms, go to Spark's own."""
    size = F.max(vector_columns("features")[0]).alias("size")
    if (train.agg(size).first()[0] or 0) <= FOREST_WIDTH:
        return fit_forest(train, trees, depth, seed)
    rf = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", **_COLUMNS)
    with compact(_columns(train)) as rows:
        return FittedClassifier(rf.fit(rows))


def fit_gaussian_nb(train: DataFrame) -> FittedClassifier:
    return FittedClassifier(NaiveBayes(modelType="gaussian", **_COLUMNS).fit(_columns(train)))


class MajorityClass:
    """Always the most frequent class of the training rows; ties go to the smallest."""

    def __init__(self, label, classes: int | None = None):
        self.label, self.classes = label, classes

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("prediction", F.lit(self.label))
        if self.classes is None:
            return out
        return out.withColumn("proba", F.array(*[F.lit(float(i == self.label)) for i in range(self.classes)]))


def majority_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Test rows with ``prediction`` set to the train mode, as one lazy plan."""
    return test.withColumn("prediction", train.agg(F.mode(label, True).alias("m")).scalar())


def fit_majority(train: DataFrame) -> MajorityClass:
    row = train.agg(F.mode("label_idx", True), F.max("label_idx")).first()
    return MajorityClass(row[0], int(row[1]) + 1)


Fit = Callable[[DataFrame], object]


def model_registry(key: str, dense: bool = True) -> dict[str, Fit]:
    """Name → function fitting a fresh estimator; the dense-only model is left out for sparse input."""
    out: dict[str, Fit] = {
        "LR": fit_lr,
        "SVC": lambda train: fit_svc_calibrated(train, key),
        "GBM": fit_gbm,
        "RF": fit_rf,
        "NB": fit_gaussian_nb,
        "FFNN": lambda train: fit_ffnn(train, key),
        "Dummy": fit_majority,
    }
    if not dense:
        del out["NB"], out["FFNN"]
    return out


def fit_all(fits: dict[str, Fit], train: DataFrame) -> dict[str, object]:
    """Every fitted model by name. The fits do not depend on each other and share the cluster."""
    names = list(fits)
    with compact(train) as rows, ThreadPool(max(1, min(len(names), _PARALLEL_FITS))) as pool:
        return dict(zip(names, pool.map(lambda name: fits[name](rows), names, chunksize=1)))


def train_and_evaluate(fit: Fit, train: DataFrame, test: DataFrame):
    """Fitted model and its ``acc, f1_macro, f1_weighted`` on the test rows."""
    model = fit(train)
    return model, classification_scores(model.transform(test), "label_idx", "prediction")


def compare_models(fits: dict[str, Fit], train: DataFrame, test: DataFrame) -> tuple[DataFrame, dict[str, object]]:
    """Scores of every model, best macro-F1 first, and the fitted models."""
    models = {}
    with compact(train) as fit_on, compact(test) as score_on:

        def scored(name: str) -> tuple:
            models[name], scores = train_and_evaluate(fits[name], fit_on, score_on)
            return name, *scores.first()

        with ThreadPool(max(1, min(len(fits), _PARALLEL_FITS))) as pool:
            rows = pool.map(scored, list(fits), chunksize=1)
    results = train.sparkSession.createDataFrame(rows, "model string, acc double, f1_macro double, f1_weighted double")
    return compare_sort(results), {name: models[name] for name in fits}


def compare_sort(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("f1_macro"), *[c for c in ("model", "run") if c in results.columns])


class TfidfVectorizer(Estimator):
    """``tokens`` to TF-IDF ``features``; as a stage its idf is fitted on the training rows only."""

    def __init__(self, key: str, max_features: int = cfg.CLASSIFIER_VOCAB_SIZE, min_df: int = cfg.CLASSIFIER_MIN_DF,
                 max_df: float = 1.0, lo: int = 1, hi: int = 2):
        super().__init__()
        if not max_features:
            raise ValueError("max_features must bound the vocabulary")
        self.key, self.max_features, self.min_df, self.max_df, self.lo, self.hi = key, max_features, min_df, max_df, lo, hi

    def _fit(self, dataset: DataFrame) -> TfidfModel:
        counts = unpacked(packed_terms(dataset, self.key, lo=self.lo, hi=self.hi), self.key)
        vocab = vocabulary(counts, row_count(dataset), self.min_df, self.max_df, self.max_features)
        place = F.row_number().over(Window.orderBy("term")) - 1
        fitted = Scratch(dataset.sparkSession, "tfidf").write(vocab.withColumn("idx", place), "vocabulary")
        return TfidfModel(self.key, fitted, fitted.count(), self.lo, self.hi)


class TfidfModel(Model):
    def __init__(self, key: str, vocab: DataFrame, size: int, lo: int, hi: int):
        super().__init__()
        self.key, self.vocab, self.size, self.lo, self.hi = key, vocab, size, lo, hi

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = packed_tfidf(packed_terms(dataset, self.key, lo=self.lo, hi=self.hi), self.vocab, self.key)
        indexed = weights.join(F.broadcast(self.vocab.select("term", "idx")), "term")
        entries = indexed.groupBy(self.key).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("e"))
        out = dataset.join(entries, self.key, "left")
        return out.withColumn("features", sparse_vector(F.col("e"), self.size)).drop("e")


@F.pandas_udf(VectorUDT())
def _sparse(sizes: pd.Series, indices: pd.Series, values: pd.Series) -> pd.DataFrame:
    kind = np.zeros(len(sizes), np.int8)  # of sparse vectors
    return pd.DataFrame({"type": kind, "size": sizes, "indices": indices, "values": values})


def sparse_vector(entries, size: int):
    """Sparse ML vector of ``(idx, weight)`` entries; none for a row without entries."""
    e = F.coalesce(entries, F.array().cast("array<struct<idx:int,weight:double>>"))
    return _sparse(F.lit(size), F.transform(e, lambda x: x["idx"]), F.transform(e, lambda x: x["weight"]))


class TextClassifier:
    """TF-IDF and a classifier fitted as one unit, stored and loaded as one."""

    def __init__(self, features: TfidfModel, model):
        self.features, self.model = features, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.features.transform(df))

    def save(self, path: str) -> None:
        f = self.features
        f.vocab.write.parquet(f"{path}/vocabulary")
        self.model.save(f"{path}/model")
        own = self.model.model if isinstance(self.model, FittedClassifier) else self.model
        about = [(f.key, f.lo, f.hi, type(own).__module__, type(own).__name__)]
        SparkSession.active().createDataFrame(about, "key string, lo int, hi int, module string, name string").write.parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        about = spark.read.parquet(f"{path}/about").first()
        kind = getattr(import_module(about.module), about.name)
        ours = about.module.startswith(__package__.split(".")[0])
        model = kind.load(spark, f"{path}/model") if ours else FittedClassifier(kind.load(f"{path}/model"))
        vocab = spark.read.parquet(f"{path}/vocabulary")
        return cls(TfidfModel(about.key, vocab, vocab.count(), about.lo, about.hi), model)


def fit_tfidf_classifier(fit: Fit, key: str, vectorizer: TfidfVectorizer | None = None) -> Fit:
    def run(train: DataFrame) -> TextClassifier:
        features = (vectorizer or TfidfVectorizer(key)).fit(train)
        rows = features.transform(train).select(key, "label_idx", "weight", "features")
        return TextClassifier(features, fit(Scratch(train.sparkSession, "text-train").write(rows, "rows")))

    return run


def cross_validate(fit: Fit, df: DataFrame, key: str, folds: int = cfg.FOLDS) -> DataFrame:
    """Macro-F1 per fold with the mean and the population deviation beside it.

    Folds are balanced per label. Weights are recomputed on each training part. The folds are
    independent of each other and share the cluster.
    """
    with compact(stratified_kfold(df.drop("weight"), "label_idx", key, folds)) as rows:

        def scored(f: int) -> tuple[int, float]:
            train = with_class_weight(rows.where(F.col("fold") != f), "label_idx")
            test = rows.where(F.col("fold") == f)
            _, score = train_and_evaluate(fit, train, test)
            value = score.first()["f1_macro"]
            return f, 0.0 if value is None else float(value)

        with ThreadPool(min(folds, _PARALLEL_FITS)) as pool:
            scores = pool.map(scored, range(folds), chunksize=1)
    out = df.sparkSession.createDataFrame(scores, "fold int, f1_macro double")
    return out.withColumns({"mean": out.agg(F.avg("f1_macro")).scalar(), "std": out.agg(F.stddev_pop("f1_macro")).scalar()})


def majority_vote(df: DataFrame, key: str, members: Sequence[str]) -> DataFrame:
    """Most frequent member prediction of each row, counted in place; ties go to the smallest label."""
    votes = F.array(*[F.col(m) for m in members])
    tally = F.transform(
        F.array_distinct(votes),
        lambda v: F.struct((-F.size(F.filter(votes, lambda x: x == v))).alias("minus_n"), v.alias("label")),
    )
    return df.select(key, F.array_min(tally)["label"].alias("prediction"))


def mean_proba(df: DataFrame, key: str, members: Sequence[str]) -> DataFrame:
    from ..functions.vectors import mean_probability

    return df.select(key, mean_probability(F.array(*[F.col(m) for m in members])).alias("proba"))
