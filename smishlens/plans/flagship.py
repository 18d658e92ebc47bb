"""The classic path end to end (model comparison entry, naive Bayes member).

preprocess (labels, URL join, cleaning) -> seeded stratified split ->
TF-IDF fitted on the train part -> naive Bayes -> scores of the test part.

The cleaned corpus is written once with its messages' term counts (the fit runs
several jobs over it and the test part is scored from it, so the text is cleaned and
tokenised only once); the split is a narrow pass over it with a
one-row-per-class cut table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smishlens.operators.naive_bayes import NaiveBayesModel, fit_naive_bayes
from smishlens.operators.preprocess import preprocess
from smishlens.operators.split import assign_split, split_cuts
from smishlens.operators.tfidf import ENTRIES, MAX_FEATURES, TfidfModel, fit_tfidf, with_entries
from smishlens.operators.vocabulary import text_preprocessor
from smishlens.session import shared_table
from smishlens.sources import testdata as D


@dataclass
class ClassicRun:
    split: DataFrame      # msg_id, message, label, split
    tfidf: TfidfModel
    nb: NaiveBayesModel
    predictions: DataFrame  # msg_id, label, p, prediction (test part)

    @property
    def train(self) -> DataFrame:
        return self.split.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.split.filter(F.col("split") == "test")


def prepared_split(messages: DataFrame, threats: DataFrame | None, test_size: float = 0.3, seed: int = 42,
                   lemmas: DataFrame | None = None, stems: DataFrame | None = None,
                   prep: DataFrame | None = None) -> DataFrame:
    """``prep``: an already preprocessed table to reuse (with its term counts, it
    is not written again)."""
    if prep is None:
        prep = preprocess(messages, threats)
    if lemmas is not None or stems is not None:
        prep = text_preprocessor(prep.drop(ENTRIES), lemmas, stems)
    prep = with_entries(prep)
    cuts = shared_table(split_cuts(prep, "label", test_size, seed), "cuts")
    return assign_split(prep, cuts, "label", seed)


def run_classic(messages: DataFrame, threats: DataFrame | None, test_size: float = 0.3, seed: int = 42,
                max_features: int = MAX_FEATURES, lemmas: DataFrame | None = None,
                stems: DataFrame | None = None, prep: DataFrame | None = None) -> ClassicRun:
    split = prepared_split(messages, threats, test_size, seed, lemmas, stems, prep)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    tfidf = fit_tfidf(train, max_features=max_features)
    nb = fit_naive_bayes(tfidf, train)
    preds = nb.predict(test, keep=["label"])
    return ClassicRun(split, tfidf, nb, preds)


def flagship(spark: SparkSession, sf_dir: str) -> ClassicRun:
    """``messages_es`` (learnable target) with the comparison defaults 0.3 / 42."""
    return run_classic(D.messages_es(spark, sf_dir), D.threats(spark, sf_dir))
