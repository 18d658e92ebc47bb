"""Every registered query of the message work on empty tables; rows that share an id."""

import math

import pytest
from pyspark.sql import functions as F

from smishlens.operators.naive_bayes import fit_naive_bayes
from smishlens.operators.tfidf import fit_tfidf, term_counts, top_terms, vocabulary_stats
from smishlens.plans import solver_checks as CK
from smishlens.plans.catalog import QUERIES

SF0001 = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "events")
#: Solvers need rows of both classes; Spark's own error tells when there are none.
NEEDS_ROWS = {"lr_fit", "svm_platt", "forest", "compare_ml", "best_of_four", "ensemble_fit", "compare_ml_metrics", "ml_scores",
              "production_refit", "production_refit_svm", "evaluate_saved"}
#: A table of counts or metrics has its rows even when all are zero or null.
ALWAYS = {"accuracy_prf": 1, "class_report": 5, "logit_metrics": 1, "confusion": 4, "roc_auc": 1, "roc_points": 1}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{SF0001}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NEEDS_ROWS))
def test_empty_tables(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    assert len(rows) == ALWAYS.get(name, 0), rows


def messages(spark):
    rows = [(1, "alpha beta", 1), (1, "gamma delta", 0), (2, "alpha gamma", 1), (2, "alpha gamma", 1), (None, "beta", 0)]
    return spark.createDataFrame(rows, "msg_id long, message string, label int")


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    df = messages(spark)
    model = fit_tfidf(df)
    out = model.transform_long(df).collect()
    assert len(out) == 9 and sum(r["tfidf"] ** 2 for r in out) == pytest.approx(5.0)
    assert sorted(r["term"] for r in out if r["msg_id"] == 1) == ["alpha", "beta", "delta", "gamma"]
    nb = fit_naive_bayes(model, df)
    got = nb.predict(df, keep=["label"]).collect()
    assert sorted(str(r["msg_id"]) for r in got) == ["1", "1", "2", "2", "None"]
    same = [r["p"] for r in got if r["msg_id"] == 2]
    assert same[0] == same[1] and len({r["p"] for r in got if r["msg_id"] == 1}) == 2


def test_a_model_of_no_rows_gives_even_odds(spark):
    df = messages(spark)
    nb = fit_naive_bayes(fit_tfidf(df.limit(0)), df.limit(0))
    out = nb.predict(df).collect()
    assert len(out) == 5 and all(math.isclose(r["p"], 0.5) and r["prediction"] == 0 for r in out)


@pytest.mark.parametrize("top,buckets", [(1, 4), (7, 4), (7, 64), (40, 64), (200, 1 << 16), (10_000, 16)])
def test_top_terms_are_exact_with_ties_at_the_edge(spark, top, buckets):
    # term t occurs 1 + t // 10 times, so every total has ten terms
    rows = spark.range(300).select(F.format_string("t%03d", "id").alias("term"), F.explode(F.sequence(F.lit(0), F.floor(F.col("id") / 10))).alias("k"))
    counts = rows.select("term", F.lit(1).cast("long").alias("tf"))
    want = [tuple(r) for r in vocabulary_stats(counts).orderBy(F.col("total").desc(), "term").limit(top).collect()]
    assert [tuple(r) for r in top_terms(counts, top, buckets).collect()] == want
    assert top_terms(counts.limit(0), top, buckets).count() == 0


def test_term_counts_of_nothing(spark):
    assert term_counts(spark.createDataFrame([(1, None), (2, "")], "msg_id long, message string")).count() == 0


def test_weights_in_a_wrong_direction_are_found(spark):
    import numpy as np
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 6))
    rows = [(float(x @ [1, -2, 0.5, 0, 0, 1] + rng.normal() > 0), Vectors.sparse(6, range(6), x) if i % 2 else Vectors.dense(x))
            for i, x in enumerate(points)]
    train = spark.createDataFrame(rows, ["label", "features"])
    model = LinearSVC(regParam=1 / 200, standardization=False, tol=1e-6, maxIter=500).fit(train)
    weights, reg = model.coefficients.toArray(), 1 / 200
    assert CK.hinge_excess(model, train, 200) <= CK.SVM_EXCESS
    across = rng.normal(size=6)
    across -= across @ weights / (weights @ weights) * weights
    across *= np.linalg.norm(weights) / np.linalg.norm(across)
    turned = np.cos(0.2) * weights + np.sin(0.2) * across
    assert CK.excess_at(turned, model.intercept, reg, train, 200) > CK.SVM_EXCESS
