"""TF-IDF and naive Bayes against a NumPy statement of the same formulas,
metrics against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from smishlens.operators import metrics as M
from smishlens.operators.naive_bayes import fit_naive_bayes
from smishlens.operators.tfidf import fit_tfidf, term_counts

DOCS = [
    (1, "win a free prize now now", 1), (2, "call me later", 0), (3, "free money win win", 1),
    (4, "see you at lunch", 0), (5, "lunch later free", 0), (6, "prize prize claim now", 1),
    (7, "a b c", 0),  # no token of two characters: empty vector
]
TEST = [(10, "free prize lunch", 0), (11, "zz unknown words", 1), (12, "x", 0)]


def np_reference(max_features):
    toks = [re.findall(r"\b\w\w+\b", t.lower()) for _, t, _ in DOCS]
    total = Counter(w for ts in toks for w in ts)
    vocab = sorted(total, key=lambda w: (-total[w], w))[:max_features]
    idx = {w: i for i, w in enumerate(vocab)}
    n = len(DOCS)
    df = np.array([sum(1 for ts in toks if w in ts) for w in vocab], dtype=float)
    idf = np.log((1 + n) / (1 + df)) + 1

    def vec(text):
        v = np.zeros(len(vocab))
        for w in re.findall(r"\b\w\w+\b", text.lower()):
            if w in idx:
                v[idx[w]] += 1
        v = v * idf
        nrm = np.linalg.norm(v)
        return v / nrm if nrm > 0 else v
    X = np.array([vec(t) for _, t, _ in DOCS])
    y = np.array([lab for _, _, lab in DOCS])
    fc = np.array([X[y == c].sum(axis=0) for c in (0, 1)])
    logp = np.log((fc + 1) / (fc.sum(axis=1, keepdims=True) + len(vocab)))
    prior = np.log(np.array([(y == c).sum() for c in (0, 1)]) / n)
    jll = np.array([prior + logp @ vec(t) for _, t, _ in TEST])
    p1 = np.exp(jll[:, 1] - np.logaddexp(jll[:, 0], jll[:, 1]))
    return vocab, idf, logp, p1, jll.argmax(axis=1)


@pytest.mark.parametrize("max_features", [100, 5])
def test_tfidf_and_nb_match_numpy(spark, max_features):
    vocab, idf, logp, p1, pred = np_reference(max_features)
    train = spark.createDataFrame(DOCS, "msg_id long, message string, label int")
    test = spark.createDataFrame(TEST, "msg_id long, message string, label int")
    tf = fit_tfidf(train, max_features=max_features)
    got = {r["term"]: r["idf"] for r in tf.vocabulary.collect()}
    assert set(got) == set(vocab)
    for w, v in zip(vocab, idf):
        assert got[w] == pytest.approx(v, abs=1e-12)
    nb = fit_naive_bayes(tf, train)
    lp = {(r["label"], r["term"]): r["log_prob"] for r in nb.log_probs_long().collect()}
    for c in (0, 1):
        for i, w in enumerate(vocab):
            assert lp[(c, w)] == pytest.approx(logp[c, i], abs=1e-12)
    out = {r["msg_id"]: r for r in nb.predict(test).collect()}
    for (mid, _, _), p, k in zip(TEST, p1, pred):
        assert out[mid]["p"] == pytest.approx(p, abs=1e-12)
        assert out[mid]["prediction"] == k


def test_tfidf_rows_have_unit_norm(spark):
    train = spark.createDataFrame(DOCS, "msg_id long, message string, label int")
    tf = fit_tfidf(train)
    norms = tf.transform_long(train, keep_empty=True).groupBy("msg_id").agg(
        F.sum(F.col("tfidf") * F.col("tfidf")).alias("s")).collect()
    for r in norms:
        assert r["s"] is None or r["s"] == pytest.approx(1.0)


def test_term_counts(spark):
    df = spark.createDataFrame([(1, "bb aa bb cc x"), (2, "")], "msg_id long, message string")
    got = sorted(map(tuple, term_counts(df).collect()))
    assert got == [(1, "aa", 1), (1, "bb", 2), (1, "cc", 1)]
    assert term_counts(df, outer=True).filter("msg_id = 2").count() == 1


def brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def test_auc_matches_brute_force_and_symmetry(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 1), round(rnd.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "msg_id long, label int, p double").withColumn("prediction", F.lit(0))
    auc = M.roc_auc(df).first()["auc"]
    assert auc == pytest.approx(brute_auc([r[1] for r in rows], [r[2] for r in rows]), abs=1e-12)
    flipped = M.roc_auc(df.withColumn("p", 1 - F.col("p"))).first()["auc"]
    assert flipped == pytest.approx(1 - auc, abs=1e-9)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0.3, 1), (2, 1, 0.8, 1)], "msg_id long, label int, p double, prediction int")
    assert M.roc_auc(df).first()["auc"] is None


def test_confusion_and_zero_division(spark):
    df = spark.createDataFrame([(1, 1, 0.1, 0), (2, 0, 0.2, 0), (3, 1, 0.3, 0)],
                               "msg_id long, label int, p double, prediction int")
    cells = {(r["label"], r["prediction"]): r["n"] for r in M.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 2, (1, 1): 0}
    prf = M.accuracy_prf(df).first()
    assert prf["precision"] == 0.0 and prf["f1"] == 0.0 and prf["accuracy"] == pytest.approx(1 / 3)


def test_roc_points_end_at_one(spark):
    df = spark.createDataFrame([(1, 1, 0.9, 1), (2, 0, 0.1, 0), (3, 1, 0.4, 0), (4, 0, 0.4, 0)],
                               "msg_id long, label int, p double, prediction int")
    pts = sorted((r["fpr"], r["tpr"]) for r in M.roc_points(df).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    assert math.isclose(M.roc_auc(df).first()["auc"], brute_auc([1, 0, 1, 0], [0.9, 0.1, 0.4, 0.4]))
