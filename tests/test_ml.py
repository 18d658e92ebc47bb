import os
import tempfile

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from smishlens.plans import ml as ML
from smishlens.plans import solver_checks as CK


def _data(spark):
    rows = [(i, float(i % 2), Vectors.dense([1.0 if i % 2 else 0.0, (i % 7) / 7.0])) for i in range(60)]
    # one partition: an iteration of a solver is one small task
    return spark.createDataFrame(rows, ["msg_id", "label", "features"]).coalesce(1)


def test_registry_and_platt(spark):
    df = _data(spark)
    lr = ML.estimator("logistic_regression", 60).fit(df)
    acc = lr.transform(df).select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc == 1.0
    svm = ML.estimator("svm", 60).fit(df)
    out = ML.scores(svm, df).collect()
    assert all(0.0 <= r["p"] <= 1.0 for r in out)
    assert sum(r["prediction"] == r["label"] for r in out) == len(out)
    with pytest.raises(ValueError):
        ML.estimator("unknown", 1)


def test_soft_vote(spark):
    df = spark.createDataFrame([("a", 1, 1, 0.9), ("b", 1, 1, 0.2), ("a", 2, 0, 0.4), ("b", 2, 0, 0.5)],
                               "model string, msg_id long, label int, p double")
    out = {r["msg_id"]: (r["p"], r["prediction"]) for r in ML.soft_vote(df).collect()}
    assert out[1][1] == 1 and out[2] == (pytest.approx(0.45), 0)


def test_pipeline_persistence(spark):
    msgs = spark.createDataFrame([(i, ("win free prize now" if i % 2 else "see you at lunch") + f" n{i}", float(i % 2))
                                  for i in range(40)], "msg_id long, message string, label double")
    d = tempfile.mkdtemp(prefix="smishlens-model-")
    ML.refit_production(spark, msgs, d, "english", "naive_bayes", threshold=0.429)
    model, meta = ML.load_model(spark, os.path.join(d, "pipeline_english"))
    assert meta["threshold"] == 0.429
    assert model.transform(msgs).filter("prediction = label").count() == 40
    assert any(p.startswith("naive_bayes_prod_") for p in os.listdir(os.path.join(d, "english", "production")))
    with pytest.raises(FileNotFoundError):
        ML.load_model(spark, os.path.join(d, "missing"))


def test_evaluate_saved_pipeline(spark):
    rows = [(i, ("win free prize now" if i % 3 == 0 else "see you at lunch") + f" n{i}", float(i % 3 == 0))
            for i in range(45)]
    msgs = spark.createDataFrame(rows, "msg_id long, message string, label double")
    d = tempfile.mkdtemp(prefix="smishlens-eval-")
    ML.save_model(spark, ML.text_pipeline("naive_bayes", 45).fit(msgs), d, {"model_key": "naive_bayes"})
    ev = ML.evaluate(spark, msgs, d)
    assert ev.meta == {"model_key": "naive_bayes"}
    assert sum(r["n"] for r in ev.confusion.collect()) == 45
    preds = ev.predictions.collect()
    pos = [r["p"] for r in preds if r["label"] == 1]
    neg = [r["p"] for r in preds if r["label"] == 0]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert ev.auc.first()["auc"] == pytest.approx(brute)
    report = {r["class"]: r for r in ev.report.collect()}
    assert report["1"]["support"] == 15 and report["0"]["support"] == 30
    with pytest.raises(FileNotFoundError):
        ML.evaluate(spark, msgs, os.path.join(d, "missing"))


def test_stage_defaults(spark):
    msgs = spark.createDataFrame([(1, "win a prize now"), (2, "see you at lunch")], "msg_id long, message string")
    clean = ML.TextPreprocessor().transform(msgs)
    out = ML.TopTermsTfidf().fit(clean).transform(clean)
    assert "features" in out.columns and out.count() == 2


def _texts(spark, n=48):
    rows = [(i, ("win free prize now" if i % 3 == 0 else "see you at lunch") + f" n{i % 7}", float(i % 3 == 0))
            for i in range(n)]
    return spark.createDataFrame(rows, "msg_id long, message string, label double").coalesce(1)


def test_naive_bayes_prior_is_unsmoothed(spark):
    rows = [(i, float(i % 4 == 0), Vectors.dense([float(i % 3), 1.0])) for i in range(8)]
    df = spark.createDataFrame(rows, ["msg_id", "label", "features"])
    model = ML.estimator("naive_bayes", 8).fit(df)
    counts = np.array([[sum(r[2][j] for r in rows if r[1] == c) for j in range(2)] for c in (0, 1)])
    logp = np.log((counts + 1) / (counts.sum(axis=1, keepdims=True) + 2))
    for r in model.transform(df).collect():
        jll = np.log([6 / 8, 2 / 8]) + logp @ r["features"].toArray()
        assert r["raw"].toArray() == pytest.approx(jll)
        assert r["probability"].toArray() == pytest.approx(np.exp(jll - np.logaddexp(*jll)))
        assert r["prediction"] == float(jll.argmax())


@pytest.mark.parametrize("name", ["svm", "ensemble"])
def test_svm_and_ensemble_save_load_and_score(spark, name, tmp_path):
    msgs = _texts(spark)
    ML.refit_production(spark, msgs, str(tmp_path), "english", name, max_depth=5)
    model, meta = ML.load_model(spark, str(tmp_path / "pipeline_english"))
    out = ML.scores(model, msgs).collect()
    assert meta["model_key"] == name
    assert sum(r["label"] == r["prediction"] for r in out) == len(out)
    assert all(0 <= r["p"] <= 1 for r in out)


def test_compare_saves_the_best_and_refit_uses_it(spark, tmp_path):
    msgs = _texts(spark)
    models = ("logistic_regression", "naive_bayes")
    done = ML.compare_and_save(spark, msgs.filter("msg_id % 4 > 0"), msgs.filter("msg_id % 4 = 0"), str(tmp_path),
                               models=models, use_stem=True)
    assert done.best == "logistic_regression"  # equal accuracy: the first wins
    ML.refit_production(spark, msgs, str(tmp_path), "english", threshold=0.3)
    _, meta = ML.load_model(spark, str(tmp_path / "pipeline_english"))
    assert (meta["model_key"], meta["threshold"], meta["use_stem"]) == ("logistic_regression", 0.3, True)
    ev = ML.evaluate(spark, msgs, str(tmp_path / "pipeline_english"), threshold=0.0)
    assert {r["prediction"] for r in ev.predictions.collect()} == {1}


def test_damaged_artefact_is_not_reported_as_missing(spark, tmp_path):
    ML.save_model(spark, ML.text_pipeline("naive_bayes", 48).fit(_texts(spark)), str(tmp_path / "m"), {})
    (tmp_path / "m" / "meta" / next(f for f in os.listdir(tmp_path / "m" / "meta") if f.startswith("part"))).write_text("{")
    with pytest.raises(Exception) as caught:
        ML.load_model(spark, str(tmp_path / "m"))
    assert not isinstance(caught.value, FileNotFoundError)


def test_solver_checks_notice_a_worse_model(spark):
    df = _data(spark)
    model = ML.estimator("logistic_regression", 60).fit(df)
    assert CK.logistic_gradient(model, df, 60) <= CK.LR_GRADIENT
    rough = ML.LogisticRegression(maxIter=1, regParam=1 / 60, standardization=False, probabilityCol="probability").fit(df)
    assert CK.logistic_gradient(rough, df, 60) > CK.LR_GRADIENT
    svm = ML.estimator("svm", 60).fit(df).stages[0]
    assert CK.hinge_excess(svm, df, 60) <= CK.SVM_EXCESS
    rough = ML.LinearSVC(maxIter=1, regParam=1 / 60, standardization=False, rawPredictionCol="raw").fit(df)
    assert CK.hinge_excess(rough, df, 60) > CK.SVM_EXCESS


def test_svm_warns_at_its_iteration_limit(spark):
    with pytest.warns(UserWarning, match="limit of 1 iterations"):
        ML.PlattSvm(maxIter=1, folds=2).fit(_data(spark))


def test_listed_urls_through_a_saved_pipeline(spark, tmp_path):
    path = str(tmp_path / "threats")
    spark.createDataFrame([("http://phish.link", "MALWARE")], "url string, threat_type string").write.parquet(path)
    msgs = spark.createDataFrame([(i, "Click http://phish.link" if i % 2 else "Consulte http://mistracking.es/123",
                                   float(i % 2)) for i in range(8)], "msg_id long, message string, label double")
    ML.save_model(spark, ML.text_pipeline("naive_bayes", 8, threats_path=path).fit(msgs), str(tmp_path / "m"), {})
    model, _ = ML.load_model(spark, str(tmp_path / "m"))
    out = {r["msg_id"]: r["clean"] for r in model.transform(msgs).collect()}
    assert len(out) == 8 and out[1] == "click url_suspicious" and out[0] == "consulte url_trusted"
