"""Steps that several queries share: a text is cleaned, hashed and fitted on once, whatever reads the result."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.operators.vocabulary import explode_tokens, normalise_texts, regroup_tokens
from smishlens.plans import ml as ML
from smishlens.plans.catalog import QUERIES


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_text_is_hashed_once_and_not_once_per_token(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, None)], "msg_id long, message string").write.parquet(f"{tmp_path}/m")
    tokens = explode_tokens(spark.read.parquet(f"{tmp_path}/m"))
    assert plan(tokens).index("Generate") < plan(tokens).index("xxhash64")


def test_equal_rows_come_back_as_often_as_they_were(spark):
    rows = [(1, "c b a"), (1, "c b a"), (1, "c b a"), (1, "x"), (2, ""), (2, ""), (3, None), (None, "p q"), (None, "p q")]
    tokens = explode_tokens(spark.createDataFrame(rows, "msg_id long, message string"))
    got = [tuple(r) for r in regroup_tokens(tokens.repartition(7)).collect()]
    assert sorted(got, key=str) == sorted([(i, t or "") for i, t in rows], key=str)
    assert "collect_set" not in plan(regroup_tokens(tokens))


def test_replacements_run_only_where_a_character_needs_them(spark):
    def folded(table, *texts):
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
        return [r[0] for r in df.orderBy("k").select(T.fold_accents(F.col("t"), table)).collect()]

    # a character that becomes one with a longer replacement, a dropped one, and signs of a pattern
    assert folded({"é": "ß", "ß": "ss", "¤": "", "à": "a"}, "éà", "ß", "¤x", "àà", "a]^-é") == ["ssa", "ss", "x", "aa", "a]^-ss"]
    assert folded({"à": "a"}, "àb", None) == ["ab", None]
    assert "rlike" in plan(spark.range(1).select(F.col("id").cast("string").alias("t")).select(
        T._fold(F.col("t"), {"ß": "ss"}, {}))).split("replace(translate")[0].lower()


def test_ends_are_trimmed_and_blanks_found_without_a_replacement(spark):
    texts = ["", " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ", "\x1f ?a  b! \x1c", "\n\n", "_", "...", None, "Ä \r\n"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k")
    assert [r[0] for r in df.select(T.clean_after_urls(F.col("t"))).collect()] == ["", "", "a  b", "", "_", "", None, "a"]
    assert [r[0] for r in df.select(T.is_blank(F.col("t"))).collect()] == [True, True, False, True, False, False, None, False]
    assert "regexp_replace" not in plan(df.select(T.is_blank(F.col("t"))))


@pytest.mark.parametrize("name", ["lemma_lookup", "stem_lookup"])
def test_the_lookup_reads_cleaned_messages(spark, tmp_path, name):
    spark.createDataFrame([(1, "Jumping dogs, walked!", "en"), (2, "gatos", "es"), (2, "gatos", "es")], "doc_id long, text string, lang string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "http://a.b/fr/1")], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    out = QUERIES[name](spark, str(tmp_path))
    want = ["jumping dog walked", "gato", "gato"] if name == "lemma_lookup" else ["jump dogs walk", "gatos", "gatos"]
    assert sorted(r["message"] for r in out.collect()) == sorted(want)
    assert "translate(" not in plan(out)


def test_distinct_texts_are_made_once(spark):
    df = spark.range(40).select(F.concat(F.lit("running "), F.upper(F.hex("id"))).alias("t"))
    out = normalise_texts(df.withColumn("t", F.lower("t")), "t", stem=True)
    assert "lower(" not in plan(out)
    assert out.filter("t like 'run %'").count() == 40


def test_an_ensemble_beside_its_members_is_made_of_them(spark, monkeypatch):
    rows = [(i, float(i % 2), Vectors.dense([1.0 if i % 2 else 0.0, (i % 7) / 7.0])) for i in range(60)]
    df = spark.createDataFrame(rows, ["msg_id", "label", "features"]).coalesce(1).cache()
    asked, fit_all = [], ML.fit_all
    monkeypatch.setattr(ML, "fit_all", lambda pairs: asked.extend(type(e).__name__ for e, _ in pairs) or fit_all(pairs))
    fitted = ML.fit_models(df, 60, (*ML.MODEL_ORDER, ML.ENSEMBLE), max_depth=2)
    assert list(fitted) == [*ML.MODEL_ORDER, ML.ENSEMBLE]
    assert asked.count("RandomForestClassifier") == 1 and asked.count("LinearSVC") <= 1 + ML.PLATT_FOLDS
    preds = ML.ml_predictions(fitted, df).toPandas()
    wide = preds.pivot(index="msg_id", columns="model", values="p")
    assert (wide[ML.ENSEMBLE] - wide[list(ML.MODEL_ORDER)].mean(axis=1)).abs().max() < 1e-9
    assert ML.SoftVote(nTrain=60, maxDepth=2)._fit(df).transform(df).count() == 60
