"""Results that must not depend on how ordinary input happens to look: repeated ids,
several candidates, null labels, crowded scores, file layout, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from smishlens import session
from smishlens.operators import augment as G
from smishlens.operators import metrics as M
from smishlens.operators.urls import tokenise_urls
from smishlens.operators.vocabulary import text_preprocessor
from smishlens.sources import messages as SRC
from smishlens.sources import testdata as D
from smishlens.streaming import feeds as ST


def test_rows_that_share_an_id_keep_their_own_url_flags(spark):
    threats = spark.createDataFrame([("http://bad", "MALWARE")], "url string, threat_type string")
    rows = [(1, "see http://bad"), (1, "see http://good"), (1, "see http://bad"), (None, "www.x http://bad"), (2, "plain")]
    out = tokenise_urls(spark.createDataFrame(rows, "msg_id long, message string"), threats).collect()
    assert sorted(r["message"] for r in out) == sorted(
        ["see  URL_SUSPICIOUS ", "see  URL_TRUSTED ", "see  URL_SUSPICIOUS ", " URL_TRUSTED   URL_SUSPICIOUS ", "plain"])


def test_rows_that_share_an_id_keep_their_own_tokens(spark):
    stems = spark.createDataFrame([("going", "go")], "word string, stem string")
    rows = [(1, "going home", 0), (1, "not going", 1), (1, "going home", 0), (2, "", 1), (None, "x going", 0)]
    out = text_preprocessor(spark.createDataFrame(rows, "msg_id long, message string, label int"), stems=stems).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [
        (1, 0, "go home"), (1, 1, "not go"), (1, 0, "go home"), (2, 1, ""), (None, 0, "x go")]))


def test_attempts_take_ranked_candidates(spark):
    tr = spark.createDataFrame(
        [("es", "en", "hola", "hello"), ("es", "en", "hola", "hi"), ("en", "es", "hello", "a"), ("en", "es", "hi", "b"),
         ("en", "es", "yes", "c"), ("en", "es", "yes", "d"), ("en", "es", "yes", "e"), ("en", "es", "yes", "c")],
        "src_lang string, tgt_lang string, text_in string, text_out string")
    es = spark.createDataFrame([(1, "hola", "ham"), (2, None, "ham")], "msg_id long, message string, label string")
    en = spark.createDataFrame([(3, "yes", "ham")], "msg_id long, message string, label string")

    def texts(df):
        return sorted(r["message"] for r in df.collect())

    assert texts(G.back_translate(es, tr, 1)) == ["a"]
    assert texts(G.back_translate(es, tr, 2)) == ["a", "b"]
    assert texts(G.back_translate(es, tr, 3)) == ["a", "a", "b"]
    assert texts(G.translate_distinct(en, tr, 1)) == ["c"]
    assert texts(G.translate_distinct(en, tr, 5)) == ["c", "d", "e"]
    renamed = G.augment(es.withColumnRenamed("message", "text"), en, tr)["union"]
    assert renamed.count() == 4


def test_null_labels_are_left_out_of_every_metric(spark):
    rows = [(1, 1, 0.9), (0, 0, 0.1), (None, 1, 0.95)]
    preds = spark.createDataFrame(rows, "label int, prediction int, p double")
    assert M.accuracy_prf(preds).first()["n"] == 2
    assert M.roc_auc(preds).first()["auc"] == 1.0
    assert M.roc_points(preds).count() == 3


@pytest.fixture(scope="module")
def crowded(spark):
    """Scores that crowd at one end, beyond 0..1 too, with ties, for two models."""
    rows = [(m, i % 3 // 2, 0, (1e-9 * (i // 2 + 1) if i % 5 else 3.0 + i % 4) * (1 if m == "a" else -1))
            for m in "ab" for i in range(600)]
    return spark.createDataFrame(rows, "model string, label int, prediction int, p double")


def brute_points(rows):
    out = [(None, 0.0, 0.0)]
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    for t in sorted({p for _, p in rows}, reverse=True):
        out.append((t, sum(1 - y for y, p in rows if p >= t) / neg, sum(y for y, p in rows if p >= t) / pos))
    return out


def test_auc_and_curve_with_crowded_scores(spark, crowded):
    auc = {r["model"]: r["auc"] for r in M.roc_auc(crowded, ["model"]).collect()}
    points = M.roc_points(crowded, ["model"]).collect()
    for m in "ab":
        rows = [(r["label"], r["p"]) for r in crowded.filter(F.col("model") == m).collect()]
        pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
        assert auc[m] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)))
        got = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in points if r["model"] == m), key=str)
        want = sorted(brute_points(rows), key=str)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1:] for g in got] == [pytest.approx(w[1:]) for w in want]


def test_collinear_points_are_dropped_across_parts(spark, crowded):
    kept = M.roc_points(crowded, ["model"], drop_intermediate=True).collect()
    for m in "ab":
        rows = [(r["label"], r["p"]) for r in crowded.filter(F.col("model") == m).collect()]
        points = brute_points(rows)
        want = [p for k, p in enumerate(points) if k in (0, len(points) - 1) or
                (p[2] - points[k - 1][2]) * (points[k + 1][1] - p[1]) != (points[k + 1][2] - p[2]) * (p[1] - points[k - 1][1])]
        assert sorted(str(r["threshold"]) for r in kept if r["model"] == m) == sorted(str(p[0]) for p in want)


def test_csv_ids_do_not_depend_on_the_reading(spark, tmp_path):
    text = "label,message\nspam,one\nham,two\nspam,one\n"
    ids = []
    for k in range(2):
        folder = tmp_path / str(k)
        folder.mkdir()
        (folder / "m.csv").write_text(text)
        rows = SRC.read_messages(spark, str(folder)).repartition(1 + 2 * k).collect()
        ids.append(sorted((r["msg_id"], r["message"]) for r in rows))
    assert ids[0] == ids[1] and len({i for i, _ in ids[0]}) == 3


def test_split_is_written_by_source(spark, tmp_path):
    df = spark.createDataFrame([("en", 1, "train"), ("fr", 2, "test")], "source string, msg_id long, split string")
    SRC.save_split(df, str(tmp_path / "out"))
    assert os.path.isdir(tmp_path / "out" / "source=fr" / "split=test")
    assert SRC.read_csv_plain(spark, str(tmp_path / "out" / "source=en")).count() == 1


def test_each_id_is_kept_once_however_the_files_arrive(spark, tmp_path):
    folder = str(tmp_path / "in")
    for k in range(7):
        spark.createDataFrame([(1, "same text"), (10 + k, f"text {k}")], "doc_id long, text string") \
            .withColumn("lang", F.lit("en")).coalesce(1).write.mode("append").parquet(folder)
    results = []
    for name, per_batch in (("all", None), ("one", 1)):
        stream = D.message_stream(spark, folder, per_batch)
        out = ST.run_to_table(stream.dropDuplicates(["msg_id"]), spark, name, path=str(tmp_path / name))
        results.append(sorted((r["msg_id"], r["message"]) for r in out.collect()))
    assert results[0] == results[1] and len(results[0]) == 8


def test_a_run_resumes_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "run")

    def add(*rows):
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).coalesce(1) \
            .write.mode("append").parquet(folder)

    def run(fail=False):
        def batch(df):
            if fail:
                df.count()
                raise RuntimeError("stopped")
            return df
        return ST.run_to_table(D.message_stream(spark, folder).dropDuplicates(["msg_id"]), spark, "r", batch, state)

    add((1, "a"), (2, "b"))
    run()
    add((2, "b"), (3, "c"))
    with pytest.raises(Exception):
        run(fail=True)
    assert sorted(r["msg_id"] for r in run().collect()) == [1, 2, 3]
    assert sorted(r["msg_id"] for r in run().collect()) == [1, 2, 3]


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
