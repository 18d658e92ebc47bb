"""Lookups of words: the tokens of a message stay where the message is, and only what changes moves."""

import pytest
from pyspark.sql import functions as F

from smishlens.operators import skew, vocabulary as V
from smishlens.operators.tfidf import ROW

ROWS = [(1, "the  cats ran the cats"), (1, "the  cats ran the cats"), (1, "cats"), (2, ""), (3, None), (None, "oddly rare"),
        (4, " ".join(f"w{k}" for k in range(300)) + " cats")]
LEMMAS = [("cats", "cat"), ("ran", "run"), ("rare", "rares"), ("same", "same"), ("none", None), ("back", "forth")]
STEMS = [("cat", "c"), ("run", "ru"), ("oddly", "odd"), ("rares", "rare"), ("cats", "never"), ("forth", "back"), ("w7", "seven")]


def by_hand(text, *tables):
    out = []
    for tok in (text or "").split():
        for table in tables:
            tok = {w: v for w, v in table if v}.get(tok, tok)
        out.append(tok)
    return " ".join(out)


@pytest.mark.parametrize("bound", [10**6, 3, 0])
@pytest.mark.parametrize("names", ["lemma", "stem", "lemma stem"])
def test_lookups_are_those_by_hand(spark, monkeypatch, bound, names):
    monkeypatch.setattr(skew.matches, "__defaults__", (None, bound))
    tables = {n: t for n, t in (("lemma", LEMMAS), ("stem", STEMS)) if n in names.split()}
    frames = {f"{n}s" if n == "stem" else "lemmas": spark.createDataFrame(t, f"word string, {n} string") for n, t in tables.items()}
    df = spark.createDataFrame(ROWS, "msg_id long, message string").withColumn("label", F.lit(1)).repartition(3)
    got = [tuple(r) for r in V.text_preprocessor(df, **frames).select("msg_id", "label", "message").collect()]
    assert sorted(got, key=str) == sorted([(i, 1, by_hand(t, *tables.values())) for i, t in ROWS], key=str)


def test_frequent_keys_are_bounded(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 8), ("c", 7), ("d", 4), ("e", 3), ("f", 1)], "k string, n long")
    assert {tuple(r)[0] for r in skew.frequent(counts, 3).collect()} == {"a", "b"}
    assert {tuple(r)[0] for r in skew.frequent(counts, 4).collect()} == {"a", "b", "c", "d"}
    assert skew.frequent(counts, 1).count() == 0 and skew.frequent(counts, 6).count() == 6


def test_unchanged_tokens_do_not_shuffle(spark):
    """What is gathered per message are the tokens that change, and neither side of the join with the messages is broadcast."""
    df = V.numbered(spark.createDataFrame(ROWS, "msg_id long, message string"))
    table = V.changes(spark.createDataFrame(STEMS, "word string, stem string"), "stem")
    hits = skew.matches(V.row_tokens(df, "message"), table, "tok", "_w")
    assert hits.count() == sum(tok in dict(STEMS) for _, t in ROWS for tok in (t or "").split())
    plan = V.replace_words(df, table, "message")._jdf.queryExecution().sparkPlan().toString()
    assert any("SortMergeJoin" in line and ROW in line for line in plan.splitlines())


def test_normalised_texts_keep_null_and_row_order(spark):
    df = spark.createDataFrame([(1, "running dogs", "x"), (2, None, "y"), (2, "", "z"), (1, "running dogs", "x")], "k int, t string, o string")
    out = V.normalise_texts(df, "t", spark.createDataFrame([("dogs", "running")], "word string, lemma string"), stem=True)
    assert out.columns == ["k", "t", "o"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "run run", "x"), (2, None, "y"), (2, "", "z"), (1, "run run", "x")], key=str)
