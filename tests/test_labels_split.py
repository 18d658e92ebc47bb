import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF001
from smishlens.functions.labels import map_label_df
from smishlens.operators.split import random_split, stratified_split
from smishlens.sources import testdata as D


def test_label_modes(spark):
    df = spark.createDataFrame([(" SPAM ",), ("Ham",), ("1",), ("0",), ("\t1 ",)], "label string")
    assert [r[0] for r in map_label_df(df, "label", "strict").collect()] == [1, 0, 1, 0, 1]
    bad = spark.createDataFrame([("2",), ("maybe",)], "label string")
    assert [r[0] for r in map_label_df(bad, "label", "lenient").collect()] == [None, None]
    with pytest.raises(Exception):
        map_label_df(bad, "label", "strict").collect()


def test_numeric_labels_truncate(spark):
    df = spark.createDataFrame([(0.5,), (1.9,), (0.0,)], "label double")
    assert [r[0] for r in map_label_df(df, "label", "numeric").collect()] == [0, 1, 0]
    with pytest.raises(Exception):
        map_label_df(spark.createDataFrame([(2.0,)], "label double"), "label", "numeric").collect()


def _sizes(df):
    rows = df.groupBy("split", "label").count().collect()
    return {(r["split"], r["label"]): r["count"] for r in rows}


def test_split_sizes_match_fixture(spark):
    msgs = D.messages(spark, SF001).select("msg_id", "label")
    s = _sizes(stratified_split(msgs, "label", 0.3, 42))
    assert s == {("train", "ham"): 243, ("train", "spam"): 36, ("test", "ham"): 105, ("test", "spam"): 15}
    s = _sizes(stratified_split(msgs, "label", 0.2, 42))
    assert s == {("train", "ham"): 278, ("train", "spam"): 41, ("test", "ham"): 70, ("test", "spam"): 10}


def test_split_complete_disjoint_and_partition_free(spark):
    msgs = D.messages(spark, SF001).select("msg_id", "label")
    a = stratified_split(msgs.repartition(3), "label", 0.3, 42, bucket_digits=1)
    b = stratified_split(msgs.repartition(11), "label", 0.3, 42, bucket_digits=4)
    ra = sorted(map(tuple, a.select("msg_id", "split").collect()))
    rb = sorted(map(tuple, b.select("msg_id", "split").collect()))
    assert ra == rb
    assert len(ra) == msgs.count() == len({r[0] for r in ra})


def test_split_rejects_singleton_class(spark):
    df = spark.createDataFrame([(i, "a") for i in range(10)] + [(99, "b")], "msg_id long, label string")
    with pytest.raises(Exception):
        stratified_split(df, "label", 0.3, 42).collect()


def test_random_split_size(spark):
    df = spark.range(1000).withColumnRenamed("id", "msg_id")
    out = random_split(df, 0.1, 42)
    assert out.filter(F.col("split") == "test").count() == 100
