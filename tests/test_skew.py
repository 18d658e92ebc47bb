"""Lookups of skewed keys: the same rows whatever is broadcast, and no hot key in the shuffle."""

import pytest
from pyspark.sql import functions as F

from smishlens.operators import skew
from smishlens.operators.vocabulary import text_preprocessor


def skewed(spark):
    """A third of all rows have one key, a tenth another, some none."""
    k = F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 10 == 1, "of").when(F.col("id") % 50 == 2, None) \
        .otherwise(F.concat(F.lit("w"), (F.col("id") % 2003).cast("string")))
    return spark.range(30_000).select("id", k.alias("tok"))


@pytest.mark.parametrize("broadcast_rows,heavy", [(10**6, 1000), (0, 1000), (0, 20), (100, 5)])
def test_the_same_rows_whatever_is_broadcast(spark, broadcast_rows, heavy):
    rows = skewed(spark)
    table = rows.filter("tok is not null and tok != 'of'").select(F.col("tok").alias("_w")).distinct().withColumn("_v", F.upper("_w"))
    got = skew.lookup_join(rows, table, "tok", "_w", broadcast_rows, heavy).select("id", "tok", "_v")
    want = rows.join(table, rows["tok"] == table["_w"], "left").select("id", "tok", "_v")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert skew.lookup_join(rows.limit(0), table, "tok", "_w", broadcast_rows, heavy).count() == 0
    assert skew.lookup_join(rows, table.limit(0), "tok", "_w", broadcast_rows, heavy).count() == 30_000


def test_frequent_keys_do_not_shuffle(spark):
    rows = skewed(spark)
    hot = skew.heavy_keys(rows, "tok")
    assert {"the", "of"} <= set(hot) and len(hot) <= skew.HEAVY
    assert set(skew.heavy_keys(rows, "tok", 8)) == {"the", "of"} - ({"of"} if 30_000 * 2 / 3 / 10 < 30_000 / 8 else set())
    rest = rows.filter(F.col("tok").isNotNull() & ~F.col("tok").isin(hot)).repartition(8, "tok")
    sizes = sorted(r["count"] for r in rest.groupBy(F.spark_partition_id()).count().collect())
    assert not sizes or sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_lookups_of_a_large_table(spark, monkeypatch):
    df = spark.createDataFrame([(1, "the dogs ran the ran"), (1, "dogs"), (2, ""), (3, None), (4, "the the the")], "msg_id long, message string")
    lemmas = spark.createDataFrame([("dogs", "dog"), ("the", "a"), ("the", "a"), ("ran", "run")], "word string, lemma string")
    before = sorted(map(tuple, text_preprocessor(df, lemmas).collect()), key=str)
    monkeypatch.setattr(skew.lookup_join, "__defaults__", (0, 3))
    assert sorted(map(tuple, text_preprocessor(df, lemmas).collect()), key=str) == before
    assert (1, "a dog run a run") in before
