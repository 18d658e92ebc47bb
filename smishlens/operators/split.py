"""Seeded train/test splits (inventory D1-D3).

Sizes follow the stratified shuffle split rule: ``n_test = ceil(test_size * n)``,
``n_train = n - n_test``; per class the train quota is the floor of
``n_train * n_c / n`` plus one for the largest remainders (ties: lower label),
the test quota is the rest. Membership: within each class, rows are ordered
by ``md5('<seed>:<id>')`` (then id) and the first quota rows go to test.

At scale the per-class order is never materialised by one task. Rows are
bucketed by the first hex digits of the md5 key; bucket counts (a tiny table)
give, per class, the bucket in which the test quota ends, and only that
boundary bucket (about ``n / 16**digits`` rows) is ranked by a window to find
the last test row. The result is a cut table with one row per class; the
split itself is then one join with that table and a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_key(id_col: str, seed: int):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def class_quotas(counts: DataFrame, test_size: float, groups: list[str], label_col: str) -> DataFrame:
    """``(groups, label, n_c, n_test_c)`` from per-class counts ``(groups, label, n_c)``."""
    g = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    n = F.sum("n_c").over(g)
    n_classes = F.count(F.lit(1)).over(g)
    q = (counts
         .withColumn("_n", n)
         .withColumn("_k", n_classes)
         .withColumn("_n_test", F.ceil(F.lit(float(test_size)) * F.col("_n")).cast("bigint"))
         .withColumn("_n_train", F.col("_n") - F.col("_n_test"))
         .withColumn("_cont", (F.col("_n_train") * F.col("n_c")) / F.col("_n"))
         .withColumn("_floor", F.floor("_cont").cast("bigint"))
         .withColumn("_rem", F.col("_cont") - F.col("_floor")))
    rank_w = g.orderBy(F.col("_rem").desc(), F.col(label_col).asc())
    q = (q.withColumn("_need", F.col("_n_train") - F.sum("_floor").over(g))
         .withColumn("_rk", F.row_number().over(rank_w))
         .withColumn("_train_c", F.col("_floor") + F.when(F.col("_rk") <= F.col("_need"), 1).otherwise(0)))
    checked = (F.when(F.col("n_c") < 2, F.raise_error(F.lit("a class has fewer than 2 members")))
               .when(F.col("_n_test") < F.col("_k"),
                     F.raise_error(F.lit("test size is smaller than the number of classes")))
               .when(F.col("_n_train") < F.col("_k"),
                     F.raise_error(F.lit("train size is smaller than the number of classes")))
               .otherwise(F.col("n_c") - F.col("_train_c")))
    return q.select(*groups, label_col, "n_c", checked.cast("bigint").alias("n_test_c"))


def split_cuts(df: DataFrame, label_col: str = "label", test_size: float = 0.2, seed: int = 42,
               id_col: str = "msg_id", groups: list[str] | None = None, bucket_digits: int = 4) -> DataFrame:
    """Per class: the bucket where the test quota ends and the last test row's
    ``(key, id)`` there. One row per class (a tiny table)."""
    groups = list(groups or [])
    strata = groups + [label_col]
    keyed = (df.select(*strata, id_col)
             .withColumn("_key", order_key(id_col, seed))
             .withColumn("_bucket", F.substring("_key", 1, bucket_digits)))
    buckets = keyed.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    counts = buckets.groupBy(*strata).agg(F.sum("_cnt").alias("n_c"))
    quotas = class_quotas(counts, test_size, groups, label_col)
    per_class = Window.partitionBy(*strata).orderBy("_bucket")
    cum = (buckets.withColumn("_before", F.coalesce(
        F.sum("_cnt").over(per_class.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(quotas.select(*strata, "n_test_c"), strata))
    # The bucket where the quota ends: before < quota <= before + cnt.
    boundary = (cum.filter((F.col("_before") < F.col("n_test_c"))
                           & (F.col("n_test_c") <= F.col("_before") + F.col("_cnt")))
                .select(*strata, F.col("_bucket").alias("_bb"),
                        (F.col("n_test_c") - F.col("_before")).alias("_need")))
    # One row per group and class. AQE broadcasts it when it is small at run time.
    # Only rows of the boundary bucket (about n / 16**digits) are ranked.
    edge = (keyed.join(boundary, strata)
            .filter(F.col("_bucket") == F.col("_bb"))
            .withColumn("_rn", F.row_number().over(Window.partitionBy(*strata).orderBy("_key", id_col)))
            .filter(F.col("_rn") == F.col("_need"))
            .select(*strata, "_bb", F.col("_key").alias("_key_cut"), F.col(id_col).alias("_id_cut")))
    return edge


def assign_split(df: DataFrame, cuts: DataFrame, label_col: str = "label", seed: int = 42,
                 id_col: str = "msg_id", groups: list[str] | None = None, bucket_digits: int = 4,
                 split_col: str = "split") -> DataFrame:
    """Narrow pass: a row is test when its ``(bucket, key, id)`` comes no later
    than its class's cut. Classes without a cut (quota 0) are all train."""
    strata = list(groups or []) + [label_col]
    key = order_key(id_col, seed)
    bucket = F.substring(key, 1, bucket_digits)
    marked = df.join(cuts, strata, "left")
    is_test = ((bucket < F.col("_bb"))
               | ((bucket == F.col("_bb")) & ((key < F.col("_key_cut"))
                                              | ((key == F.col("_key_cut")) & (F.col(id_col) <= F.col("_id_cut"))))))
    return (marked.withColumn(split_col, F.when(F.coalesce(is_test, F.lit(False)), F.lit("test"))
                              .otherwise(F.lit("train")))
            .drop("_bb", "_key_cut", "_id_cut"))


def stratified_split(df: DataFrame, label_col: str = "label", test_size: float = 0.2, seed: int = 42,
                     id_col: str = "msg_id", groups: list[str] | None = None,
                     bucket_digits: int = 4, split_col: str = "split") -> DataFrame:
    """D1 (and D3 with ``groups``): add ``split`` = 'train' | 'test'.

    For reuse, materialise ``df`` first (the cuts read it once more)."""
    cuts = split_cuts(df, label_col, test_size, seed, id_col, groups, bucket_digits)
    return assign_split(df, cuts, label_col, seed, id_col, groups, bucket_digits, split_col)


def random_split(df: DataFrame, test_size: float = 0.1, seed: int = 42, id_col: str = "msg_id",
                 split_col: str = "split") -> DataFrame:
    """Unstratified seeded split (the same rule with one class)."""
    tagged = df.withColumn("_one", F.lit(1))
    out = stratified_split(tagged, "_one", test_size, seed, id_col, split_col=split_col)
    return out.drop("_one")
