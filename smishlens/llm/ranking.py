"""Ranks within groups of any size, without a task that holds a whole group.

The rows of a group are dealt over sub-buckets by the high bits of their order
key (a hash, so they are even). Counts per (group, sub-bucket) are summed up on a
small table, and a row's rank is the number of rows in earlier sub-buckets plus
its place in its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a sub-bucket of the largest group has, about; most sub-buckets.
SUB_ROWS = 512
MAX_SUB = 1 << 14


def with_rank(rows: DataFrame, groups: list[str], order: str, ties: list[str], largest: int,
              name: str = "rank") -> DataFrame:
    """``rows`` with a 0-based long ``name``: the rank within ``groups`` by the hash
    column ``order`` (long), then ``ties``. ``largest``: rows of the largest group."""
    subs = 1
    while subs < MAX_SUB and subs * SUB_ROWS < largest:
        subs *= 2
    sub = F.shiftrightunsigned(F.col(order), 64 - subs.bit_length() + 1) if subs > 1 else F.lit(0).cast("long")
    dealt = rows.withColumn("__sub", sub)
    counts = dealt.groupBy(*groups, "__sub").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))) \
        .select(*[F.col(g).alias(f"__of_{g}") for g in groups], F.col("__sub").alias("__of_sub"), "__before")
    place = F.row_number().over(Window.partitionBy(*groups, "__sub").orderBy(order, *ties)) - 1
    placed = dealt.withColumn("__place", place.cast("long"))
    same = [F.col(g) == F.col(f"__of_{g}") for g in groups] + [F.col("__sub") == F.col("__of_sub")]
    joined = placed.join(counts, on=same, how="inner")
    return joined.withColumn(name, F.col("__before") + F.col("__place")) \
        .drop("__sub", "__place", "__before", "__of_sub", *[f"__of_{g}" for g in groups])
