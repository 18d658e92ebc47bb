"""Lookups of Zipf-distributed keys in tables of any size (inventory E1, E2).

A table of up to ``BROADCAST_ROWS`` rows, which is counted first, is broadcast. Beyond that the
join is split: the keys that hold at least one in ``HEAVY`` of all rows, so ``HEAVY`` keys at
most, are found by a mergeable counter; their table rows, as few, are broadcast; only
rows with other keys shuffle, and none of those is hot.

Where only matches are wanted (:func:`matches`), the keys are counted, and as many frequent ones as may
be broadcast never shuffle: words are many, but few of the rows hold a rare one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smishlens.session import shared_table

BROADCAST_ROWS = 200_000
HEAVY = 1000
#: Keys that the counter follows; it misses none that holds one in HEAVY while this is some times as many.
TRACKED = 10 * HEAVY


def heavy_keys(rows: DataFrame, key: str, heavy: int = HEAVY) -> list:
    """The keys with at least one in ``heavy`` of the rows (never more than ``heavy`` keys)."""
    top, n = rows.filter(F.col(key).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(key), F.lit(heavy), F.lit(max(TRACKED, heavy))), F.count("*")).first()
    return [r["item"] for r in top or [] if r["count"] * heavy >= n]


def lookup_join(rows: DataFrame, table: DataFrame, key: str, table_key: str, broadcast_rows: int = BROADCAST_ROWS,
                heavy: int = HEAVY) -> DataFrame:
    """``rows`` left-joined to ``table``, whose ``table_key`` is unique: the columns of both."""
    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table), F.col(key) == F.col(table_key), "left")
    hot = heavy_keys(rows, key, heavy)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = table.filter(F.col(table_key).isin(hot))
    common = rows.filter(is_hot).join(F.broadcast(few), F.col(key) == F.col(table_key), "left")
    rest = rows.filter(~is_hot & F.col(key).isNotNull()).join(table, F.col(key) == F.col(table_key), "left")
    # rows without a key match nothing and stay where they are
    none = rows.filter(F.col(key).isNull())
    return common.unionByName(rest).unionByName(none, allowMissingColumns=True)


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The keys of ``counts`` (key, n) with the highest counts, ``most`` at most: all above a power of two."""
    sizes = counts.groupBy(F.length(F.bin("n")).alias("digits")).count().collect()  # 64 rows at most
    total, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["digits"]):
        total += r["count"]
        if total > most:
            break
        least = 1 << (r["digits"] - 1)
    return counts.filter(F.col("n") >= least) if least else counts.limit(0)


def matches(rows: DataFrame, table: DataFrame, key: str, table_key: str, counts: DataFrame | None = None,
            broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined to ``table``, whose ``table_key`` is unique: the columns of both, of the rows that match.

    ``counts`` (key, n): the rows of each key, where they have been counted. Beyond ``broadcast_rows`` only rows whose
    key is not frequent shuffle; the hint keeps Spark from a broadcast of them, as it takes exploded rows to be few."""
    same = F.col(key) == F.col(table_key)
    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table), same)
    if counts is None:
        counts = shared_table(rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), "key_counts")
    known = shared_table(frequent(counts, broadcast_rows).select(key), "frequent_keys")
    common = rows.join(F.broadcast(table.join(F.broadcast(known), same, "left_semi")), same)
    rest = rows.join(F.broadcast(known), key, "left_anti").filter(F.col(key).isNotNull())
    return common.unionByName(rest.join(table.hint("merge"), same))
