"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are dealt into input blocks by a hash of their key, and the blocks are
counted. The matrix says how many rows each block sends to each shard: its
rows sum to the block sizes, its columns to the shard sizes (at most one apart),
and it is drawn from the law that a uniformly random shuffle would give it, one
multivariate hypergeometric row after the other. Then each block is permuted (an
order by a seeded hash), its first rows go to shard 0, the next to shard 1 and so
on as the matrix says, and every shard is permuted again by a second hash. Only
the block counts and the matrix reach the driver; their size is bounded by
``MAX_BLOCKS``.

Everything is a function of the rows and the seed, so a task that runs again
gives the same rows. A shard's second permutation is ranked in sub-buckets (see
:mod:`ranking`), so no task holds a whole shard.

Defined cases: null keys hash like any value; repeated rows are placed one by
one; an empty table gives an empty result; columns of the input are kept, an
existing ``shard`` or ``slot`` is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smishlens.llm.ranking import with_rank

#: Rows of a block, about, and the largest number of blocks.
BLOCK_ROWS = 4096
MAX_BLOCKS = 1 << 18
#: numpy's hypergeometric sampler takes populations under this size.
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken from good + bad are good, for populations of any size."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    # inversion outwards from the mode: about one standard deviation of steps
    left = rng.random()
    p = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    down, up, p_down, p_up = mode, mode, p, p
    left -= p
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(block_sizes: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Rows per (block, shard): row sums are ``block_sizes``, column sums at most one apart."""
    total = sum(block_sizes)
    left = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(block_sizes), n_shards), np.int64)
    for b, size in enumerate(block_sizes):
        later = sum(left)  # rows that the shards after this one still want
        for s in range(n_shards):
            later -= left[s]
            take = hypergeometric(rng, left[s], later, size) if later else size
            matrix[b, s] = take
            left[s] -= take
            size -= take
    return matrix


def uniform_shards(rows: DataFrame, n_shards: int, key: list[str], seed: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard)."""
    spark, columns = rows.sparkSession, [c for c in rows.columns if c not in ("shard", "slot")]
    total = rows.count()
    n_blocks = min(MAX_BLOCKS, max(1, -(-total // block_rows)))

    def mixed(salt: int):
        return F.xxhash64("__key", F.lit(seed * 3 + salt))

    # orders use the key's hash, so the passes that only count carry no text
    dealt = rows.select(*columns, F.xxhash64(*key).alias("__key"))
    dealt = dealt.select(*columns, "__key", F.pmod(mixed(0), F.lit(n_blocks)).cast("int").alias("__block"),
                         mixed(1).alias("__first"), mixed(2).alias("__second"))
    sizes = dict(dealt.groupBy("__block").count().collect())
    matrix = communication_matrix([sizes.get(b, 0) for b in range(n_blocks)], n_shards, seed)
    cuts = np.cumsum(matrix, axis=1)
    table = pa.table({"__of_block": pa.array(np.arange(n_blocks, dtype=np.int32)),
                      "__cuts": pa.array(list(cuts), pa.list_(pa.int64()))})
    place = F.row_number().over(Window.partitionBy("__block").orderBy("__first", "__key")) - 1
    sent = dealt.withColumn("__place", place).join(
        spark.createDataFrame(table), F.col("__block") == F.col("__of_block"))
    shard = F.size(F.filter("__cuts", lambda end: end <= F.col("__place")))
    sent = sent.withColumn("shard", shard).select(*columns, "shard", "__key", "__second")
    return with_rank(sent, ["shard"], "__second", ["__key"], -(-total // n_shards), "slot").select(*columns, "shard", "slot")
