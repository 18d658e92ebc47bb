"""Prefix trie of conversations as balanced parentheses.

A conversation is a path: a 16-byte digest of every turn (role and text), one after the
other. Sorted by path, conversations come in the order of a walk through their trie: the
turns shared with the path before stay open, the rest closes, the new turns open. So a
range of sorted paths is the trie's parentheses there, and every shard (``SHARD_BYTES`` of
distinct paths) encodes its own: an excess array with a tree of block minima over it.
On it ``find_close`` delimits the subtree of a node, rank counts the leaf pairs ``()``
in between, and cumulative arrays give members and savings.

Shared spines: the nodes on the way from the root to the cut between two shards lie in
both. A shard knows the last path before it and the first after it, so it counts a
node's bytes and its place among its parent's children only where the node opens first, and no
leaf that the next shard goes on from. Then all numbers of a spine node add up
over its shards (the smallest id: by minimum). Spine nodes are named by the digest of
their path; all others lie in one shard and need no name.

Equal conversations are one path with a count before anything is sharded. Their ids meet
only as sorted runs of text that are fed to a running SHA-256.

Defined cases: rows without a conversation id are left out; turns are ordered by turn (null
first), then role and text; null role or text is empty; repeated rows are turns of their own; a conversation
may have no turn and then is a member of the root; no conversation gives no node; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from smishlens.llm.arrow_text import release
from smishlens.session import shared_table

#: Bytes of a turn in a path, and of the paths of a shard, about.
TURN = 16
SHARD_BYTES = 16 << 20
#: Parentheses of a block of the range min-max tree.
BLOCK = 64

_NONE = np.iinfo(np.int64).max


class Parentheses:
    """A balanced sequence: ``bits`` is 1 where a parenthesis opens."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        padded = np.full(-(-len(bits) // BLOCK) * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:len(bits)] = self.excess
        self._padded = padded
        #: least excess of every block, then of every two, four, .. blocks
        self.least = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(self.least[-1]) > 1:
            level = self.least[-1]
            level = np.append(level, np.iinfo(np.int32).max) if len(level) % 2 else level
            self.least.append(level.reshape(-1, 2).min(axis=1))

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at ``at`` close."""
        want = self.excess[at] - 1
        out = np.zeros(len(at), np.int64)
        rest = self._scan(at + 1, want, out, np.arange(len(at)))
        if len(rest):
            level, node = self._climb(at[rest] // BLOCK + 1, want[rest])
            self._scan(self._descend(level, node, want[rest]) * BLOCK, want[rest], out, rest)
        return out

    def _scan(self, start: np.ndarray, want: np.ndarray, out: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Looks for ``want`` from ``start`` to the end of that block, for the rows ``to`` of ``out``; the rows that have none."""
        stop = (start // BLOCK + 1) * BLOCK
        place, here, missing = start.copy(), np.arange(len(start)), [to[:0]]
        while len(here):
            hit = self._padded[place[here]] <= want[here]
            out[to[here[hit]]] = place[here[hit]]
            here = here[~hit]
            place[here] += 1
            over = place[here] == stop[here]
            missing.append(to[here[over]])
            here = here[~over]
        return np.concatenate(missing)

    def _climb(self, node: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(level, node): the first node of the tree from a block on that holds an excess of ``want``."""
        level_of, found = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        rest, node = np.arange(len(node)), node.copy()
        for level, least in enumerate(self.least):
            for neighbour in (False, True):  # the node, and where it is a left one, the one beside it
                if neighbour:
                    node[rest] |= 1
                hit = least[np.minimum(node[rest], len(least) - 1)] <= want[rest]
                level_of[rest[hit]], found[rest[hit]] = level, np.minimum(node[rest[hit]], len(least) - 1)
                rest = rest[~hit]
            node[rest] = (node[rest] + 1) // 2
            if not len(rest):
                break
        return level_of, found

    def _descend(self, level_of: np.ndarray, node: np.ndarray, want: np.ndarray) -> np.ndarray:
        node = node.copy()
        for level in range(int(level_of.max(initial=0)), 0, -1):
            down = np.flatnonzero(level_of >= level)
            left = 2 * node[down]
            node[down] = left + (self.least[level - 1][left] > want[down])
        return node


def least_in(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least of ``values[first:first + size]`` for every row."""
    out = np.empty(len(first), values.dtype)
    level = np.frexp(size)[1] - 1  # the largest power of two that is not above the size
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[first[own]], table[first[own] + size[own] - (1 << k)])
        if 1 << k < len(table):  # else there is no longer range
            table = np.minimum(table[:-(1 << k)], table[1 << k:])
    return out


def common_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths share from the start; -1 where there is no path."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // TURN
    x, y = (np.frombuffer(p, np.uint8, n * TURN).reshape(n, TURN) for p in (a, b))
    return int(np.append(np.flatnonzero((x != y).any(axis=1)), n)[0])


def _shared_turns(turns: np.ndarray, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Turns that every path shares with the one before it (the first: 0)."""
    out = np.zeros(len(depth), np.int64)
    limit = np.minimum(depth[1:], depth[:-1])
    here, d = np.arange(1, len(depth)), 0
    while len(here):
        here = here[limit[here - 1] > d]
        here = here[(turns[start[here] + d] == turns[start[here - 1] + d]).all(axis=1)]
        d += 1
        out[here] = d
    return out


def _prefix_digests(path: bytes, depth: int) -> list[bytes]:
    """The MD5 of the first 0 .. ``depth`` turns."""
    running, out = hashlib.md5(), []
    for d in range(depth + 1):
        if d:
            running.update(path[(d - 1) * TURN:d * TURN])
        out.append(running.copy().digest())
    return out


_NODE = ("depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
         "parent_conv_id long, key binary, parent_key binary")


def encode(paths: list[bytes], sizes: np.ndarray, members: np.ndarray, least: np.ndarray, ends: list[str],
           before: bytes | None = None, after: bytes | None = None) -> pa.Table:
    """The nodes of one shard's trie, from its distinct ``paths`` in ascending order: ``sizes`` of all their turns, number and least id
    of each path's members, digest of their ids. ``before`` and ``after`` are the paths next to the shard. A node that lies in
    other shards too has a ``key``; its numbers are this shard's part."""
    depth = np.array([len(p) // TURN for p in paths], np.int64)
    start = np.cumsum(depth) - depth
    shared = _shared_turns(np.frombuffer(b"".join(paths), "<u8").reshape(-1, 2), start, depth)
    opens = depth - shared
    closes = np.append(depth[:-1] - shared[1:], depth[-1] + 1)
    # the root opens, then every path opens its new turns, and what the next one does not share closes
    bits = np.repeat(np.tile(np.array([1, 0], np.uint8), len(paths)), np.stack((opens, closes), axis=1).ravel())
    tree = Parentheses(np.concatenate((np.ones(1, np.uint8), bits)))

    n = 1 + int(opens.sum())  # nodes, numbered as they open
    first = 1 + np.cumsum(opens) - opens
    level = np.concatenate(([0], np.arange(1, n) - np.repeat(first - 1 - shared, opens)))
    size = np.concatenate(([0], sizes[np.repeat(start, opens) + level[1:] - 1])).astype(np.int64)
    end = np.where(depth > 0, first + opens - 1, 0)
    opening = np.flatnonzero(tree.bits)
    closing = tree.find_close(opening)
    number = np.arange(n)
    below = (closing - opening + 1) // 2  # nodes of the subtree, which follow each other

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[number + below] - total[number]

    own = np.zeros(n, np.int64)
    own[end] = members
    convs = subtree(own)
    own = np.full(n, _NONE)
    own[end] = least
    conv_id = least_in(own, number, below)

    # what is counted in an earlier shard, and a leaf from which the next shard goes on
    left, right = common_turns(before, paths[0]), common_turns(paths[-1], after)
    new = np.ones(n, bool)
    new[:left + 1] = False  # the first path's nodes are the first numbers
    pairs = np.zeros(len(tree.bits) + 1, np.int64)
    pairs[1:] = np.cumsum((tree.bits == 1) & (np.append(tree.bits[1:], 1) == 0))
    leaves = pairs[closing] - pairs[opening]
    by_level = np.sort(level * n + number)
    parent = by_level[np.searchsorted(by_level, (level - 1) * n + number) - 1] % n
    parent[0] = -1
    last = by_level[np.searchsorted(by_level, (np.arange(right + 1) + 1) * n) - 1] % n  # the last path's nodes, from the root
    if right == depth[-1]:
        leaves[last] -= 1
    children = np.bincount(parent[1:][new[1:]], minlength=n)
    saved = subtree((convs - new) * size)

    keys = np.full(n, None, object)
    keys[:max(left, 0) + 1] = _prefix_digests(paths[0], max(left, 0))
    if right >= 0:
        keys[last] = _prefix_digests(paths[-1], right)
    digest = np.full(n, None, object)
    digest[end] = ends
    of = np.where(parent >= 0, keys[parent], None)
    inside = (parent >= 0) & np.equal(of, None)
    up = pa.array(conv_id[parent], mask=~inside)
    columns = [level, conv_id, convs, children, leaves, saved, pa.array(digest, pa.string()), up,
               pa.array(keys, pa.binary()), pa.array(of, pa.binary())]
    return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [c.split()[0] for c in _NODE.split(", ")])


def paths(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path, sizes): the turns' digests one after the other, and the UTF-8 bytes of their texts."""
    own = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = turns.filter(F.col(conv).isNotNull()).groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(own)).alias("turns"))
    digest = F.transform("turns", lambda t: F.md5(F.concat(F.octet_length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"])))
    return whole.select("conv_id", F.unhex(F.array_join(digest, "")).alias("path"),
                        F.transform("turns", lambda t: F.octet_length(t["text"])).alias("sizes"))


def grafted(found: DataFrame, base: str, kept: str) -> DataFrame:
    """Each conversation of :func:`paths` anew: the first ``kept`` turns of conversation ``base`` (SQL of conv_id), then
    its own after as many. A conversation that is not there has no turns."""
    of = found.select(F.col("conv_id").alias("of"), F.col("path").alias("of_path"), F.col("sizes").alias("of_sizes"))
    joined = found.withColumns({"base": F.expr(base), "kept": F.expr(kept).cast("int")}).join(of, F.col("base") == F.col("of"), "left")
    return joined.select(
        "conv_id",
        F.expr(f"concat(substring(coalesce(of_path, X''), 1, {TURN} * kept), substring(path, {TURN} * kept + 1))").alias("path"),
        F.expr("concat(slice(coalesce(of_sizes, array()), 1, kept), slice(sizes, kept + 1, greatest(size(sizes) - kept, 0)))").alias("sizes"))


def end_digests(ids: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): the SHA-256 of a key's ids, ascending and joined by commas.

    Ids are sorted in ranges of (key, id), so a frequent key lies in many tasks; what meets in one are its
    runs of text, one after the other."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, conv = batch.column(0), batch.column(1)
            n = len(key)
            if not n:
                continue
            change = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            first = np.concatenate(([0], np.flatnonzero(change) + 1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, n), pa.int32()), conv.cast(pa.string()))
            yield pa.RecordBatch.from_arrays([key.take(pa.array(first)), conv.take(pa.array(first)),
                                              pc.binary_join(lists, ",").cast(pa.binary())], ["key", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            keys, found = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
                if own == key:
                    running.update(b",")
                else:
                    if key is not None:
                        keys.append(key)
                        found.append(running.hexdigest())
                    key, running = own, hashlib.sha256()
                running.update(ids.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.select("key", "conv_id").repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = ranged.mapInArrow(runs, "key binary, first long, ids binary")
    return texts.repartition(n, "key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


def nodes(found: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All nodes of the trie of (conv_id, path, sizes): conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = found.sparkSession
    members = shared_table(found.withColumn("key", F.unhex(F.md5("path"))), "conversations")
    ends = end_digests(members)
    distinct = members.groupBy("key", "path").agg(F.count("*").alias("members"), F.min("conv_id").alias("least"), F.max("sizes").alias("sizes"))
    distinct = shared_table(distinct.join(ends, "key").drop("key"), "distinct_paths")
    total = distinct.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    # written, as the limits of the ranges are drawn from a sample
    ranged = shared_table(distinct.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id()), "shards")
    order = Window.orderBy("shard")  # one row per shard
    cuts = ranged.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")) \
        .select("shard", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))

    def one(rows: pa.Table, near: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("path")
        sizes = rows["sizes"].combine_chunks()
        out = encode(rows["path"].to_pylist(), sizes.flatten().to_numpy(), rows["members"].to_numpy(), rows["least"].to_numpy(),
                     rows["ends_sha256"].to_pylist(), near["before"][0].as_py(), near["after"][0].as_py())
        release()
        return out.cast(layout)

    layout = to_arrow_schema(_parse_datatype_string(_NODE))
    parts = shared_table(ranged.groupBy("shard").cogroup(cuts.groupBy("shard")).applyInArrow(one, _NODE), "shard_nodes")
    spine = shared_table(parts.filter("key is not null").groupBy("key").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"), F.max("parent_key").alias("parent_key")), "spine")
    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_parent"))
    inner = parts.filter("key is null")
    hung = inner.filter("parent_key is not null").drop("key", "parent_conv_id").unionByName(spine.drop("key")) \
        .join(above, "parent_key", "left").withColumnRenamed("of_parent", "parent_conv_id")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = F.lit(hashlib.sha256().hexdigest())
    return inner.filter("parent_key is null").unionByName(hung, allowMissingColumns=True) \
        .select(*columns, F.coalesce("ends_sha256", none).alias("ends_sha256"))
