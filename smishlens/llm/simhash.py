"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: 64 bits; a bit is 1 when more than half of the XXH64 values
(seed 42) of the text's word shingles have it set.

Two fingerprints that differ in at most ``d`` of 64 bits, cut into
``d // 2 + 1`` segments, agree in some segment but for at most one bit (d + 1 or
more segments would be needed for full agreement). Every segment value is
indexed as it is; it is probed by itself and by its one-wildcard variants. The
wildcard stands for the one bit in which the two may differ, so the variant of
the value with the 1 there equals the other value, and one equality join finds
both cases, each pair once per segment. Joined pairs are verified over all 64
bits inside the join.

Documents are reduced to distinct fingerprints first, so exact copies never
meet in the join. Near copies form dense balls of fingerprints around a
common text: a ball's members would all link to each other. These are joined
to their ball's frequent neighbours instead (see :func:`links`), which keeps
the components exactly as they are.

Components: min-label propagation with large-star and small-star steps over the
links, every round written to the shared folder, until no link changes.

Defined cases: a null text, or one without words, has fingerprint 0 and is linked
like any other; a text shorter than a shingle is one shingle; repeated rows
share their component; a null id never is the smallest id unless the
component has no other. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.llm.arrow_text import as_array
from smishlens.session import shared_table

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one text in UTF-8."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles),
                         np.uint64, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 14):
        block = hashes[part:part + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a signed long with the same bits."""
    def apply(column: pa.Array) -> pa.Array:
        texts = as_array(column).cast(pa.binary())
        prints = (simhash(t.as_py() or b"", shingle_words) for t in texts)
        return pa.array(np.fromiter(prints, np.uint64, len(texts)).view(np.int64))

    apply.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "long").asNondeterministic()(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment: as many as make one differ by at
    most one bit."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _keys(fp: Column, max_bits: int, wildcards: bool) -> Column:
    """Array of (segment, value) keys of a fingerprint: the segment's own value,
    or that and every variant with the wildcard on one of its 1 bits."""
    def of(segment: int, low: int, width: int) -> Column:
        value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        own = F.array(value)
        if wildcards:
            bits = F.array(*[F.lit(1 << j).cast("long") for j in range(width)])
            ones = F.filter(bits, lambda bit: value.bitwiseAND(bit) != 0)
            own = F.concat(own, F.transform(ones, lambda bit: value.bitwiseXOR(bit)))
        return F.transform(own, lambda v: F.struct(F.lit(segment).alias("segment"), v.alias("value")))

    return F.concat(*[of(k, low, width) for k, (low, width) in enumerate(segments(max_bits))])


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _rows(prints: DataFrame, max_bits: int, *more: str) -> DataFrame:
    """The index and probe rows (segment, value, fp, n, probe) of all fingerprints.

    A fingerprint makes some forty rows, and a table of fingerprints is few files:
    it is dealt over the shuffle partitions before."""
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")

    def rows(wildcards: bool) -> DataFrame:
        return spread.select("fp", "n", *more, F.lit(wildcards).alias("probe"),
                             F.explode(_keys(F.col("fp"), max_bits, wildcards)).alias("key")) \
            .select("key.segment", "key.value", "fp", "n", *more, "probe")

    return rows(False).unionByName(rows(True))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` (long, with ``n``
    documents each): each is a verified pair within ``max_bits`` bits, and they
    connect all fingerprints that such pairs connect.

    First every member of a bucket is compared with the bucket's pivot only (its
    fingerprint with the most documents), and the components of these links are
    formed. Then, bucket by bucket, all pairs are joined but those of two
    members of the pivot's own component, which are connected already. So a
    dense ball costs about its size, not its square, and members far from the pivot
    still meet everybody. All joins verify the distance themselves: what they put
    out are links, not candidates.

    Joins by bucket are sort-merge joins by a hint: Spark sizes the rows of an explode
    like the fingerprints, forty times too low, and would broadcast them."""
    bucket = ["segment", "value"]
    rows = _rows(prints, max_bits)
    pivots = rows.groupBy(*bucket).agg(F.min("fp").alias("low"), F.max("fp").alias("high"),
                                       F.min(F.struct((-F.col("n")).alias("n"), "fp")).alias("top"))
    pivots = pivots.filter("low < high").select(*bucket, F.col("top.fp").alias("pivot"))
    star = rows.select(*bucket, "fp").join(pivots.hint("merge"), bucket) \
        .filter((F.col("fp") != F.col("pivot")) & (_distance("fp", "pivot") <= max_bits))
    star = shared_table(star.select(*_ordered("fp", "pivot")).distinct(), "star_links")

    label = components(star).withColumnRenamed("node", "fp")
    labelled = prints.join(label, "fp", "left").select("fp", "n", F.coalesce("label", "fp").alias("label"))
    rows = _rows(shared_table(labelled, "labelled_prints"), max_bits, "label")
    tops = rows.groupBy(*bucket).agg(F.min(F.struct((-F.col("n")).alias("n"), "fp", "label")).alias("top"))
    rows = rows.join(tops.hint("merge"), bucket).select(*bucket, "fp", "probe", (F.col("label") != F.col("top.label")).alias("minor"))
    rows = shared_table(rows, "bucket_rows")

    def pairs(index: DataFrame, probe: DataFrame) -> DataFrame:
        a = index.filter("not probe").select(*bucket, F.col("fp").alias("a"))
        b = probe.filter("probe").select(*bucket, F.col("fp").alias("b"))
        near = a.join(b.hint("merge"), bucket).filter((F.col("a") != F.col("b")) & (_distance("a", "b") <= max_bits))
        return near.select(*_ordered("a", "b"))

    rest = pairs(rows.filter("minor"), rows).unionByName(pairs(rows.filter("not minor"), rows.filter("minor")))
    return star.unionByName(rest).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the
    smallest node of its component.

    Large-star: every larger neighbour of a node is linked to the smallest of its
    neighbourhood instead; small-star: the same for the smaller neighbours and
    the node itself. Both keep components; at the end each is one star."""
    edges = shared_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .filter("u != v").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u != v").distinct()
        large = shared_table(large, "large_star")
        # after a large-star every link points from the larger node u to the smaller v
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = shared_table(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "small_star")
    nodes = edges.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return nodes.unionByName(roots)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
                    shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row (id, fp, component_id) per document; ``component_id`` is the
    smallest id reachable over links, the document's own included."""
    prints = shared_table(docs.select(F.col(id_col), fingerprint(F.col(text), shingle_words).alias("fp")), "prints")
    distinct = shared_table(prints.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n")), "distinct")
    label = components(links(distinct.select("fp", "n"), max_bits))
    labelled = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_print = labelled.join(least, "label").select("fp", "component_id")
    return prints.join(of_print, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", max_bits: int = MAX_BITS,
             shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of every component, with its own columns: the one with the
    smallest ``doc_id`` (null last), of equal ids the one with the smallest hash
    over all columns. Rows equal in all columns are one row."""
    columns = docs.columns
    key = F.xxhash64(*[F.col(c) for c in columns])
    of_row = near_duplicates(docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key.alias("hash"))
                                         .alias("__row"), text), "__row", text, max_bits, shingle_words)
    first = of_row.select("component_id.*").distinct().select(
        F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"))
    found = docs.withColumn("__key", key).join(
        first, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash")))
    return found.dropDuplicates(["__id", "__hash"]).select(*columns)
