"""Benchmark decontamination by word n-grams.

Words are the runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased. A window is ``n`` consecutive words of a benchmark item; an item of
fewer words, but not none, is one window. The distinct windows are hashed and
broadcast, ``MAX_BROADCAST_WINDOWS`` at a time: a larger benchmark takes as many passes over the
texts as it has such parts, and only the hits of a pass are written. Every word position of every text probes the hash of the window
that starts there; a hit is verified by comparing the words themselves, inside the
join. A text's hit words are those inside any verified window, its items
those that own one.

The probe runs in generated code: positions are exploded, the hash is computed
from the words of the row, and only hits and each text's first position leave the
join, so nothing of the size of the corpus is shuffled or collected.

Defined cases: a null text has no words, an item without words no window.
Repeated items count once per id; an item with null id makes hits, its id is
the empty string. Rows with equal keys and text are scanned as one and counted in
``copies``. Empty tables give empty results, or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.session import shared_table

#: Words in a window.
WINDOW = 10
#: Most distinct windows that are broadcast at a time (about 100 bytes each).
MAX_BROADCAST_WINDOWS = 500_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words, in a text whose A-Z are lower case, and in any text.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The normalised words of a text; an empty array for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _hash(array: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(array, at + j) for j in range(size)])


def windows(benchmark: DataFrame, n: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """(size, hash, window, items): the distinct windows, with the ids that own each."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                             words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    items = items.withColumn("size", F.least(F.size("w"), F.lit(n)))
    starts = items.select("item", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
    found = starts.select("item", "size", F.slice("w", F.col("at"), F.col("size")).alias("w"))
    hashed = F.lit(None).cast("long")
    for size in range(1, n + 1):
        hashed = F.when(F.col("size") == size, _hash(F.col("w"), F.lit(0), size)).otherwise(hashed)
    return found.select("item", "size", hashed.alias("hash"), F.array_join("w", " ").alias("window")) \
        .groupBy("size", "hash", "window").agg(F.collect_set("item").alias("items"))


def scan(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", n: int = WINDOW,
         item: str = "item_id", bench_text: str = "text") -> DataFrame:
    """One row per distinct (keys, text hash) of ``docs``: the keys, ``text_hash``,
    ``n_words``, ``hits`` (array of (pos, size): first word, from 0, and words of
    each verified window), ``items`` (sorted ids as strings) and ``copies`` (rows)."""
    grams = windows(benchmark, n, item, bench_text)
    sizes = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count("*").alias("n")).collect()}
    grams = grams.select(F.col("size").alias("g_size"), F.col("hash").alias("g_hash"), "window", "items")
    passes = max(1, -(-sum(sizes.values()) // MAX_BROADCAST_WINDOWS))
    if passes > 1:
        grams = shared_table(grams, "windows")
    names = [f"__key{i}" for i in range(len(keys))]
    rows = docs.select(*[F.col(k).alias(x) for k, x in zip(keys, names)],
                       F.xxhash64(F.col(text)).alias("text_hash"), words(F.col(text)).alias("w"))
    at = rows.select("*", F.size("w").alias("n_words"), F.posexplode_outer("w").alias("pos", "word")).drop("word")
    at = at.withColumn("pos", F.coalesce("pos", F.lit(0)))
    # one probe per window size that the benchmark has (nearly always one)
    probes = [F.struct(F.lit(size).alias("size"),
                       F.when(F.col("pos") <= F.col("n_words") - size, _hash(F.col("w"), F.col("pos"), size)).alias("hash"))
              for size in sorted(sizes) or [n]]
    if len(probes) > 1:
        at = at.withColumn("probe", F.explode(F.array(*probes)))
    else:
        at = at.withColumn("probe", probes[0])
    at = at.select(*names, "text_hash", "w", "n_words", "pos", F.col("probe.size").alias("size"), F.col("probe.hash").alias("hash"))

    def probed(part: DataFrame, first: bool) -> DataFrame:
        """The hits in a part of the windows; with ``first``, also every text's first position."""
        same = (F.col("size") == F.col("g_size")) & (F.col("hash") == F.col("g_hash")) \
            & (F.array_join(F.slice("w", F.col("pos") + 1, F.col("size")), " ") == F.col("window"))
        found = at.join(F.broadcast(part), same, "left" if first else "inner")
        if first:
            found = found.filter(F.col("window").isNotNull() | (F.col("pos") == 0))
        hit = F.when(F.col("window").isNotNull(), F.struct("pos", "size"))
        return found.select(*names, "text_hash", "n_words", "pos", F.lit(first).alias("counts"), hit.alias("hit"), "items")

    if passes == 1:
        found = probed(grams, True)
    else:  # parts by hash, which is even
        found = reduce(DataFrame.unionByName, [
            shared_table(probed(grams.filter(F.pmod("g_hash", F.lit(passes)) == k), k == 0), "window_hits") for k in range(passes)])
    return found.groupBy(*names, "text_hash").agg(F.max("n_words").alias("n_words"), F.collect_set("hit").alias("hits"),
                                          F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                                          (F.count_if((F.col("pos") == 0) & F.col("counts")) / len(probes)).cast("long").alias("copies")) \
        .select(*[F.col(x).alias(k) for k, x in zip(keys, names)], "text_hash", "n_words", "hits", "items", "copies")


def hit_positions(hits: Column) -> Column:
    """The word positions inside any window of ``hits``, each once."""
    return F.array_distinct(F.flatten(F.transform(
        hits, lambda h: F.sequence(h["pos"], h["pos"] + h["size"] - 1))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "drop", text: str = "text",
                  n: int = WINDOW, item: str = "item_id", bench_text: str = "text") -> DataFrame:
    """``docs`` without contamination, with their own columns.

    ``action`` "drop" removes every row with a hit; "spans" removes the hit
    words (what stands between words is kept) and leaves the other texts as
    they are."""
    if action not in ("drop", "spans"):
        raise ValueError(f"action is 'drop' or 'spans', not {action!r}")
    columns = docs.columns
    twin = docs.select(F.col(text), F.hash(F.col(text)).alias("__second"))
    dirty = scan(twin, benchmark, ["__second"], text, n, item, bench_text).filter(F.size("hits") > 0)
    dirty = dirty.select("__second", F.col("text_hash").alias("__first"), hit_positions(F.col("hits")).alias("__hit"))
    marked = docs.withColumn("__first", F.xxhash64(F.col(text))).withColumn("__second", F.hash(F.col(text)))
    if action == "drop":
        return marked.join(dirty, ["__first", "__second"], "left_anti").select(*columns)
    found = F.array_remove(F.split(F.col(text), _BETWEEN_ANY_CASE), "")
    # split by the words, so that between[i] stands before word i
    between = F.split(F.col(text), r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    kept = F.transform(found, lambda w, i: F.when(F.array_contains("__hit", i), F.lit("")).otherwise(w))
    cut = F.array_join(F.zip_with(between, kept, lambda b, w: F.concat(b, F.coalesce(w, F.lit("")))), "")
    joined = marked.join(dirty, ["__first", "__second"], "left")
    return joined.withColumn(text, F.when(F.col("__hit").isNotNull(), cut).otherwise(F.col(text))).select(*columns)
