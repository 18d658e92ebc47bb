"""TF-IDF features as long tables (inventory F1-F6, K1).

* F1 term counts per message are computed inside each row: the vectoriser
  tokens are sorted and run lengths are read off with array functions, so no
  shuffle is needed to count terms of one message.
* F2 vocabulary: the top ``max_features`` terms by total count (ties: term ascending), exact,
  in three passes that shuffle no more terms than they need (see :func:`top_terms`).
* F3 smoothed IDF ``ln((1+n)/(1+df)) + 1``.
* F4/F5 weights ``tf * idf`` normalised to unit L2 length per message.

A message is a row: what is regrouped after a join is regrouped by a row number that is
written with the term counts, so rows that share an id stay apart.

The fitted vocabulary has at most ``max_features`` rows; it is written once
and broadcast by that proven bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from smishlens.functions import text as T
from smishlens.session import shared_table

# Fixed value: vocabulary cap of the reference's vectoriser.
MAX_FEATURES = 10000
# A model table is broadcast by hint up to so many terms (about 100 bytes each);
# with a larger ``max_features`` the join is left to AQE.
BROADCAST_TERMS = 1_000_000

_ENTRY = ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())]))


# Columns with the term counts of a message and its row number, where they have been kept.
ENTRIES = "_entries"
ROW = "_msg_row"

#: Buckets of the terms' hashes in the first pass over the vocabulary.
BUCKETS = 1 << 20


def with_entries(df: DataFrame, text_col: str = "message") -> DataFrame:
    """``df`` written once with its messages' term counts, which every later fit
    and transform reads instead of tokenising the text again."""
    if ENTRIES in df.columns:
        return df
    return shared_table(with_term_count_array(df, text_col).withColumn(ROW, F.monotonically_increasing_id()), "term_counts")


def counted(df: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """``(id, keep..., entries, row number)`` of a table that may have them or only its text."""
    if ENTRIES in df.columns:
        return df.select(id_col, *keep, ENTRIES, ROW)
    own = with_term_count_array(df.select(id_col, *keep, text_col), text_col).drop(text_col)
    return shared_table(own.withColumn(ROW, F.monotonically_increasing_id()), "term_counts")


def with_term_count_array(df: DataFrame, text_col: str, out_col: str = ENTRIES) -> DataFrame:
    """Add ``array<struct<term, tf>>`` of each message, terms ascending.

    The sorted tokens and the run starts are separate projected columns: a
    lambda re-evaluates any outer expression it mentions for every element,
    while a column reference is read once."""
    toks = F.sort_array(T.vectorizer_tokens(F.col(text_col)))
    staged = df.withColumn("_toks", toks)
    n = F.size("_toks")
    staged = staged.withColumn("_starts", F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & ((i == 1) | (F.get(F.col("_toks"), i - 1) != F.get(F.col("_toks"), i - 2)))))
    entries = F.transform("_starts", lambda s, k: F.struct(
        F.get(F.col("_toks"), s - 1).alias("term"),
        (F.coalesce(F.get(F.col("_starts"), k + 1), n + 1) - s).cast("bigint").alias("tf")))
    return staged.withColumn(out_col, F.when(n > 0, entries).otherwise(F.array().cast(_ENTRY))) \
        .drop("_toks", "_starts")


def term_counts(df: DataFrame, id_col: str = "msg_id", text_col: str = "message",
                keep: list[str] | None = None, outer: bool = False) -> DataFrame:
    """``(id, keep..., term, tf)``. With ``outer`` a message without any
    term keeps one row with NULL term."""
    keep = keep or []
    if ENTRIES in df.columns:  # counted already, see ``with_entries``
        staged = df.select(id_col, *keep, ENTRIES)
    else:
        staged = with_term_count_array(df.select(id_col, *keep, text_col), text_col)
    # explode_outer + a filter on its output: an inner explode makes the
    # optimizer infer a size(...) > 0 filter below the projection, which would
    # copy the whole token expression into that filter.
    out = (staged.select(id_col, *keep, F.explode_outer(ENTRIES).alias("_e"))
           .select(id_col, *keep, F.col("_e.term").alias("term"), F.col("_e.tf").alias("tf")))
    return out if outer else out.filter(F.col("term").isNotNull())


@dataclass
class TfidfModel:
    vocabulary: DataFrame  # term, total, df, idf (at most max_features rows)
    n_docs: int
    max_features: int

    def bounded(self, table: DataFrame) -> DataFrame:
        """``table``, of at most ``max_features`` rows, marked for broadcast if that is few."""
        return F.broadcast(table) if self.max_features <= BROADCAST_TERMS else table

    def weights(self) -> DataFrame:
        """Side for joins with at most ``max_features`` rows."""
        return self.bounded(self.vocabulary.select("term", "idf"))

    def transform_long(self, df: DataFrame, id_col: str = "msg_id", text_col: str = "message",
                       keep: list[str] | None = None, keep_empty: bool = False) -> DataFrame:
        """``(id, keep..., term, tfidf)``; terms outside the vocabulary
        are dropped. With ``keep_empty`` a message with no known term keeps one
        row with NULL term and weight (the zero vector).

        Regrouping per message after the broadcast join is a partial
        aggregation, so one row per message (its sparse vector) is shuffled."""
        keep = keep or []
        counts = term_counts(counted(df, id_col, text_col, keep), id_col, text_col, [ROW, *keep], outer=keep_empty)
        joined = counts.join(self.weights(), "term", "left" if keep_empty else "inner")
        w = F.col("tf") * F.col("idf")
        per_doc = (joined.groupBy(ROW)
                   .agg(*[F.first(c).alias(c) for c in (id_col, *keep)],
                        F.collect_list(F.when(F.col("idf").isNotNull(),
                                              F.struct(F.col("term"), w.alias("w")))).alias("_v"),
                        F.sqrt(F.sum(w * w)).alias("_norm")))
        gen = F.explode_outer if keep_empty else F.explode
        return (per_doc.select(id_col, *keep, "_norm", gen("_v").alias("_e"))
                .select(id_col, *keep, F.col("_e.term").alias("term"),
                        (F.col("_e.w") / F.col("_norm")).alias("tfidf")))


def vocabulary_stats(counts: DataFrame) -> DataFrame:
    """``(term, total, df)`` over the whole corpus; partial aggregation first."""
    return counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("term"), F.lit(buckets))


def top_terms(counts: DataFrame, max_features: int = MAX_FEATURES, buckets: int = BUCKETS) -> DataFrame:
    """F2/K1: ``(term, total, df)`` of the ``max_features`` terms with the highest totals, ties by term, from
    ``(term, tf)`` rows; exact.

    1. The totals of ``buckets`` hash buckets are added up: a task sends that many numbers at most, and no term.
    2. The terms of the ``max_features`` largest buckets are counted. The total at rank ``max_features`` among
       them is a lower bound of the same rank among all terms.
    3. A term that reaches the bound lies in a bucket that does, so only the terms of such buckets
       are counted and sorted (all of them while fewer terms than that are known).

    The bucket table has ``buckets`` rows at most and is broadcast by that bound."""
    keyed = counts.select("term", "tf", _bucket(buckets).alias("_b"))
    sums = shared_table(keyed.groupBy("_b").agg(F.sum("tf").alias("_n")), "term_buckets")

    def stats_of(chosen: DataFrame) -> DataFrame:
        return vocabulary_stats(keyed.join(F.broadcast(chosen.select("_b")), "_b", "left_semi"))

    largest = sums.orderBy(F.col("_n").desc(), "_b").limit(max_features)
    known = shared_table(stats_of(largest), "term_bound").orderBy(F.col("total").desc()).select("total").limit(max_features)
    rows, bound = known.agg(F.count("*"), F.min("total")).first()
    heavy = sums.filter(F.col("_n") >= bound) if rows == max_features else sums
    return stats_of(heavy).orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features)


def fit_tfidf(df: DataFrame, id_col: str = "msg_id", text_col: str = "message",
              max_features: int = MAX_FEATURES, checkpoint: bool = True) -> TfidfModel:
    """F2 + F3 (and F6 when called on all rows)."""
    df = counted(df, id_col, text_col, [])
    n_docs = df.count()
    vocab = top_terms(term_counts(df, id_col, text_col), max_features).withColumn(
        "idf", F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))
    if checkpoint:
        vocab = shared_table(vocab, "vocabulary")
    return TfidfModel(vocab, n_docs, max_features)
