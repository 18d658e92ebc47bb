"""Data augmentation by translation (inventory E3, G1-G4).

The reference calls a translation service per row and attempt. Here the service
is a ``translations(src_lang, tgt_lang, text_in, text_out)`` table and a call is
an equi-join; a text without an entry is the failure path (row skipped). A
text may list several translations: they are ranked (by text), and
attempt j takes candidate j modulo their number.

The join key is a pair of independently seeded 64-bit hashes of the text (128
bits; a collision among 10^10 distinct texts has odds near 10^-19), so the
shuffled rows carry a text once. AQE broadcasts a side that is small at run
time and splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.operators.preprocess import rename_text_column

# The tag of Spanish originals, and the optional tags of
# augmented rows (the reference leaves those NULL).
ORIGINAL_ES = "original_es"
TAG_BT = "bt"
TAG_EN2ES = "en2es"


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit("seed-2"), text).alias("_k2")]


def candidates(translations: DataFrame, src: str, tgt: str) -> DataFrame:
    """``(_k1, _k2, _options)``: the ranked distinct translations of every listed text."""
    table = translations.filter((F.col("src_lang") == src) & (F.col("tgt_lang") == tgt)
                                & F.col("text_in").isNotNull() & F.col("text_out").isNotNull())
    return (table.select(*_key(F.col("text_in")), "text_out").groupBy("_k1", "_k2")
            .agg(F.sort_array(F.collect_set("text_out")).alias("_options")))


def with_options(df: DataFrame, translations: DataFrame, src: str, tgt: str, text_col: str = "message") -> DataFrame:
    """``df`` with ``_options``; rows without a translation drop out."""
    keyed = df.select("*", *_key(F.col(text_col)))
    return keyed.join(candidates(translations, src, tgt), ["_k1", "_k2"]).drop("_k1", "_k2")


def _attempt(options: Column, attempt: Column) -> Column:
    return F.get(options, F.pmod(attempt, F.size(options)))


def translate(df: DataFrame, translations: DataFrame, src: str, tgt: str, text_col: str = "message",
              attempt: Column | int = 0) -> DataFrame:
    """Replace ``text_col`` by the translation of the given attempt."""
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    found = with_options(df, translations, src, tgt, text_col)
    return found.withColumn(text_col, _attempt(F.col("_options"), attempt)).drop("_options")


def back_translate(es: DataFrame, translations: DataFrame, num_bt: int = 1) -> DataFrame:
    """G1: es -> en -> es, ``num_bt`` attempts per row (equal results kept)."""
    if num_bt <= 0:  # sequence(0, -1) would yield [0, -1]
        return translate(es, translations, "es", "en").limit(0)
    attempts = with_options(es, translations, "es", "en").withColumn(
        "_attempt", F.explode(F.sequence(F.lit(0), F.lit(num_bt - 1))))
    english = attempts.withColumn("message", _attempt(F.col("_options"), F.col("_attempt"))).drop("_options")
    return translate(english, translations, "en", "es", attempt=F.col("_attempt")).drop("_attempt")


def translate_distinct(en: DataFrame, translations: DataFrame, num_en2es: int = 1) -> DataFrame:
    """En -> es, ``num_en2es`` attempts; equal translations of one source row
    are kept once (equal translations of different rows are all kept)."""
    if num_en2es <= 0:
        return translate(en, translations, "en", "es").limit(0)
    found = with_options(en, translations, "en", "es")
    tries = F.transform(F.sequence(F.lit(0), F.lit(num_en2es - 1)), lambda j: _attempt(F.col("_options"), j))
    return found.withColumn("message", F.explode(F.array_distinct(tries))).drop("_options")


def augment(es: DataFrame, en: DataFrame, translations: DataFrame, num_bt: int = 1, num_en2es: int = 1,
            tag_augmented: bool = False, id_col: str = "msg_id") -> dict[str, DataFrame]:
    """Spanish originals tagged ``original_es`` + back-translations +
    en->es translations; augmented rows carry a NULL ``aug_type`` unless
    ``tag_augmented``. English originals are not emitted. Returns the union
    and its parts. A ``text`` column is renamed to ``message`` first (B1)."""
    es, en = rename_text_column(es), rename_text_column(en)
    originals = es.select("message", "label").withColumn("aug_type", F.lit(ORIGINAL_ES))
    bt = back_translate(es.select(id_col, "message", "label"), translations, num_bt).select("message", "label")
    en2es = translate_distinct(en.select(id_col, "message", "label"), translations, num_en2es) \
        .select("message", "label")
    if tag_augmented:
        bt = bt.withColumn("aug_type", F.lit(TAG_BT))
        en2es = en2es.withColumn("aug_type", F.lit(TAG_EN2ES))
    union = originals.unionByName(bt, allowMissingColumns=True).unionByName(en2es, allowMissingColumns=True)
    return {"union": union, "originals": originals, "bt": bt, "en2es": en2es}


def augment_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """``(kind, n)`` for originals, back-translations and translations."""
    counted = [parts[k].select(F.lit(k).alias("kind")) for k in ("originals", "bt", "en2es")]
    out = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
