"""Token normalisation by lookup (inventory C8-C11, E2).

The reference lemmatises and stems word by word with a library. Here a word
table (``word``, ``lemma``/``stem``) is joined to the tokens:

* two tables in a row are made one first, on the words alone;
* messages are numbered (and written, unless they have numbers already), and their tokens exploded
  with their position (narrow, per partition);
* only entries that change a word take part in the join, and only tokens that change leave it: the table is
  broadcast when its rows are counted to be few, otherwise only rare words shuffle (see ``operators.skew``);
* the new tokens are gathered per message (partial aggregation on the map side, so
  about one row per message crosses the shuffle) and laid over the message's own tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.operators.porter import porter_stems
from smishlens.operators.skew import matches
from smishlens.operators.tfidf import ROW
from smishlens.session import shared_table


def explode_tokens(df: DataFrame, text_col: str = "message", id_col: str = "msg_id") -> DataFrame:
    """``(id, other columns, _row, pos, tok)``; a message without tokens keeps one row
    with NULL. ``_row`` (a hash of the text) tells rows apart that share an id."""
    others = [c for c in df.columns if c not in (id_col, text_col)]
    # in a projection of its own: beside the generator the whole text would be hashed again for each of its tokens
    hashed = df.withColumn("_row", F.xxhash64(text_col))
    return hashed.select(id_col, *others, "_row", F.posexplode_outer(T.whitespace_tokens(F.col(text_col))).alias("pos", "tok"))


def changes(table: DataFrame, value_col: str, unique: bool = False) -> DataFrame:
    """``(_w, _v)``: the entries of a word table that change their word, written, as several jobs read them.
    A supplied table may list a word twice (one entry is kept); ``unique`` says it is distinct by word."""
    some = (table.filter(F.col("word") != F.col(value_col))
            .select(F.col("word").alias("_w"), F.col(value_col).alias("_v")))
    return shared_table(some if unique else some.dropDuplicates(["_w"]), "changes")


def composed(first: DataFrame, second: DataFrame) -> DataFrame:
    """One table of :func:`changes` that does what two do one after the other."""
    then = second.select(F.col("_w").alias("_from"), F.col("_v").alias("_to"))
    both = first.join(then, F.col("_v") == F.col("_from"), "left").select("_w", F.coalesce("_to", "_v").alias("_v"))
    alone = second.join(first.select("_w"), "_w", "left_anti")
    return shared_table(both.unionByName(alone).filter("_w <> _v"), "changes")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number for each row, written, so that the number holds whatever is read; of all that the lookups
    write, this has the texts, so it is packed closely."""
    return df if ROW in df.columns else shared_table(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered", "zstd")


def row_tokens(df: DataFrame, text_col: str) -> DataFrame:
    """``(row number, pos, tok)`` of every token."""
    return explode_tokens(df.select(ROW, text_col), text_col, ROW).select(ROW, "pos", "tok").filter(F.col("tok").isNotNull())


def replace_words(df: DataFrame, table: DataFrame, text_col: str, counts: DataFrame | None = None) -> DataFrame:
    """The tokens of every numbered row with the words of ``table`` (see :func:`changes`) replaced, re-joined
    with one blank; null stays null. ``counts``: see :func:`operators.skew.matches`."""
    hits = matches(row_tokens(df, text_col), table, "tok", "_w", counts)
    new = hits.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("pos", F.col("_v").alias("tok")))).alias("_new"))
    # columns of their own, as they are read for every new token
    both = df.join(new.hint("merge"), ROW, "left").withColumn("_toks", T.whitespace_tokens(F.col(text_col)))

    def kept(after: Column, before: Column) -> Column:
        """The tokens between two positions, from 0."""
        return F.slice("_toks", after + 2, before - after - 1)

    parts = F.transform("_new", lambda s, i: F.concat(
        kept(F.coalesce(F.get(F.col("_new"), i - 1)["pos"], F.lit(-1)), s["pos"]), F.array(s["tok"])))
    tail = kept(F.element_at("_new", -1)["pos"], F.size("_toks"))
    joined = T.join_tokens(F.when(F.col("_new").isNull(), F.col("_toks")).otherwise(F.flatten(F.concat(parts, F.array(tail)))))
    return both.withColumn(text_col, joined).drop("_new", "_toks")


def regroup_tokens(tokens: DataFrame, id_col: str = "msg_id", out_col: str = "message") -> DataFrame:
    """Tokens back to one string per message, in position order, with the other
    columns. Equal rows make one group and are written out again as often as they were."""
    keys = [c for c in tokens.columns if c not in ("pos", "tok")]
    others = [c for c in keys if c not in (id_col, "_row")]
    # each position comes once per equal row, with the same token
    listed = F.sort_array(F.collect_list(F.when(F.col("tok").isNotNull(), F.struct(F.col("pos"), F.col("tok")))))
    copies = F.count_if(F.coalesce("pos", F.lit(0)) == 0).cast("int")
    grouped = tokens.groupBy(*keys).agg(listed.alias("_listed"), copies.alias("_copies"))
    once = F.when(F.col("_copies") > 1, F.filter("_listed", lambda s, i: i % F.col("_copies") == 0)).otherwise(F.col("_listed"))
    return (grouped.withColumn("_toks", once).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
            .select(id_col, *others, F.array_join(F.col("_toks.tok"), " ").alias(out_col)))


def text_preprocessor(df: DataFrame, lemmas: DataFrame | None = None, stems: DataFrame | None = None,
                      text_col: str = "message", id_col: str = "msg_id") -> DataFrame:
    """C11 on already cleaned text: tokens -> lemma (C9) -> stem (C10) -> join.

    Without tables this is a narrow projection (C8 only). Other columns of
    ``df`` are kept."""
    if lemmas is None and stems is None:
        return df.withColumn(text_col, T.join_tokens(T.whitespace_tokens(F.col(text_col))))
    tables = [changes(t, name) for t, name in ((lemmas, "lemma"), (stems, "stem")) if t is not None]
    out = replace_words(numbered(df), composed(*tables) if len(tables) == 2 else tables[0], text_col)
    return _as_it_was(out, df, text_col, id_col)


def _as_it_was(out: DataFrame, df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """The columns that the lookups return: the id, the others, the text; null is no token."""
    others = [c for c in df.columns if c not in (id_col, text_col)]
    return out.select(id_col, *others, F.coalesce(text_col, F.lit("")).alias(text_col))


def porter_stem_tokens(df: DataFrame, text_col: str = "message", id_col: str = "msg_id",
                       mode: str = "library", lemmas: DataFrame | None = None) -> DataFrame:
    """C10 as the reference runs it: every token Porter-stemmed (after the
    optional lemma lookup, C11 order). The stem table is built from the
    distinct tokens of ``df`` itself (one projection chain per distinct word),
    then joined back like any supplied table.

    The stem table is written once: it is vocabulary-sized, and without the
    cut the optimizer pushes the lookup's ``word <> stem`` filter down the
    rule chain, substituting each step's expression into it (the filter then
    grows with the product of the references per step)."""
    out = _porter(numbered(df), text_col, mode, lemmas)
    return _as_it_was(out, df, text_col, id_col)


def _porter(df: DataFrame, text_col: str, mode: str, lemmas: DataFrame | None) -> DataFrame:
    """:func:`porter_stem_tokens` of numbered rows."""
    counts = shared_table(row_tokens(df, text_col).groupBy("tok").agg(F.count("*").alias("n")), "word_counts")
    words, first = counts.select(F.col("tok").alias("word")), None
    if lemmas is not None:
        first = changes(lemmas, "lemma")
        words = words.unionByName(first.select(F.col("_v").alias("word")))
    table = changes(shared_table(porter_stems(words, mode=mode), "stems"), "stem", unique=True)
    return replace_words(df, composed(first, table) if lemmas is not None else table, text_col, counts)


def normalise_texts(df: DataFrame, text_col: str, lemmas: DataFrame | None = None, stem: bool = False,
                    mode: str = "library") -> DataFrame:
    """Lemma lookup and/or Porter stems on ``text_col`` without a row id (ML
    pipelines): rows are numbered as they are written, and only that number goes with the tokens."""
    if lemmas is None and not stem:
        return df
    rows = numbered(df)
    done = _porter(rows, text_col, mode, lemmas) if stem else replace_words(rows, changes(lemmas, "lemma"), text_col)
    return done.select(*df.columns)
