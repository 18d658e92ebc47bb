"""Lemmas by detachment rules (inventory C9).

A word's lemma is the shortest of its candidates that the lexicon knows. Candidates are the
word itself and what the detachment rules make of its ending; while none of them is known, the
rules are applied again to what they made. A word that the exception list names has the list's forms as
its candidates instead, and no rules. A word without a known candidate stays as it is. The lexicon (nouns,
as the lemmatiser's default is) and the exception list are tables of the user; none is bundled.

The work is done once per distinct word: candidates are rows, a lexicon lookup is a
semi-join on the candidate, and a word drops out as soon as one is found, so the number of
rounds is that of the longest chain of endings among words without a lemma.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.session import drop_table, shared_table

# The noun endings and what replaces them, in order.
NOUN_ENDINGS = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))


def detached(form: Column, endings: tuple[tuple[str, str], ...] = NOUN_ENDINGS) -> Column:
    """The array of (order, form) that the rules make of a form."""
    made = [F.when(F.endswith(form, F.lit(old)), F.struct(F.lit(k).alias("rule"), F.concat(
        F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)).alias("form"))) for k, (old, new) in enumerate(endings, 1)]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def _known(candidates: DataFrame, lexicon: DataFrame) -> DataFrame:
    return candidates.join(lexicon, candidates["form"] == lexicon["_known"], "left_semi")


def lemma_table(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None,
                endings: tuple[tuple[str, str], ...] = NOUN_ENDINGS) -> DataFrame:
    """``(word, lemma)`` of the distinct words of ``words`` (word) of which a candidate is known.

    ``lexicon``: (word). ``exceptions``: (word, lemma), several rows per word allowed; among candidates of one length the
    word itself comes first, then those of the list by name, or those of the rules in their order."""
    words = shared_table(words.select("word").filter("word is not null").distinct(), "lemma_words")
    lexicon = lexicon.select(F.col("word").alias("_known")).filter("_known is not null").distinct()
    ordinary, found = words, []
    own = F.array(F.struct(F.lit("").alias("order"), F.col("word").alias("form")))

    def best(candidates: DataFrame) -> DataFrame:
        return candidates.groupBy("word").agg(F.min(F.struct(F.length("form"), "order", "form")).alias("b")).select("word", F.col("b.form").alias("lemma"))

    if exceptions is not None:
        listed = exceptions.filter("word is not null and lemma is not null").groupBy("word").agg(F.collect_set("lemma").alias("_forms"))
        named = words.join(listed, "word")
        forms = F.transform(F.array_sort("_forms"), lambda f: F.struct(f.alias("order"), f.alias("form")))
        named = named.select("word", F.explode(F.concat(own, forms)).alias("c")).select("word", "c.*")
        found.append(best(_known(named, lexicon)))
        ordinary = words.join(listed, "word", "left_anti")

    def made(form: Column, order: Column) -> Column:
        # chains of rules are ordered rule by rule
        return F.transform(detached(form, endings), lambda x: F.struct(
            F.concat(order, F.lpad(x["rule"].cast("string"), 2, "0")).alias("order"), x["form"].alias("form")))

    rows = ordinary.select("word", F.explode(F.concat(own, made(F.col("word"), F.lit("")))).alias("c")).select("word", "c.*")
    candidates, fresh = shared_table(rows, "lemma_candidates"), None
    while True:
        hit = shared_table(best(_known(candidates, lexicon)), "lemmas")
        found.append(hit)
        # only what the rules made, of words without a lemma, is taken apart again
        left = candidates.filter("order != ''").join(hit, "word", "left_anti")
        rows = left.select("word", F.explode(made(F.col("form"), F.col("order"))).alias("c")).select("word", "c.*")
        fresh = shared_table(rows, "lemma_candidates")
        drop_table(candidates)
        candidates = fresh
        if candidates.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)
