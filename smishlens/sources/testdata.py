"""Adapters from the provided parquet tables to the message schemas.

Every adapter reads the given tables (or data Spark derives from them), so the
work of each query grows with the tables. Their SQL twins live in
``smishlens.oracles`` and must stay in step with this file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.session import shared_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a ``labels`` row; spam iff toxic = 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (docs.join(labels, "doc_id")
            .select(F.col("doc_id").alias("msg_id"), F.col("text").alias("message"),
                    F.when(F.col("toxic") == 1, "spam").otherwise("ham").alias("label")))


def messages_es(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``; spam iff the document is Spanish (a learnable target)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("msg_id"), F.col("text").alias("message"),
                       F.when(F.col("lang") == "es", "spam").otherwise("ham").alias("label"))


def url_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short messages around each page URL; the upper-cased copy is no URL
    (the pattern is case-sensitive)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select(
        F.col("page_id").alias("msg_id"),
        F.concat(F.lit("Win "), F.col("url"), F.lit(", now: www.x.y ok "), F.upper("url")).alias("message"),
        F.when(F.col("url").startswith("http://"), "spam").otherwise("ham").alias("label"))


def threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reputation list derived from ``pages`` by URL shape, with overlapping
    listings and one type that does not count."""
    pages = table(spark, sf_dir, "pages").select("url")
    malware = pages.filter(F.col("url").startswith("http://") & F.col("url").contains("/fr/")) \
        .withColumn("threat_type", F.lit("MALWARE"))
    social = pages.filter(F.col("url").contains("/fr/") | F.col("url").contains("/de/")) \
        .withColumn("threat_type", F.lit("SOCIAL_ENGINEERING"))
    unwanted = pages.filter(F.col("url").contains("/es/")) \
        .withColumn("threat_type", F.lit("UNWANTED_SOFTWARE"))
    return malware.unionByName(social).unionByName(unwanted)


def spelt_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page URLs as they are, in upper case, with a user and a port, with escapes and detours in the
    path, and with doubled slashes and a fragment, by page."""
    def spelt(pattern: str, to: str):
        return F.regexp_replace("url", pattern, to)

    by = F.col("page_id") % 5
    whole = r"^(https?)://([^/]+)/([^/]*)/(.*)$"
    return table(spark, sf_dir, "pages").select(
        F.when(by == 0, F.col("url"))
        .when(by == 1, F.concat(F.upper(F.regexp_extract("url", "^(https?://[^/]+)", 1)), spelt("^https?://[^/]+", "")))
        .when(by == 2, spelt(whole, "$1://user:pass@$2.:8080/$3/$4"))
        .when(by == 3, spelt(whole, "$1://$2/%2e/x/../%25%33%37%2F..%2f$3/$4")).otherwise(spelt(whole, "$1://$2//$3//$4#frag#ment")).alias("url"))


def listed_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reputation list ``(expression, threat_type)``: folders, hosts without their first label, whole URLs, by page."""
    pages = table(spark, sf_dir, "pages")
    host, path = F.regexp_extract("url", "^https?://([^/]+)", 1), F.regexp_replace("url", "^https?://[^/]+|#.*$", "")
    folder = F.regexp_extract("url", "^https?://([^/]+/[^/]+/)", 1)
    above = F.when(F.size(F.split(host, r"\.")) > 3, F.regexp_replace(host, r"^[^.]+\.", "")).otherwise(host)
    lists = [("MALWARE", 13, folder), ("SOCIAL_ENGINEERING", 17, F.concat(above, F.lit("/"))), ("UNWANTED_SOFTWARE", 3, F.concat(host, path))]
    rows = [pages.filter(F.col("page_id") % every == 0).select(expression.alias("expression"), F.lit(kind).alias("threat_type"))
            for kind, every, expression in lists]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _spelt(valid_only: bool):
    toxic = F.col("toxic") == 1
    spelt = (F.when(F.col("lang") == "en", F.when(toxic, " SPAM ").otherwise("Ham"))
             .when(F.col("lang") == "es", F.when(toxic, "1").otherwise("0"))
             .when(F.col("lang") == "fr", F.when(toxic, "spam").otherwise("ham"))
             .otherwise(F.when(toxic, "\t1 ").otherwise(" 0")))
    if valid_only:
        return spelt
    return F.when((F.col("lang") == "de") & (F.col("quality") == 0), "unsure").otherwise(spelt)


def labels_spelt(spark: SparkSession, sf_dir: str, valid_only: bool = True) -> DataFrame:
    """``labels`` with the label spelt in the mixed styles the loaders accept
    (style by document language); ``valid_only=False`` adds unknown values."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels")
    return (labels.join(docs, "doc_id")
            .select(F.col("doc_id").alias("msg_id"), _spelt(valid_only).alias("label")))


def labels_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A numeric label column with fractions (0, 0.5, 1, 1.5)."""
    labels = table(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").alias("msg_id"),
                         (F.col("toxic").cast("double") + F.col("quality") * F.lit(0.5)).alias("label"))


def translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A translation table for all Spanish and English documents: es->en reverses
    the text, en->es of that gives it back in lower and in upper case (two
    candidates), en->es of English text reverses it or gives it back as it is."""
    docs = table(spark, sf_dir, "documents").select("text", "lang").filter(F.col("lang").isin("es", "en"))
    text, es = F.col("text"), F.col("lang") == "es"

    def entry(src: str, tgt: str, text_in, text_out):
        return F.struct(F.lit(src).alias("src_lang"), F.lit(tgt).alias("tgt_lang"),
                        text_in.alias("text_in"), text_out.alias("text_out"))

    spanish = F.array(entry("es", "en", text, F.reverse(text)), entry("en", "es", F.reverse(text), F.lower(text)),
                      entry("en", "es", F.reverse(text), F.upper(text)))
    english = F.array(entry("en", "es", text, F.reverse(text)), entry("en", "es", text, text))
    return docs.select(F.explode(F.when(es, spanish).otherwise(english)).alias("e")).select("e.*").distinct()


def lang_messages(spark: SparkSession, sf_dir: str, lang: str) -> DataFrame:
    """One language's labelled messages (the per-language CSV files)."""
    docs = table(spark, sf_dir, "documents").filter(F.col("lang") == lang).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (docs.join(labels, "doc_id")
            .select(F.col("doc_id").alias("msg_id"), F.col("text").alias("message"),
                    F.when(F.col("toxic") == 1, "spam").otherwise("ham").alias("label")))


def source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, msg_id, label)`` of all labelled documents; the source is their language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (docs.join(labels, "doc_id")
            .select(F.col("lang").alias("source"), F.col("doc_id").alias("msg_id"),
                    F.when(F.col("toxic") == 1, "spam").otherwise("ham").alias("label")))


def corpus_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct vectoriser tokens of the cleaned documents."""
    docs = table(spark, sf_dir, "documents").select("text")
    marked = F.when(T.may_have_url(F.col("text")), F.regexp_replace("text", T.URL_PATTERN, T.URL_TRUSTED_TOKEN)).otherwise(F.col("text"))
    # cleaned in a projection of its own: a text is cleaned once, and the tokens read a column
    cleaned = T.clean_after_urls(F.col("marked"))
    docs = docs.select(marked.alias("marked"))
    words = docs.select(F.explode_outer(T.vectorizer_tokens(cleaned)).alias("word"))
    return words.filter(F.col("word").isNotNull()).distinct()


def lemmas(spark: SparkSession, sf_dir: str, words: DataFrame | None = None) -> DataFrame:
    """A lemma table over the corpus words: plural-looking words lose trailing s."""
    words = corpus_words(spark, sf_dir) if words is None else words
    return (words.filter(F.col("word").endswith("s") & (F.length("word") > 3))
            .select("word", F.rtrim(F.col("word"), F.lit("s")).alias("lemma")))


def noun_lexicon(spark: SparkSession, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(lexicon, exceptions)`` over the corpus words: the lexicon has the words whose MD5 starts with a low digit, without one
    of the endings of each that has any; the exception list sends words of odd length in ``en`` to their first letters."""
    bare = F.regexp_replace("word", "(ses|ves|xes|zes|ches|shes|men|ies|ss|s)$", "")
    lexicon = words.select(F.explode(F.array(F.col("word"), bare, F.concat(bare, F.lit("y")), F.concat(bare, F.lit("man")))).alias("word")) \
        .filter((F.length("word") > 1) & (F.substring(F.md5("word"), 1, 1) < "8")).distinct()
    odd = words.filter(F.col("word").endswith("en") & (F.length("word") % 2 == 1))
    return lexicon, odd.select("word", F.explode(F.array(F.expr("left(word, 2)"), F.expr("left(word, length(word) - 2)"))).alias("lemma"))


def stems(spark: SparkSession, sf_dir: str, words: DataFrame | None = None) -> DataFrame:
    """A stem table over the corpus words: -ing / -ed endings removed."""
    words = corpus_words(spark, sf_dir) if words is None else words
    return (words.filter(F.col("word").rlike("(ing|ed)$") & (F.length("word") > 5))
            .select("word", F.regexp_replace("word", "(ing|ed)$", "").alias("stem")))


def word_tables(spark: SparkSession, sf_dir: str, cleaned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lemmas, stems)`` over the corpus words, or over those of a cleaned table at hand."""
    if cleaned is None:
        words = corpus_words(spark, sf_dir)
    else:
        words = cleaned.select(F.explode_outer(T.vectorizer_tokens(F.col("message"))).alias("word")) \
            .filter(F.col("word").isNotNull()).distinct()
    words = shared_table(words, "words")
    return lemmas(spark, sf_dir, words), stems(spark, sf_dir, words)


def blocked_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block list: users who raised a large error event (``sender``)."""
    ev = table(spark, sf_dir, "events")
    return (ev.filter((F.col("event_type") == "error") & (F.col("value") >= 300))
            .select(F.col("user_id").alias("sender")).distinct())


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User feedback: click events label the user's message spam when value > 100."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    return ev.select(F.col("user_id").alias("msg_id"), F.when(F.col("value") > 100, 1).otherwise(0).alias("label"),
                     "ts", "event_id")


def as_pattern(path: str) -> str:
    """A path as a pattern that matches just it: a file stream takes a pattern for
    a single file as well as for a folder."""
    return f"{path[:-1]}[{path[-1]}]"


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a file stream, event time cast for watermarks."""
    from smishlens.streaming.feeds import read_file_stream, with_event_time
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return with_event_time(read_file_stream(spark, as_pattern(f"{sf_dir}/events.parquet"), schema))


def message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet table of documents as a stream of messages; spam iff Spanish."""
    from smishlens.streaming.feeds import read_file_stream
    docs = read_file_stream(spark, as_pattern(path), spark.read.parquet(path).schema, max_files)
    return docs.select(F.col("doc_id").alias("msg_id"), F.col("text").alias("message"),
                       F.when(F.col("lang") == "es", "spam").otherwise("ham").alias("label"))
