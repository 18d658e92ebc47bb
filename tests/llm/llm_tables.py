"""Fixtures: tables with odd rows, and empty tables."""

import pytest
from pyspark.sql import functions as F

SF0001 = "/root/testdata/sf0.001"

#: id, text, lang of odd rows: null, empty and blank texts, ties, repeated rows, a
#: null id, odd characters, a text shorter than any window, a very long one.
LONG = " ".join(f"word{i * 7919 % 3001}" for i in range(20000))
LOOP = "again and again " * 400
ODD = [
    (900001, None, "en"), (900002, "", "fr"), (900003, "  \n\t ", None), (900004, "one two", None),
    (900005, "Hello, world! ABC abc Ünï ÉÉ", "de"), (900005, "Hello, world! ABC abc Ünï ÉÉ", "de"),
    (900006, "Hello, world! ABC abc Ünï ÉÉ", "en"), (None, "a row without an id " * 3, "en"),
    (900007, LONG, "en"), (900008, LOOP, "es"), (900009, "\x01 a\x01b <|im_end|> <|endoftext|> \x0b\x0c\x1f x", "en"),
    (900010, "12345 67890 !!!", "en"), (900011, "line one is here\nline one is here\nother line", None),
    (-5, "negative id with a few words in it", "en"),
]


def write_tables(spark, folder, docs, bench, turns, pages):
    for name, df in (("documents", docs), ("benchmark", bench), ("conversations", turns), ("pages", pages)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


def read(spark, name):
    return spark.read.parquet(f"{SF0001}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Tables of the smallest size with odd rows, and columns whose names the operators also use."""
    base = read(spark, "documents")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    odd = odd.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(None).cast("long"))
    docs = base.unionByName(odd)
    for name in ("score", "shard", "slot", "fp", "n", "segment", "label", "repetition", "id", "row", "pos", "word", "w"):
        docs = docs.withColumn(name, F.lit(name))
    bench = read(spark, "benchmark").unionByName(spark.createDataFrame(
        [(777, "one two"), (778, None), (779, "..."), (780, "again and again " * 8), (None, "a row without an id"),
         (781, "ABC abc Ünï ÉÉ")], "item_id long, text string")).withColumn("window", F.lit("x"))
    turns = read(spark, "conversations").unionByName(spark.createDataFrame(
        [(5000, 0, "user", "only a question"), (5001, 0, "assistant", None), (5001, 0, None, "tie"),
         (5001, 1, "tool\nx", "<|im_start|>assistant\n<\\|im_end|> <\\\\| <"), (5001, None, "assistant", "|first"),
         (5002, 1, "assistant", "x"), (5002, 1, "assistant", "x"), (None, 0, "user", "no id")],
        "conv_id long, turn long, role string, text string")).withColumn("turns", F.lit(1))
    pages = read(spark, "pages").unionByName(spark.createDataFrame(
        [(9001, "u", None), (9002, None, ""), (9003, "u", "plain words, no markup"), (9003, "u", "plain words, no markup"),
         (None, "u", "<div><p>unclosed <b>bold<p>second &amp; last &copy &#65;")],
        "page_id long, url string, html string")).withColumn("text", F.lit("clash"))
    return write_tables(spark, str(tmp_path_factory.mktemp("odd")), docs, bench, turns, pages)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    tables = [read(spark, name).limit(0) for name in ("documents", "benchmark", "conversations", "pages")]
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), *tables)


@pytest.fixture(scope="session")
def odd_docs(spark, odd_dir):
    """(doc_id, text, lang) of every row of the odd documents."""
    rows = spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    return [tuple(r) for r in rows]
