"""Corpus pipeline over ``documents``: quality rules, language ID, SimHash
near-dedup, benchmark decontamination, packing.

Every stage is a function of (session, docs, data folder) that returns a
DataFrame. :func:`run` writes each result as Parquet into the shared folder and
reads it back as the next stage's input, so a lost executor costs one stage at
most. All stages but the last return the columns of their input, whatever further
columns there are; rows with null or empty text end in the first stage, and an
empty table stays empty through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smishlens.llm import decontaminate, langid, packing, quality, simhash
from smishlens.llm.tokens import vocabulary_path
from smishlens.session import shared_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score above the calibrated limit, by
    a model trained on the labelled documents of this stage's input."""
    return langid.keep_known(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), action="drop")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document's tokens with its sequence and offset."""
    cut = packing.pieces(docs, vocabulary_path(), end_id=2)
    rows = cut.select("piece", F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(rows).drop("piece")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Suffix arrays, the classifier, XXH64 and the tokenizer are not SQL; the
#: pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
