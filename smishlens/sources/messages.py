"""CSV sources and sinks for labelled messages (inventory A1-A4, D3 output).

CSV with quoted multi-line text is not splittable (one task per file), so the
intended flow is: read the CSV once, derive ids, write Parquet, work from that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smishlens.operators.preprocess import drop_incomplete, normalise_columns

# Strings the reference's CSV reader treats as missing.
NULL_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_csv_plain(spark: SparkSession, path: str, null_markers=NULL_MARKERS) -> DataFrame:
    """A2: every column as STRING; the null markers become NULL; nothing dropped."""
    df = spark.read.options(**CSV_OPTIONS).csv(path)  # no inference: all STRING
    return df.select(*[F.when(F.col(c).isin(*null_markers), F.lit(None)).otherwise(F.col(c)).alias(c)
                       for c in df.columns])


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """A3: fail before any action when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"the CSV must contain the columns {list(cols)}; missing {missing}")
    return df


def with_message_ids(df: DataFrame, id_col: str = "msg_id", file_col: str = "_file") -> DataFrame:
    """Ids for CSV rows: file name, md5 of label and message, occurrence number.

    Rows equal in all of these are counted and written out again with their
    numbers, so ids depend on the files' content only, not on how a file is read."""
    content = F.md5(F.to_json(F.struct("label", "message")))
    counted = df.groupBy(file_col, "label", "message").agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return numbered.select(F.concat_ws("#", file_col, content, F.col("_k").cast("string")).alias(id_col),
                           "message", "label")


def read_messages(spark: SparkSession, path: str, null_markers=NULL_MARKERS, with_ids: bool = True) -> DataFrame:
    """A1 + B1 + B2: the message loader."""
    df = read_csv_plain(spark, path, null_markers)
    if not with_ids:
        return drop_incomplete(normalise_columns(df, id_col=None))
    named = df.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return with_message_ids(drop_incomplete(normalise_columns(named, id_col="_file")))


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A4: CSV with header into a directory (one file per task)."""
    w = df.write.mode("overwrite").options(**CSV_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def save_split(df: DataFrame, path: str, source_col: str = "source", split_col: str = "split") -> None:
    """D3 output: every source's train and test part in one pass,
    ``{path}/source=<s>/split=<train|test>/``."""
    write_csv(df, path, [source_col, split_col])
