"""Message preparation (inventory B1-B3, B8, B9, C7, C11).

``clean_text`` runs once per message: the reference cleans twice, but the
second pass is idempotent, so the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.functions.labels import map_label_df
from smishlens.operators.urls import tokenise_urls


def normalise_columns(df: DataFrame, id_col: str | None = "msg_id") -> DataFrame:
    """B1 (message loader): keep ``message`` and ``label`` when both exist, else
    rename the two columns by position to ``label``, ``message``."""
    cols = [c for c in df.columns if c != id_col]
    keep_id = [id_col] if id_col and id_col in df.columns else []
    if "label" in cols and "message" in cols:
        return df.select(*keep_id, "message", "label")
    if len(cols) != 2:
        raise ValueError(f"expected columns 'label' and 'message' or exactly two columns, got {cols}")
    renamed = df.select(*keep_id, F.col(cols[0]).alias("label"), F.col(cols[1]).alias("message"))
    return renamed.select(*keep_id, "message", "label")


def rename_text_column(df: DataFrame) -> DataFrame:
    """B1 (augmentation loader): ``text`` -> ``message``."""
    return df.withColumnRenamed("text", "message") if "text" in df.columns else df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """B2: rows with a null message or label are dropped."""
    return df.na.drop(subset=["message", "label"])


def clean_text(df: DataFrame, threats: DataFrame | None, text_col: str = "message",
               id_col: str = "msg_id", out_col: str | None = None,
               fold_table: dict | None = None) -> DataFrame:
    """URL tokens (join) -> accents -> numbers -> punctuation -> lower/strip."""
    out_col = out_col or text_col
    with_tokens = tokenise_urls(df, threats, text_col, id_col, "_url_text")
    return (with_tokens.withColumn(out_col, T.clean_after_urls(F.col("_url_text"), fold_table))
            .drop("_url_text"))


def drop_blank(df: DataFrame, text_col: str = "message") -> DataFrame:
    """Messages that are empty after cleaning are dropped.

    A filter on a computed column is pushed below the projection that
    computes it, which would run the whole cleaning twice. Passing the text
    through ``explode_outer`` of a one-element array keeps the filter above
    that projection: the text is cleaned once."""
    others = [c for c in df.columns if c != text_col]
    kept = F.filter(F.array(F.col(text_col)), lambda t: ~T.is_blank(t))
    return (df.select(*others, F.explode_outer(kept).alias(text_col))
            .filter(F.col(text_col).isNotNull())
            .select(*df.columns))


def preprocess(df: DataFrame, threats: DataFrame | None, id_col: str = "msg_id",
               label_mode: str = "strict", fold_table: dict | None = None) -> DataFrame:
    """B8 = B4 (label map) -> C7 (clean) -> B3 (drop blank).

    The reference's lemma/stem/language arguments are ignored at this stage."""
    mapped = map_label_df(df, "label", label_mode)
    cleaned = clean_text(mapped, threats, "message", id_col, fold_table=fold_table)
    return drop_blank(cleaned).select(id_col, "message", "label")
