"""Label mapping (inventory B4-B7) as one Column expression.

Modes:
  ``strict``  (B4/B5): strings lower-cased and stripped; ``spam``/``1`` -> 1,
              ``ham``/``0`` -> 0, anything else fails the query (``raise_error``).
  ``lenient`` (B6):   the same mapping, unknown values -> NULL.
  ``numeric`` (B7):   numeric column, truncated towards zero, kept if 0/1, else
              fails; string columns follow ``strict``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

# Label spellings accepted by the reference.
POSITIVE_LABELS = ("spam", "1")
NEGATIVE_LABELS = ("ham", "0")

# Python's str.strip() removes Unicode whitespace; Spark's trim only blanks.
_UNICODE_STRIP = r"(?U)^\s+|\s+$"


def normalise_label_text(col: Column) -> Column:
    return F.regexp_replace(F.lower(col.cast("string")), _UNICODE_STRIP, "")


def map_label(col: Column, mode: str = "strict", source_type: DataType | None = None) -> Column:
    """Map a label column to INT 0/1 under the given mode."""
    if mode == "numeric" and isinstance(source_type, NumericType):
        truncated = col.cast("double").cast("int")
        return (F.when(col.isNull(), F.raise_error(F.lit("unknown label: null")))
                .when(truncated.isin(0, 1), truncated)
                .otherwise(F.raise_error(F.concat(F.lit("unknown label: "), col.cast("string")))))
    text = normalise_label_text(col)
    mapped = (F.when(text.isin(*POSITIVE_LABELS), F.lit(1))
              .when(text.isin(*NEGATIVE_LABELS), F.lit(0)))
    if mode == "lenient":
        return mapped.cast("int")
    if mode not in ("strict", "numeric"):
        raise ValueError(f"unknown label mode {mode!r}")
    return mapped.otherwise(
        F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(col.cast("string"), F.lit("null"))))
    ).cast("int")


def map_label_df(df, col_name: str = "label", mode: str = "strict", out_col: str | None = None):
    """DataFrame form: picks the numeric rule from the column's type."""
    src_type = df.schema[col_name].dataType
    return df.withColumn(out_col or col_name, map_label(F.col(col_name), mode, src_type))
