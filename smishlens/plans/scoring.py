"""Batch scoring with a user-supplied sequence classifier (inventory H11).

The reference loads a model once and scores lists of texts in slices of 64
(truncated to 128 tokens). Here the model comes from a factory that Spark
calls once per Python worker (``predict_batch_udf``); texts travel in Arrow
batches of ``batch_size`` rows and every row keeps its id, so no order has to
be preserved. Weights and tokenisers are the user's (not part of this repo).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed value: the reference's scoring batch.
BATCH_SIZE = 64


def length_model_factory() -> Callable[[np.ndarray], np.ndarray]:
    """A NumPy stand-in classifier: ``p = sigmoid(0.01 * len(text) - 2)``.
    Used by tests and the registered query; real use passes a factory that
    loads a fine-tuned model."""
    def predict(texts: np.ndarray) -> np.ndarray:
        lengths = np.fromiter((len(t) for t in texts), dtype=np.float64, count=len(texts))
        return 1.0 / (1.0 + np.exp(-(0.01 * lengths - 2.0)))
    return predict


def batch_scorer(make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
                 batch_size: int = BATCH_SIZE):
    """A Column function ``text -> p`` backed by Arrow batches."""
    return predict_batch_udf(make_predict_fn, return_type=DoubleType(), batch_size=batch_size)


def score_texts(df: DataFrame, make_predict_fn, text_col: str = "message", out_col: str = "p",
                batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add the class-1 probability of every text."""
    scorer = batch_scorer(make_predict_fn, batch_size)
    return df.withColumn(out_col, scorer(F.col(text_col)))
