"""Score and decision columns (inventory H10, H12, H13, L4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax_positive(l0: Column, l1: Column) -> Column:
    """Probability of class 1 from two logits, ``exp(l1)/(exp(l0)+exp(l1))``,
    written as ``1/(1+exp(l0-l1))`` so large logits do not overflow."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(l0 - l1))


def argmax2(l0: Column, l1: Column) -> Column:
    """Argmax over two logits; a tie goes to class 0."""
    return F.when(l1 > l0, F.lit(1)).otherwise(F.lit(0))


def threshold_decision(p: Column, threshold: float = 0.5, inclusive: bool = True) -> Column:
    """``p >= t`` (sequence classifier, stored production threshold) or
    ``p > t`` (classic ``predict`` at 0.5)."""
    hit = p >= F.lit(threshold) if inclusive else p > F.lit(threshold)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


# Verdict names of the three-way outcome.
VERDICTS = ("legit", "possible_spam", "fraud")


def verdict(p: Column, possible_at: float, fraud_at: float) -> Column:
    """L4: three-way verdict with two cut-offs (both inclusive)."""
    if not possible_at <= fraud_at:
        raise ValueError("possible_at must not exceed fraud_at")
    return (F.when(p >= F.lit(fraud_at), F.lit(VERDICTS[2]))
            .when(p >= F.lit(possible_at), F.lit(VERDICTS[1]))
            .otherwise(F.lit(VERDICTS[0])))
