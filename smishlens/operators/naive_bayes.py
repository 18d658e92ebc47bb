"""Multinomial naive Bayes on TF-IDF weights, in SQL form (inventory H1).

Fit: per term, the summed normalised weights of each class (conditional sums
in one aggregation, no class x term product), smoothed with alpha = 1:
``log_prob[c, t] = ln((fc[c, t] + 1) / (sum_t fc[c, t] + V))``; unsmoothed
prior ``ln(n_c / n)``.

Predict: per message ``jll_c = prior_c + sum_t w_t * log_prob[c, t]`` with
``w`` the unit-length TF-IDF vector. Since the norm is a per-message scalar,
``sum_t w_t lp_t = (sum_t tf idf lp_t) / sqrt(sum_t (tf idf)^2)``: both sums
come out of a single partial aggregation after the broadcast join, so only
one small row per message is shuffled and no join back is needed. Messages
without a known term score their prior. Rows are regrouped by their number, so
rows that share an id are scored apart.

A model of no rows knows the labels 0 and 1 and gives both the same odds; without rows to
predict there are no predictions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smishlens.operators.tfidf import ROW, TfidfModel, counted, term_counts
from smishlens.session import shared_table


#: Labels of a model that was fitted on no rows.
NO_ROWS = (0, 1)


@dataclass
class NaiveBayesModel:
    tfidf: TfidfModel
    classes: list[int]
    log_prior: dict[int, float]
    table: DataFrame  # term, idf, lp_<c> for each class (at most max_features rows)

    def log_probs_long(self) -> DataFrame:
        """``(label, term, log_prob)`` for every class and vocabulary term."""
        parts = [self.table.select(F.lit(c).cast("bigint").alias("label"), "term",
                                   F.col(f"lp_{c}").alias("log_prob")) for c in self.classes]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def joint_log_likelihood(self, df: DataFrame, id_col: str = "msg_id", text_col: str = "message",
                             keep: list[str] | None = None) -> DataFrame:
        keep = keep or []
        counts = term_counts(counted(df, id_col, text_col, keep), id_col, text_col, [ROW, *keep], outer=True)
        joined = counts.join(self.tfidf.bounded(self.table), "term", "left")
        w = F.col("tf") * F.col("idf")
        sums = [F.sum(w * w).alias("_s2")] + [F.sum(w * F.col(f"lp_{c}")).alias(f"_s_{c}") for c in self.classes]
        per_doc = joined.groupBy(ROW).agg(*[F.first(c).alias(c) for c in (id_col, *keep)], *sums)
        norm = F.sqrt(F.col("_s2"))
        jll = [(F.lit(self.log_prior[c]) + F.coalesce(F.col(f"_s_{c}") / norm, F.lit(0.0))).alias(f"jll_{c}")
               for c in self.classes]
        return per_doc.select(id_col, *keep, *jll)

    def predict(self, df: DataFrame, id_col: str = "msg_id", text_col: str = "message",
                keep: list[str] | None = None) -> DataFrame:
        """``(id, keep..., p, prediction)``: p = probability of the last class
        (class 1 for 0/1 labels); prediction = argmax, first class on ties."""
        jll = self.joint_log_likelihood(df, id_col, text_col, keep)
        top = F.greatest(*[F.col(f"jll_{c}") for c in self.classes]) if len(self.classes) > 1 \
            else F.col(f"jll_{self.classes[0]}")
        denom = sum((F.exp(F.col(f"jll_{c}") - top) for c in self.classes), F.lit(0.0))
        pos = self.classes[-1]
        p = F.exp(F.col(f"jll_{pos}") - top) / denom
        pred = None
        for c in reversed(self.classes):
            hit = F.col(f"jll_{c}") == top
            pred = F.when(hit, F.lit(c)) if pred is None else F.when(hit, F.lit(c)).otherwise(pred)
        keep = keep or []
        return jll.select(id_col, *keep, p.alias("p"), pred.alias("prediction"))


def fit_naive_bayes(tfidf: TfidfModel, train: DataFrame, id_col: str = "msg_id",
                    text_col: str = "message", label_col: str = "label", alpha: float = 1.0) -> NaiveBayesModel:
    class_rows = train.groupBy(label_col).count().orderBy(label_col).collect()  # one row per class
    sizes = {int(r[0]): int(r[1]) for r in class_rows} or dict.fromkeys(NO_ROWS, 1)
    classes, n = list(sizes), sum(sizes.values())
    log_prior = {c: math.log(size) - math.log(n) for c, size in sizes.items()}
    long = tfidf.transform_long(train, id_col, text_col, keep=[label_col])
    fc = (long.groupBy("term")
          .agg(*[F.sum(F.when(F.col(label_col) == c, F.col("tfidf"))).alias(f"fc_{c}") for c in classes]))
    vocab = tfidf.vocabulary.select("term", "idf")
    # fc has one row per vocabulary term at most: bounded by max_features.
    wide = vocab.join(tfidf.bounded(fc), "term", "left").fillna(0.0, subset=[f"fc_{c}" for c in classes])
    # Read twice (class totals, then the table): at most max_features rows.
    wide = shared_table(wide, "class_weights")
    totals = wide.agg(*[F.sum(f"fc_{c}").alias(f"t_{c}") for c in classes], F.count(F.lit(1)).alias("v")).first()
    v = int(totals["v"])
    table = wide.select("term", "idf", *[
        F.log((F.col(f"fc_{c}") + F.lit(alpha)) / F.lit(float(totals[f"t_{c}"] or 0.0) + alpha * max(v, 1))).alias(f"lp_{c}")
        for c in classes])
    table = shared_table(table, "naive_bayes")
    return NaiveBayesModel(tfidf, classes, log_prior, table)
