"""Score curves and rank statistics from per-score counts (W-08, M-05, M-11).

A prediction table is reduced to one row per distinct score with positive and
negative counts (partial aggregation), then cumulative counts come from the
distributed prefix machinery, so the curve never needs a global sort of the
predictions and never collects them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import prefix_sums


def score_counts(pred: DataFrame, score: str, label: str, weight: Column | None = None) -> DataFrame:
    """(score, pos, neg, pos_below, neg_below, P, N) per distinct score; ``weight`` is the
    number of predictions that a row stands for (default: 1)."""
    is_pos = (F.col(label) == 1).cast("long")
    n = F.lit(1) if weight is None else weight
    p = prefix_sums(pred.where(F.col(score).isNotNull()), score,
                    {"pos": is_pos * n, "neg": (F.lit(1) - is_pos) * n})
    return p.select(score, "pos", "neg", F.col("pos_before").alias("pos_below"),
                    F.col("neg_before").alias("neg_below"), F.col("pos_total").alias("P"),
                    F.col("neg_total").alias("N"))


def roc_points(pred: DataFrame, score: str, label: str) -> DataFrame:
    """W-08: for each threshold s (predict positive when score >= s): TPR, FPR."""
    c = score_counts(pred, score, label)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return c.select(F.col(score).alias("threshold"),
                    (tp / F.nullif(F.col("P"), F.lit(0))).alias("tpr"),
                    (fp / F.nullif(F.col("N"), F.lit(0))).alias("fpr"))


def pr_points(pred: DataFrame, score: str, label: str) -> DataFrame:
    """M-11: precision and recall at each threshold."""
    c = score_counts(pred, score, label)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return c.select(F.col(score).alias("threshold"),
                    (tp / F.nullif(tp + fp, F.lit(0))).alias("precision"),
                    (tp / F.nullif(F.col("P"), F.lit(0))).alias("recall"))


def auc(pred: DataFrame, score: str, label: str, weight: Column | None = None) -> DataFrame:
    """M-05: ROC AUC by rank sum with ties averaged (Mann-Whitney):
    sum over scores of pos * (negatives below + negatives tied / 2) / (P N).
    All scores equal -> 0.5; perfect ranking -> 1.0. A row counts ``weight`` times (default: once)."""
    c = score_counts(pred, score, label, weight)
    num = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    # Undefined (null) when one class is absent, rather than a division error.
    return c.agg((num / F.nullif((F.max("P") * F.max("N")).cast("double"), F.lit(0.0))).alias("auc"))

