"""Evaluation metrics as single aggregates over prediction tables (M-01 .. M-09).

Every metric reads the prediction table once; the reference's four separate
COUNT queries (each re-running the model) become one conditional aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   positive=1) -> DataFrame:
    """M-01: TP, TN, FP, FN, accuracy, recall, precision, F1 (0 when undefined)."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    c = pred.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & ~p).alias("tn"),
                 F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))
    tp, tn, fp, fn = (F.col(k) for k in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    acc = F.when(n > 0, (tp + tn) / n).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    out = c.select("tp", "tn", "fp", "fn", acc.alias("accuracy"), rec.alias("recall"),
                   prec.alias("precision"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
          .otherwise(F.lit(0.0))
    return out.withColumn("f1", f1)


def per_class_report(pred: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """M-02: per class precision, recall, F1 and support (argument order is
    (true, predicted) throughout)."""
    pairs = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")) \
                .agg(F.count(F.lit(1)).alias("n"))
    tp = pairs.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = pairs.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    pcount = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    x = sup.join(pcount, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    x = x.select("cls", prec.alias("precision"), rec.alias("recall"),
                 F.col("support").cast("long").alias("support"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
          .otherwise(F.lit(0.0))
    return x.withColumn("f1", f1)


def weighted_f1(report: DataFrame) -> DataFrame:
    """Support-weighted mean F1 of a per-class report."""
    return report.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence | None = None) -> DataFrame:
    """M-03: counts for every (label, prediction) pair over the class list, zeros
    included. The class list is the given one or the union of labels and
    predictions; pairs come from a generator on one row, not from a join."""
    counts = pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
                 .agg(F.count(F.lit(1)).alias("n"))
    if classes is not None:
        cls = pred.sparkSession.range(1).select(F.array(*[F.lit(c) for c in classes]).alias("c"))
    else:
        cls = pred.agg(F.array_sort(F.array_union(F.collect_set(label), F.collect_set(prediction)))
                       .alias("c"))
    grid = cls.select(F.explode("c").alias("label"), "c").select("label", F.explode("c").alias("prediction"))
    return grid.join(counts, ["label", "prediction"], "left").fillna(0, ["n"])


def most_confused(matrix: DataFrame) -> DataFrame:
    """M-04: the off-diagonal pair with the largest count (ties: smallest label,
    then smallest prediction)."""
    off = matrix.where(F.col("label") != F.col("prediction"))
    return off.agg(F.min_by(F.struct("label", "prediction", "n"),
                            F.struct(-F.col("n"), F.col("label"), F.col("prediction")))
                   .alias("m")).select("m.*")


def calibration(pred: DataFrame, edges: Sequence[float], prob: str = "max_posterior",
                label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M-06: bucket i holds rows with edges[i-1] < p <= edges[i] (edges[-1] = 0);
    total, correct and accuracy per bucket, empty buckets kept with zeros."""
    edges = list(edges)
    b = F.lit(-1)  # outside all buckets; dropped by the join with the bucket table
    for i in reversed(range(len(edges))):
        lo = edges[i - 1] if i > 0 else 0.0
        b = F.when((F.col(prob) > lo) & (F.col(prob) <= edges[i]), F.lit(i)).otherwise(b)
    counts = pred.select(b.alias("bucket"), (F.col(label) == F.col(prediction)).alias("ok")) \
                 .groupBy("bucket").agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("correct"))
    spark = pred.sparkSession
    table = spark.createDataFrame([(i, float(edges[i - 1]) if i else 0.0, float(edges[i]))
                                   for i in range(len(edges))], "bucket int, lo double, hi double")
    out = table.join(counts, "bucket", "left").fillna(0, ["total", "correct"])
    return out.withColumn("accuracy", F.when(F.col("total") > 0, F.col("correct") / F.col("total"))
                          .otherwise(F.lit(0.0)))


def mean_by_param(scores: DataFrame, params: Sequence[str], score: str) -> DataFrame:
    """M-09: mean score per parameter setting and a flag on the best one
    (ties: the first setting in parameter order)."""
    m = scores.groupBy(*params).agg(F.avg(score).alias("mean_score"))
    w = Window.orderBy(F.col("mean_score").desc(), *params)
    return m.withColumn("is_best", (F.row_number().over(w) == 1).cast("int"))


def comparison_table(rows: dict[str, DataFrame]) -> DataFrame:
    """M-08: one metrics row per named model, stacked by column name."""
    out = None
    for name, frame in rows.items():
        r = frame.withColumn("model", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out
