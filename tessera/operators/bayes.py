"""Naive Bayes classifiers as aggregates + a scalar model (L-07 .. L-10).

Training is a grouped aggregate over the long (row, feature) form, so it
combines map-side and never holds a class on one task. The fitted model is
tiny (classes x features); it is assembled into one array column by an
aggregate and attached to the rows to score as a scalar subquery, so scoring is
a projection with higher-order functions: no join of rows with classes, no
collect to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.text import join_terms
from tessera.session import cut_lineage


def _long_form(df: DataFrame, vector: str, label: str) -> DataFrame:
    return df.select(F.col(label).alias("label"),
                     F.posexplode(F.col(vector)).alias("idx", "x"))


def _ordered_values(field: str) -> Column:
    """Array of ``field`` ordered by feature index from collect_list(struct(idx, ...))."""
    return F.transform(F.array_sort(F.collect_list(F.struct("idx", field))), lambda s: s[field])


def _attach(df: DataFrame, model: DataFrame) -> DataFrame:
    return df.withColumn("_model", model.select("classes").scalar())


def _pick(scores: Column) -> Column:
    """Arg-max over class scores; ties go to the smallest label."""
    top = F.array_max(F.transform(scores, lambda s: s["jll"]))
    best = F.filter(scores, lambda s: s["jll"] == top)
    return F.array_min(F.transform(best, lambda s: s["label"])).alias("prediction")


def _max_posterior(scores: Column) -> Column:
    top = F.array_max(F.transform(scores, lambda s: s["jll"]))
    z = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s["jll"] - top))
    return (F.lit(1.0) / z).alias("max_posterior")


def _posteriors(scores: Column) -> Column:
    top = F.array_max(F.transform(scores, lambda s: s["jll"]))
    z = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s["jll"] - top))
    return F.transform(scores, lambda s: F.struct(s["label"].alias("label"),
                                                  (F.exp(s["jll"] - top) / z).alias("p")))


# ---------------------------------------------------------------- Bernoulli


def fit_bernoulli_nb(train: DataFrame, vector: str, label: str, alpha: float = 1.0,
                     threshold: float = 0.0) -> DataFrame:
    """L-07: one-row model: classes = [(label, prior, lp[], lq[])] with
    lp = log P(x_j = 1 | c) = log((count + alpha) / (n_c + 2 alpha)), lq = log(1 - p)."""
    lf = _long_form(train, vector, label).withColumn("b", (F.col("x") > threshold).cast("double"))
    fc = lf.groupBy("label", "idx").agg(F.sum("b").alias("f"))
    cc = train.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    n = train.select(F.count(F.lit(1))).scalar()
    p = (F.col("f") + alpha) / (F.col("n_c") + 2 * alpha)
    per = fc.join(cc, "label").select("label", "idx", "n_c", F.log(p).alias("lp"),
                                      F.log(1 - p).alias("lq"))
    classes = per.groupBy("label").agg(
        F.first("n_c").alias("n_c"), _ordered_values("lp").alias("lp"),
        _ordered_values("lq").alias("lq"))
    classes = classes.select("label", F.log(F.col("n_c") / n).alias("prior"), "lp", "lq")
    return classes.agg(F.array_sort(F.collect_list(F.struct("label", "prior", "lp", "lq")))
                       .alias("classes"))


def bernoulli_scores(x: Column, threshold: float = 0.0) -> Column:
    def score(m):
        jll = F.aggregate(F.sequence(F.lit(0), F.size(x) - 1), m["prior"],
                          lambda acc, j: acc + F.when(F.get(x, j) > threshold, F.get(m["lp"], j))
                          .otherwise(F.get(m["lq"], j)))
        return F.struct(m["label"].alias("label"), jll.alias("jll"))

    return F.transform(F.col("_model"), score)


def predict_bernoulli_nb(df: DataFrame, model: DataFrame, vector: str,
                         threshold: float = 0.0) -> DataFrame:
    """Prediction, its posterior and all class posteriors."""
    x = _attach(df, model)
    s = bernoulli_scores(F.col(vector), threshold)
    return x.withColumn("_s", s).select(*df.columns, _pick(F.col("_s")),
                                        _max_posterior(F.col("_s")),
                                        _posteriors(F.col("_s")).alias("posteriors"))


def sample_from_bernoulli(model: DataFrame, per_class: int, seed: int) -> DataFrame:
    """L-10: ``per_class`` synthetic 0/1 vectors per class drawn from the fitted
    feature probabilities (one generator row per sample, no join)."""
    cls = model.select(F.explode("classes").alias("c")).select("c.label", "c.lp")
    x = cls.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(per_class - 1))))
    bits = F.transform(F.col("lp"), lambda v: (F.rand(seed) < F.exp(v)).cast("int"))
    return x.select("label", "sample", bits.alias("pixels"))


# ---------------------------------------------------------------- Gaussian


def fit_gaussian_nb(train: DataFrame, vector: str, label: str,
                    var_smoothing: float = 1e-9) -> DataFrame:
    """L-09: per-class mean and population variance per feature, plus
    ``var_smoothing`` x the largest per-feature variance over all rows."""
    lf = _long_form(train, vector, label).withColumn("x", F.col("x").cast("double"))
    eps = lf.groupBy("idx").agg(F.var_pop("x").alias("v")) \
            .select((F.max("v") * var_smoothing).alias("eps")).select("eps").scalar()
    per = lf.groupBy("label", "idx").agg(F.avg("x").alias("theta"), F.var_pop("x").alias("var"))
    per = per.withColumn("var", F.col("var") + eps)
    cc = train.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    n = train.select(F.count(F.lit(1))).scalar()
    classes = per.groupBy("label").agg(_ordered_values("theta").alias("theta"),
                                       _ordered_values("var").alias("var"))
    classes = classes.join(cc, "label").select(
        "label", F.log(F.col("n_c") / n).alias("prior"), "theta", "var")
    return classes.agg(F.array_sort(F.collect_list(F.struct("label", "prior", "theta", "var")))
                       .alias("classes"))


def predict_gaussian_nb(df: DataFrame, model: DataFrame, vector: str) -> DataFrame:
    x = _attach(df, model)
    v = F.col(vector)

    def score(m):
        jll = F.aggregate(
            F.sequence(F.lit(0), F.size(v) - 1), m["prior"],
            lambda acc, j: acc - 0.5 * F.log(F.lit(2 * math.pi) * F.get(m["var"], j))
            - 0.5 * F.pow(F.get(v, j).cast("double") - F.get(m["theta"], j), 2) / F.get(m["var"], j))
        return F.struct(m["label"].alias("label"), jll.alias("jll"))

    s = F.transform(F.col("_model"), score)
    return x.withColumn("_s", s).select(*df.columns, _pick(F.col("_s")))


# ---------------------------------------------------------------- Multinomial


def multinomial_nb(tf: DataFrame, docs: DataFrame, alphas: Sequence[float], scored: Sequence | None = None,
                   doc_id: str = "doc_id", label: str = "label", fold: str = "fold") -> DataFrame:
    """L-08 and M-09: every fold's documents scored by models of all other folds, for
    every smoothing value at once: (doc_id, label, fold, alpha, prediction, scores).

    ``tf`` holds (doc_id, term, tf, label, fold), ``docs`` one row per document
    (doc_id, label, fold), those without any term included (they count in the priors).
    ``scored`` names the folds to score, all by default. A document without a term of
    its training vocabulary has no row.

    log P(t | c) = log((N_ct + alpha) / (N_c + alpha |V|)) over the training vocabulary
    V. A term is one row with its counts by (fold, class), so one join gives each
    document's terms the counts of its own training folds, and one aggregate sums the
    gains over terms that a class has not seen, for every class and alpha. Only the
    totals by (fold, class) reach the driver.
    """
    tf = cut_lineage(tf.select(doc_id, "term", "tf", F.col(label).alias("label"), F.col(fold).alias("fold")))
    sizes = docs.groupBy(F.col(fold).alias("fold"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()
    folds = sorted({r["fold"] for r in sizes})
    classes = sorted({r["label"] for r in sizes if r["label"] is not None})
    scored = [f for f in folds if scored is None or f in scored]
    # per term: its training count of each (scored fold, class), the sum over the other folds
    counts = [F.sum(F.when((F.col("fold") != F.lit(f)) & (F.col("label") == F.lit(c)), F.col("tf")).otherwise(0))
              .alias(f"n{i}_{j}") for i, f in enumerate(scored) for j, c in enumerate(classes)]
    terms = cut_lineage(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), *counts))
    cells = [(i, j) for i in range(len(scored)) for j in range(len(classes))]
    seen = [sum((F.col(f"n{i}_{j}") for j in range(len(classes))), F.lit(0)) > 0 for i in range(len(scored))]
    totals = terms.agg(*[F.sum(f"n{i}_{j}").alias(f"n{i}_{j}") for i, j in cells],
                       *[F.count_if(s).alias(f"v{i}") for i, s in enumerate(seen)]).first()
    trained = {(i, c): sum(r["n"] for r in sizes if r["fold"] != f and r["label"] == c)
               for i, f in enumerate(scored) for c in classes}

    def of_fold(values):
        """The value of a row's own fold, given one per scored fold."""
        out = values[-1]
        for f, v in list(zip(scored, values))[-2::-1]:
            out = F.when(F.col("fold") == F.lit(f), v).otherwise(out)
        return out

    x = join_terms(tf.where(F.col("fold").isin(scored)), terms).where(of_fold(seen))
    own = x.select(doc_id, "label", "fold", "tf", *[of_fold([F.col(f"n{i}_{j}") for i in range(len(scored))]).alias(f"t{j}")
                                                    for j in range(len(classes))])
    sums = own.groupBy(doc_id, "label", "fold").agg(F.sum("tf").alias("_n"), *[
        F.sum(F.col("tf") * (F.log(F.col(f"t{j}") + a) - math.log(a))).alias(f"g{k}_{j}")
        for k, a in enumerate(alphas) for j in range(len(classes))])

    def score(k, a, j, c):
        parts = []
        for i in range(len(scored)):
            n_docs = sum(trained[i, d] for d in classes)
            room = (totals[f"n{i}_{j}"] or 0) + a * (totals[f"v{i}"] or 0)
            if not trained[i, c] or not totals[f"n{i}_{j}"]:
                parts.append(F.lit(float("-inf")))  # a class without training terms is never predicted
                continue
            parts.append(F.lit(math.log(trained[i, c] / n_docs)) + F.col("_n") * math.log(a / room) + F.col(f"g{k}_{j}"))
        return F.struct(F.lit(c).alias("label"), of_fold(parts).alias("jll"))

    per_alpha = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.array(*[score(k, a, j, c) for j, c in enumerate(
        classes)]).alias("scores")) for k, a in enumerate(alphas)])
    y = sums.select(doc_id, "label", "fold", F.inline(per_alpha))
    return y.select(doc_id, "label", "fold", "alpha", _pick(F.col("scores")), "scores")
