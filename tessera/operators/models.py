"""Model fitting and evaluation jobs on MLlib (L-01 .. L-05, L-11, L-13 .. L-18,
L-20, L-21, T-13).

Estimators are MLlib's (distributed fitting); this module only wires feature
pipelines, folds, parameter grids and metric tables together. Each fold is
fitted on its training part and scored on its validation part, and every fold
reports (the reference stopped after the first fold and refit on validation).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce
from threading import Lock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.curves import auc
from tessera.operators.encode import categorical_pipeline
from tessera.operators.metrics import binary_metrics
from tessera.session import cut_lineage


#: Fits of a grid that run at a time.
FITS = 4
#: Rows from which equal rows are taken as one before boosted trees are fitted.
DISTINCT_FROM = 100_000


def logistic(max_iter: int = 30, reg: float = 0.01, elastic: float = 0.5, **kw) -> LogisticRegression:
    """L-01: elastic-net logistic regression without standardisation."""
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic,
                              standardization=False, **kw)


def logistic_c(c: float, n_rows: int, penalty: str = "l2", max_iter: int = 100,
               tol: float = 1e-6) -> LogisticRegression:
    """L-02: inverse strength C mapped to ``regParam = 1 / (C n)``; l1 or l2."""
    return LogisticRegression(maxIter=max_iter, regParam=1.0 / (c * max(n_rows, 1)),
                              elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              family="multinomial", tol=tol)


def random_forest(trees: int = 15, depth: int = 15, bins: int = 15, subsample: float = 0.6,
                  impurity: str = "gini", seed: int = 7) -> RandomForestClassifier:
    """L-03."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=bins,
                                  subsamplingRate=subsample, impurity=impurity, seed=seed)


def gbt(depth: int = 7, bins: int = 350, iters: int = 7, step: float = 0.35,
        feature_subset: str = "all", seed: int = 7) -> GBTClassifier:
    """L-04 (the reference's xgboost use maps here; column sampling ->
    ``featureSubsetStrategy``)."""
    return GBTClassifier(maxDepth=depth, maxBins=bins, maxIter=iters, stepSize=step,
                         featureSubsetStrategy=feature_subset, seed=seed)


def decision_tree(depth: int = 10, min_leaf: int = 5) -> DecisionTreeClassifier:
    """L-05: entropy tree with a minimum leaf size."""
    return DecisionTreeClassifier(impurity="entropy", maxDepth=depth, minInstancesPerNode=min_leaf)


def feature_pipeline(estimator, cat_cols: Sequence[str], num_cols: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[*categorical_pipeline(cat_cols, num_cols), estimator])


def positive_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("p1", vector_to_array("probability")[1])


def fit_and_score(pipe: Pipeline, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, DataFrame]:
    model = pipe.fit(train)
    return model, model.transform(test)


def fold_metrics(pipe: Pipeline, folds: DataFrame, fold_col: str = "fold", role_col: str = "role",
                 label: str = "label") -> DataFrame:
    """L-17: fit on each fold's 'train' rows, score its 'validate' rows, one
    metrics row per fold (M-01)."""
    out = None
    for (f,) in folds.select(fold_col).distinct().orderBy(fold_col).collect():
        part = folds.where(F.col(fold_col) == f)
        _, pred = fit_and_score(pipe, part.where(F.col(role_col) == "train"),
                                part.where(F.col(role_col) == "validate"))
        m = binary_metrics(pred.withColumn("prediction", F.col("prediction").cast("int")), label)
        m = m.withColumn(fold_col, F.lit(f))
        out = m if out is None else out.unionByName(m)
    return out


def _stage_key(stages) -> tuple:
    """What tells feature stages apart: their kinds and parameters."""
    return tuple((type(s).__name__, tuple(sorted((p.name, str(v)) for p, v in s.extractParamMap().items()
                                                 if s.isSet(p)))) for s in stages)


def _distinct_rows(df: DataFrame, label: str) -> DataFrame:
    """(features, label, weight): the equal rows of an encoded table as one, with their number. Written as a table."""
    return cut_lineage(df.groupBy("features", label).agg(F.count(F.lit(1)).alias("weight")))


def grid_search(pipe_for, grid: Sequence[dict], folds: DataFrame, fold_col: str = "fold",
                role_col: str = "role", label: str = "label", score: str = "f1") -> DataFrame:
    """L-16 for time folds: every parameter setting x every fold, fitted on train
    and scored on validation by ``score``, a metric of M-01 or the exact ``auc``;
    returns (params..., fold, score).

    Boosted trees of a large fold take equal rows as one with its number as weight: the
    fold's features are fitted and encoded once (settings differ in the trees alone), and
    every pass of a tree is over its distinct rows. Sums, splits and scores are those of all
    the rows (up to rounding, which decides between splits of equal gain, as the rows' order does)."""
    sizes = folds.groupBy(fold_col).agg(F.count_if(F.col(role_col) == "train")).orderBy(fold_col).collect()
    parts = [(f, folds.where(F.col(fold_col) == f)) for f, _ in sizes]
    large = {f for f, n in sizes if n >= DISTINCT_FROM}
    encoded, lock = {}, Lock()

    def distinct(stages, f, part: DataFrame) -> tuple[DataFrame, DataFrame]:
        key = (f, _stage_key(stages))
        with lock:
            made = encoded.setdefault(key, Future())
            mine = not made.running() and not made.done() and made.set_running_or_notify_cancel()
        if mine:
            try:
                train = part.where(F.col(role_col) == "train")
                model = Pipeline(stages=stages).fit(train)
                made.set_result(tuple(_distinct_rows(model.transform(x), label) for x in (
                    train, part.where(F.col(role_col) == "validate"))))
            except BaseException as failed:
                made.set_exception(failed)
        return made.result()

    def scored(params: dict, f, part: DataFrame) -> DataFrame:
        pipe = pipe_for(**params)
        *stages, estimator = pipe.getStages()
        if score == "auc" and f in large and isinstance(estimator, GBTClassifier):
            train, validate = distinct(stages, f, part)
            pred = estimator.copy().setWeightCol("weight").fit(train).transform(validate)
            m = auc(positive_probability(pred), "p1", label, F.col("weight"))
        else:
            _, pred = fit_and_score(pipe, part.where(F.col(role_col) == "train"),
                                    part.where(F.col(role_col) == "validate"))
            m = auc(positive_probability(pred), "p1", label) if score == "auc" else binary_metrics(
                pred.withColumn("prediction", F.col("prediction").cast("int")), label)
        return m.select(*[F.lit(v).alias(k) for k, v in params.items()], F.lit(f).alias(fold_col), F.col(score).alias("score"))

    # The fits are independent: some run at a time, as with CrossValidator's parallelism.
    with ThreadPoolExecutor(max_workers=FITS) as pool:
        scores = list(pool.map(lambda s: scored(*s), [(params, f, part) for params in grid for f, part in parts]))
    return reduce(DataFrame.unionByName, scores) if scores else None


def importance_table(model: PipelineModel, pred: DataFrame, features: str = "features",
                     top: int = 20) -> DataFrame:
    """L-18: feature importances (trees) or |coefficients| (linear) joined to
    the feature names carried in the vector column's metadata; top ``top``,
    highest first."""
    spark = pred.sparkSession
    meta = pred.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    names = sorted([(a["idx"], a["name"]) for group in meta.values() for a in group])
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray().tolist()
    else:
        values = [abs(v) for v in last.coefficients.toArray().tolist()]
    rows = [(int(i), n, float(values[i])) for i, n in names if i < len(values)]
    t = spark.createDataFrame(rows, "idx int, feature string, importance double")
    return t.orderBy(F.col("importance").desc(), "idx").limit(top)


def kmeans_elbow(df: DataFrame, vector: str, ks: Sequence[int], seed: int = 1) -> DataFrame:
    """L-11: training cost (within-cluster sum of squares) for each k."""
    from pyspark.ml.clustering import KMeans

    x = df.select(array_to_vector(F.col(vector)).alias("features")).cache()
    try:
        rows = [(int(k), float(KMeans(k=k, seed=seed).fit(x).summary.trainingCost)) for k in ks]
    finally:
        x.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


def kmeans_assign(df: DataFrame, vector: str, k: int, seed: int = 1) -> DataFrame:
    from pyspark.ml.clustering import KMeans

    x = df.withColumn("features", array_to_vector(F.col(vector)))
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(x).transform(x).drop("features")


def pca_explained(train: DataFrame, vector: str, k: int) -> DataFrame:
    """L-13: explained-variance ratio per component and its running sum (fitted
    on the training rows only)."""
    from pyspark.ml.feature import PCA

    x = train.select(array_to_vector(F.col(vector)).alias("features"))
    ev = PCA(k=k, inputCol="features", outputCol="pcs").fit(x).explainedVariance.toArray().tolist()
    rows, run = [], 0.0
    for i, v in enumerate(ev):
        run += v
        rows.append((i + 1, float(v), float(run)))
    return train.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def pca_project(train: DataFrame, other: DataFrame, vector: str, k: int):
    from pyspark.ml.feature import PCA

    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(
        train.withColumn("_v", array_to_vector(F.col(vector))))

    def proj(df):
        return model.transform(df.withColumn("_v", array_to_vector(F.col(vector)))) \
                    .withColumn("pcs", vector_to_array("_p")).drop("_v", "_p")

    return proj(train), proj(other)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)
