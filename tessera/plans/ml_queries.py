"""Registered model-fitting queries (rows-only checks: fitted models are
iterative or randomised, so there is no SQL oracle for them).

Flight-delay analogue: an ``events`` row is a flight, ``value >= 15`` the
delay label, features are the previous-leg flag (W-02), the trailing delay
count (W-03), hour, weekday and event type; folds are ordered by ``ts``.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import linear as LR
from tessera.operators import metrics as M
from tessera.operators import mixture as GM
from tessera.operators import models as ML
from tessera.operators import split as U
from tessera.operators import text as T
from tessera.operators import topics as TP
from tessera.operators.ranking import lagged, positions
from tessera.plans.core_queries import clean_events, delay_features
from tessera.plans.model_queries import _TRAIN_IMG, image_split
from tessera.plans.order_split_queries import daily_totals
from tessera.plans.registry import register
from tessera.session import cut_lineage, dealt, drop_scratch, free_shuffles, scratch_path
from tessera.sources import files as S
from tessera.sources.tables import Tables

# No vocabulary cap (MLlib's default keeps only the 2^18 most frequent terms);
# the vocabulary is part of the fitted model, as in any vector pipeline.
UNCAPPED_VOCAB = 2**31 - 1

# The L1 strengths swept by the vocabulary reduction (inverse strength C).
L1_STRENGTHS = [0.001, 0.01, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0]

# The reference's parameter grids: logistic regression and boosted trees.
LR_GRID = {"maxIter": [1, 30], "regParam": [0.01, 0.001], "elasticNetParam": [0.25, 0.5, 0.1]}
GBT_GRID = [{"depth": d, "bins": 350, "iters": i, "step": s} for d in (7, 11) for i in (7, 9) for s in (0.35, 0.45)]
# Rounds after which a fit ends that has not met its tolerance: scikit-learn's defaults.
EM_ROUNDS, LR_ROUNDS, NMF_ROUNDS = 100, 100, 200

#: Rows of a part of a table that models are fitted on.
FIT_ROWS = 100_000

CAT = ["event_type"]
NUM = ["hour", "weekday", "prev_delayed", "n_prev_delays"]
CUT = dt.datetime(2024, 1, 21)


def delay_table(t: Tables) -> DataFrame:
    """Feature table for the delay models, written once to the shared
    checkpoint root: model fitting reads it many times (indexers, every
    optimiser pass, every fold), and the windowed features behind it take
    several shuffles to build. A large table is dealt to parts of ``FIT_ROWS``: the
    files are few and small, and a fit has no more tasks than its input has parts."""
    f = delay_features(clean_events(t))
    return dealt(cut_lineage(f.select("event_id", "ts", "event_type",
                    F.hour("ts").cast("double").alias("hour"),
                    (F.dayofweek("ts") - 1).cast("double").alias("weekday"),
                    F.col("prev_delayed").cast("double").alias("prev_delayed"),
                    F.coalesce("n_prev_delays", F.lit(0)).cast("double").alias("n_prev_delays"),
                    (F.col("value") >= 15).cast("int").alias("label"))), "event_id", FIT_ROWS)


def _calendar(t: Tables):
    d = delay_table(t)
    return d.where(F.col("ts") < F.lit(CUT)), d.where(F.col("ts") >= F.lit(CUT))


def _metrics_for(estimator, spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _calendar(Tables(spark, sf_dir))
    _, pred = ML.fit_and_score(ML.feature_pipeline(estimator, CAT, NUM), train, test)
    return M.binary_metrics(pred.withColumn("prediction", F.col("prediction").cast("int")))


@register("l01_logistic")
def l01_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_for(ML.logistic(), spark, sf_dir)


@register("l03_random_forest")
def l03_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_for(ML.random_forest(), spark, sf_dir)


@register("l04_gbt")
def l04_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_for(ML.gbt(), spark, sf_dir)


@register("l05_decision_tree")
def l05_decision_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_for(ML.decision_tree(), spark, sf_dir)


@register("l02_logistic_c")
def l02_logistic_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial L2 logistic regression with C = 0.5 on the image vectors;
    sum of squared weights per class."""
    train, _ = image_split(Tables(spark, sf_dir))
    x = train.select(array_to_vector("embedding").alias("features"),
                     F.col("label").cast("double").alias("label"))
    model = ML.logistic_c(0.5, x.count()).fit(x)
    coef = model.coefficientMatrix.toArray()
    rows = [(int(c), float((coef[i] ** 2).sum())) for i, c in enumerate(range(coef.shape[0]))]
    return spark.createDataFrame(rows, "class int, sum_sq_weights double")


# Strengths of the one-vs-rest sweep: the reference's for l2, and three of them for l1.
OVR_C = {"l2": L1_STRENGTHS, "l1": [0.01, 0.5, 10.0]}


def _one_vs_rest(t: Tables) -> list:
    train, _ = image_split(t)
    return [p for penalty, cs in OVR_C.items() for p in LR.one_vs_rest(train, "embedding", "label", cs, [penalty])]


@register("l02_one_vs_rest")
def l02_one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared weights and non-zero weights per class, penalty and strength."""
    rows = [(p.penalty, p.c, int(p.label), float((p.w ** 2).sum()), int((p.w != 0).sum()))
            for p in _one_vs_rest(Tables(spark, sf_dir))]
    return spark.createDataFrame(rows, "penalty string, c double, class int, sum_sq_weights double, n_weights int")


@register("l02_one_vs_rest_optimal", sql=f"""
SELECT penalty, CAST(c AS DOUBLE) AS c, CAST(label AS INTEGER) AS class, TRUE AS optimal, TRUE AS never_rises
FROM (SELECT DISTINCT label FROM {_TRAIN_IMG}), (VALUES {', '.join(
    f"('{k}', {c})" for k, cs in OVR_C.items() for c in cs)}) v(penalty, c)""")
def l02_one_vs_rest_optimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked facts: every fit meets the conditions of a minimum, and no round raised its objective."""
    rows = [(p.penalty, p.c, int(p.label), LR.residual(p) < 1e-4,
             all(b <= a * (1 + 1e-12) for a, b in zip(p.history, p.history[1:]))) for p in _one_vs_rest(Tables(spark, sf_dir))]
    return spark.createDataFrame(rows, "penalty string, c double, class int, optimal boolean, never_rises boolean")


@register("l11_kmeans_elbow")
def l11_kmeans_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings
    return ML.kmeans_elbow(e, "embedding", range(2, 15))


@register("l11_kmeans_assign")
def l11_kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding")
    return ML.kmeans_assign(e, "embedding", 10).select("vec_id", "cluster")


@register("l13_pca")
def l13_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = image_split(Tables(spark, sf_dir))
    return ML.pca_explained(train, "embedding", 10)


def _binary_images(t: Tables, dims: int):
    train, dev = image_split(t)
    train = train.withColumn("y", (F.col("label") >= 5).cast("int"))
    dev = dev.withColumn("y", (F.col("label") >= 5).cast("int"))
    return ML.pca_project(train, dev, "embedding", dims)


@register("l14_gmm_classify")
def l14_gmm_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One full-covariance mixture (4 components, MLlib) per class on 2 PCA
    dimensions; each dev row goes to the class with the larger density."""
    train, dev = _binary_images(Tables(spark, sf_dir), 2)
    # The classes are independent fits of up to 100 short rounds: both run at a time.
    with ThreadPoolExecutor(max_workers=2) as pool:
        models = dict(zip((0, 1), pool.map(lambda c: GM.mllib_full_mixture(train.where(F.col("y") == c), "pcs", 4), (0, 1))))
    return GM.classify_by_density(dev, models, "pcs").select("vec_id", "y", "prediction")


@register("l15_mixture_search")
def l15_mixture_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covariance type x PCA size (2-25) x components (2-25), keeping the
    settings with at most 50 parameters (counted before fitting), one mixture
    per class each; ranked by dev accuracy.

    One PCA fit serves every size (leading components are nested); all 2 x
    settings mixtures are fitted together (one pass over the rows per EM
    round) and all settings are scored on the dev rows in one aggregate."""
    t = Tables(spark, sf_dir)
    grid = GM.search_grid(50)
    max_dims = max(d for _, d, _, _ in grid)
    train, dev = _binary_images(t, max_dims)
    train, dev = cut_lineage(train), cut_lineage(dev)
    specs = {f"{cov}-{d}-{k}-{c}": (c, k, cov, d) for cov, d, k, _ in grid for c in (0, 1)}
    fitted = GM.fit_em_many(train, "pcs", "vec_id", specs, max_dims, group="y", max_iter=EM_ROUNDS)
    accs = GM.accuracy_many(dev, "pcs", "y", [{c: fitted[f"{cov}-{d}-{k}-{c}"][0] for c in (0, 1)}
                                              for cov, d, k, _ in grid])
    rows = [(cov, d, k, n, float(a)) for (cov, d, k, n), a in zip(grid, accs)]
    out = spark.createDataFrame(rows, "cov string, pca_dims int, comps int, n_params int, accuracy double")
    return M.mean_by_param(out, ["cov", "pca_dims", "comps", "n_params"], "accuracy") \
        .withColumnRenamed("mean_score", "accuracy")


@register("l15_fitted_moments", sql=f"""
WITH x AS (SELECT CAST(label >= 5 AS INTEGER) AS y, embedding AS e FROM embeddings),
d(a, b) AS (VALUES (0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))
SELECT y, a, b, round(avg(CAST(e[a + 1] AS DOUBLE)), 8) AS mean,
  round(covar_pop(CAST(e[a + 1] AS DOUBLE), CAST(e[b + 1] AS DOUBLE)) + CASE WHEN a = b THEN {GM.REG_COVAR} ELSE 0 END, 8)
    AS cov
FROM x, d GROUP BY y, a, b""")
def l15_fitted_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The EM fit of a one-component full mixture per class is the class's mean and
    covariance: the statistics that the search adds up, against an aggregate."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("y"))
    specs = {c: (c, 1, "full", 3) for c in (0, 1)}
    fitted = GM.fit_em_many(e, "embedding", "vec_id", specs, 3, group="y")
    rows = [(c, a, b, float(m.means[0][a]), float(m.covs[0][a][b])) for c, (m, _) in fitted.items()
            for a in range(3) for b in range(a, 3)]
    out = spark.createDataFrame(rows, "y int, a int, b int, mean double, cov double")
    return out.select("y", "a", "b", F.round("mean", 8).alias("mean"), F.round("cov", 8).alias("cov"))


@register("l16_grid_search_cv")
def l16_grid_search_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-fold search (fold column from the key hash) with CrossValidator."""
    d = U.kfold(delay_table(Tables(spark, sf_dir)), "event_id", 2)
    lr = ML.logistic()
    pipe = ML.feature_pipeline(lr, CAT, NUM)
    grid = ParamGridBuilder()
    for name, values in LR_GRID.items():
        grid = grid.addGrid(lr.getParam(name), values)
    grid = grid.build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, foldCol="fold", numFolds=2,
                        evaluator=BinaryClassificationEvaluator(), parallelism=2)
    model = cv.fit(d)
    rows = [(int(p[lr.maxIter]), float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m))
            for p, m in zip(grid, model.avgMetrics)]
    out = spark.createDataFrame(rows, "max_iter int, reg_param double, elastic_net double, auc double")
    return M.mean_by_param(out, ["max_iter", "reg_param", "elastic_net"], "auc")


def _time_folds(t: Tables, k: int = 3) -> DataFrame:
    return dealt(cut_lineage(U.expanding_folds(delay_table(t), "ts", k)), "event_id", FIT_ROWS)


@register("l16_time_grid")
def l16_time_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual product over a GBT grid and expanding time folds; mean AUC per
    setting, best flagged (M-09)."""
    folds = _time_folds(Tables(spark, sf_dir))

    def pipe_for(**params):
        return ML.feature_pipeline(ML.gbt(**params), CAT, NUM)

    scores = ML.grid_search(pipe_for, GBT_GRID, folds, score="auc")
    return M.mean_by_param(scores, ["depth", "bins", "iters", "step"], "score")


@register("l17_fold_runner")
def l17_fold_runner(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = _time_folds(Tables(spark, sf_dir))
    return ML.fold_metrics(ML.feature_pipeline(ML.logistic(), CAT, NUM), folds)


@register("l18_feature_importance")
def l18_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _calendar(Tables(spark, sf_dir))
    model, pred = ML.fit_and_score(ML.feature_pipeline(ML.random_forest(), CAT, NUM),
                                   train, test)
    return ML.importance_table(model, pred)


TOP_FEATURES = [10, 15, 20]
FEATURE_SETS = {"schedule": ["hour", "weekday"], "history": ["prev_delayed", "n_prev_delays"],
                "all": NUM}


@register("l21_feature_sets")
def l21_feature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same model and split over named feature lists, plus refits on the 10, 15 and 20
    features of the highest random-forest importance; one metrics table (M-08)."""
    train, test = (d.withColumn("hour_of_day", F.col("hour").cast("string")) for d in _calendar(Tables(spark, sf_dir)))

    def scores(pred: DataFrame) -> DataFrame:
        return M.binary_metrics(pred.withColumn("prediction", F.col("prediction").cast("int")))

    rows = {}
    for name, cols in FEATURE_SETS.items():
        rows[name] = scores(ML.fit_and_score(ML.feature_pipeline(ML.logistic(), CAT, cols), train, test)[1])
    forest, pred = ML.fit_and_score(ML.feature_pipeline(ML.random_forest(bins=32), [*CAT, "hour_of_day"], NUM), train, test)
    ranked = [r["idx"] for r in ML.importance_table(forest, pred, top=max(TOP_FEATURES)).collect()]
    encoded = cut_lineage(forest.transform(train).select("features", "label")), cut_lineage(pred.select("features", "label"))
    for n in TOP_FEATURES:
        kept = VectorSlicer(inputCol="features", outputCol="kept", indices=sorted(ranked[:n]))
        pipe = Pipeline(stages=[kept, ML.logistic(featuresCol="kept")])
        rows[f"top{n}"] = scores(ML.fit_and_score(pipe, *encoded)[1])
    return M.comparison_table(rows)


@register("l20_every_nth_export")
def l20_every_nth_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series: lagged totals as features, label = next day's total up;
    train on days up to a cut-off, score every 21st later day, export the
    probabilities as CSV and read them back."""
    d = daily_totals(Tables(spark, sf_dir))
    d = lagged(d, "day", ["total", "day"])
    d = lagged(d.select("day", F.col("total").alias("next_total"), F.col("prev_total").alias("total"),
                        F.col("prev_day").alias("at")), "day", ["total"])
    x = d.where("pos > 1").select(F.col("at").alias("day"), "total", F.col("prev_total").alias("lag1"), "next_total",
                                  (F.col("next_total") > F.col("total")).cast("int").alias("label"))
    cut = dt.date(2000, 1, 1)
    train = x.where(F.col("day") <= F.lit(cut))
    later = x.where(F.col("day") > F.lit(cut))
    later = positions(later, "day", "k").where(F.col("k") % 21 == 0)
    _, pred = ML.fit_and_score(Pipeline(stages=[*ML.categorical_pipeline([], ["total", "lag1"]),
                                                ML.logistic()]), train, later)
    out = ML.positive_probability(pred).select("day", "label", "p1")
    path = scratch_path(spark, "daily-probabilities")
    S.write_csv(out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "label", "p1"), path)
    return spark.read.schema("day string, label int, p1 double").option("header", True).csv(path)


@register("s09_model_save")
def s09_model_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a fitted pipeline, load it back and score with the loaded copy."""
    train, test = _calendar(Tables(spark, sf_dir))
    model = ML.feature_pipeline(ML.logistic(), CAT, NUM).fit(train)
    path = scratch_path(spark, "delay-model")
    S.save_model(model, path)
    loaded = S.load_pipeline_model(path)
    return ML.positive_probability(loaded.transform(test)).select("event_id", "prediction", "p1")


@register("s09_model_round_trip", sql=f"""
SELECT count(*) AS n_rows, TRUE AS equal FROM (SELECT DISTINCT user_id, ts FROM events) WHERE ts >= TIMESTAMP '{CUT}'""")
def s09_model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked facts: the loaded pipeline scores every test row as the saved one does."""
    train, test = _calendar(Tables(spark, sf_dir))
    model = ML.feature_pipeline(ML.logistic(), CAT, NUM).fit(train)
    path = scratch_path(spark, "delay-model")
    S.save_model(model, path)
    scores = [ML.positive_probability(m.transform(test)).select("event_id", F.col("p1").alias(f"p{i}"))
              for i, m in enumerate((model, S.load_pipeline_model(path)))]
    both = scores[0].join(scores[1], "event_id", "full")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.every(F.coalesce(F.col("p0") == F.col("p1"), F.lit(False))).alias("equal"))


@register("t13_vocab_reduction")
def t13_vocab_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 logistic regression per strength C keeps the terms with a non-zero
    weight; an L2 model refit on that vocabulary is scored on dev (weighted F1)."""
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", X.tokens("text").alias("toks"))
    side = U.hash_bucket("doc_id", 100, 0) < 80
    train, dev = d.where(side), d.where(~side)
    from pyspark.ml.feature import StringIndexer

    idx = StringIndexer(inputCol="lang", outputCol="label").fit(train)
    cv = CountVectorizer(inputCol="toks", outputCol="features",
                         vocabSize=UNCAPPED_VOCAB).fit(train)
    tr = idx.transform(cv.transform(train)).cache()
    dv = idx.transform(cv.transform(dev))
    n = tr.count()
    vocab = cv.vocabulary
    tr2, dv2 = tr.drop("features"), dv.drop("features")

    def one_strength(c: float):
        l1 = ML.logistic_c(c, n, "l1", max_iter=LR_ROUNDS, tol=1e-4).fit(tr)
        keep = sorted({j for row in l1.coefficientMatrix.toArray() for j, w in enumerate(row) if w != 0})
        if not keep:
            return (c, 0, 0.0)
        kept_terms = [vocab[j] for j in keep]
        cvm = CountVectorizerModel.from_vocabulary(kept_terms, inputCol="toks", outputCol="features")
        l2 = ML.logistic_c(0.5, n, "l2", max_iter=LR_ROUNDS, tol=1e-4).fit(cvm.transform(tr2))
        pred = l2.transform(cvm.transform(dv2))
        f1 = M.weighted_f1(M.per_class_report(pred.withColumn("label", F.col("label").cast("int"))
                                              .withColumn("prediction", F.col("prediction").cast("int"))))
        return (c, len(kept_terms), float(f1.first()[0] or 0.0))

    # The strengths are independent fits: submit them as concurrent Spark jobs
    # (as CrossValidator's parallelism does) instead of one after another.
    with ThreadPoolExecutor(max_workers=4) as pool:
        rows = list(pool.map(one_strength, L1_STRENGTHS))
    tr.unpersist()
    return spark.createDataFrame(rows, "c double, vocab_size int, weighted_f1 double")


# The reference's regularisation of the factorisation.
NMF_ALPHA, NMF_L1 = 0.1, 0.5


def _topic_matrix(t: Tables) -> tuple[DataFrame, str]:
    """TF-IDF of the texts after cleaner B, without the stop words by rule; written, with its path.
    The counts behind it are deleted."""
    counts, path = (scratch_path(t.spark, f"topics-{c}") for c in ("tf", "v"))
    tf = cut_lineage(T.term_counts(t.documents.select("doc_id", "text"), toks=X.tokens(X.clean_b("text"))), path=counts)
    n_docs = t.documents.select(F.count(F.lit(1))).scalar()
    kept = T.remove_stop_words(tf, T.frequent_terms_as_stop_words(tf, 0.5, n_docs))
    free_shuffles(t.spark)
    v = cut_lineage(T.tfidf(kept, n_docs=n_docs, written=True).select("doc_id", "term", "w"), path=path)
    drop_scratch(t.spark, counts)
    free_shuffles(t.spark)
    return v, path


def _nmf(spark: SparkSession, sf_dir: str, k: int = 5):
    v, path = _topic_matrix(Tables(spark, sf_dir))
    w, h, losses = TP.nmf(v, k, rounds=NMF_ROUNDS, tol=1e-4, alpha=NMF_ALPHA, l1_ratio=NMF_L1, written=True)
    drop_scratch(spark, path)
    return w, h, losses


@register("t14_nmf_facts", sql=r"""
WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
         '_', ' ', 'g'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '(http|com|www)', '', 'g'),
         '(imgur|jpg|png|picture|pic|youtube)', '', 'g') AS cleaned FROM documents),
tf AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(cleaned, '[\p{L}\p{N}_]{2,}')) AS term FROM c),
kept AS (SELECT * FROM tf WHERE term NOT IN (
  SELECT term FROM tf GROUP BY term HAVING count(*) > (SELECT count(*) FROM documents) * 0.5))
SELECT count(DISTINCT doc_id) AS n_docs, count(DISTINCT term) AS n_terms, TRUE AS never_rises, TRUE AS non_negative,
       TRUE AS loss_is_that_of_the_factors FROM kept""")
def t14_nmf_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked facts of the factorisation: its size, that the objective never rises, that
    no factor is negative, and that the observed objective is that of the factors."""
    v, path = _topic_matrix(Tables(spark, sf_dir))
    w, h, losses = TP.nmf(v, 5, rounds=10, alpha=NMF_ALPHA, l1_ratio=NMF_L1, written=True)
    cols = [(f"w{j}", f"h{j}") for j in range(5)]
    w, h = cut_lineage(w), cut_lineage(h)

    def side(df, names):
        total = F.sum(sum((F.col(c) for c in names), F.lit(0.0)))
        square = F.sum(sum((F.col(c) * F.col(c) for c in names), F.lit(0.0)))
        gram = [F.sum(F.col(a) * F.col(b)) for a in names for b in names]
        return df.agg(F.count(F.lit(1)), F.min(F.least(*names)), total, square, *gram).first()

    sw, sh = side(w, [a for a, _ in cols]), side(h, [b for _, b in cols])
    # V meets H where it lies, but for rare terms, and W by its sums per document
    h = h.join(cut_lineage(T.document_frequency(v)), "term")
    sums = T.join_terms(v, cut_lineage(h)).groupBy("doc_id").agg(
        *[F.sum(F.col("w") * F.col(b)).alias(f"s{b}") for _, b in cols], F.sum(F.col("w") * F.col("w")).alias("_ss"))
    cross = sums.join(w, "doc_id").agg(F.sum(sum((F.col(a) * F.col(f"s{b}") for a, b in cols), F.lit(0.0))), F.sum("_ss")).first()
    drop_scratch(spark, path)
    free_shuffles(spark)
    error = cross[1] - 2 * cross[0] + sum(a * b for a, b in zip(sw[4:], sh[4:]))
    loss = 0.5 * error + NMF_ALPHA * NMF_L1 * (sw[2] + sh[2]) + 0.5 * NMF_ALPHA * (1 - NMF_L1) * (sw[3] + sh[3])
    falls = all(b <= a * (1 + 1e-12) for a, b in zip(losses, losses[1:]))
    row = (sw[0], sh[0], falls, min(sw[1], sh[1]) >= 0, abs(loss - losses[-1]) <= 1e-8 * loss)
    return spark.createDataFrame([row], "n_docs long, n_terms long, never_rises boolean, non_negative boolean, "
                                        "loss_is_that_of_the_factors boolean")


@register("t14_nmf_top_words")
def t14_nmf_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, h, _ = _nmf(spark, sf_dir)
    return TP.top_words(h, 5, 20)


@register("t14_nmf_doc_topic")
def t14_nmf_doc_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, _, _ = _nmf(spark, sf_dir)
    return TP.doc_topic(w, 5)


@register("t14_lda_topics")
def t14_lda_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MLlib LDA as the built-in alternative topic model (5 topics)."""
    from pyspark.ml.clustering import LDA

    d = Tables(spark, sf_dir).documents.select("doc_id", X.tokens("text").alias("toks"))
    cv = CountVectorizer(inputCol="toks", outputCol="features",
                         vocabSize=UNCAPPED_VOCAB).fit(d)
    model = LDA(k=5, seed=1).fit(cv.transform(d))
    # The vocabulary already lives on the driver inside the fitted model.
    vocab = spark.createDataFrame(list(enumerate(cv.vocabulary)), "term_index int, term string")
    topics = model.describeTopics(20).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"))
    x = topics.select("topic", (F.col("rank") + 1).alias("rank"),
                      F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"))
    return x.join(vocab, "term_index").select("topic", "rank", "term", "weight")
