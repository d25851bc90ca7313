"""Property checks for operators whose output is random or iterative."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import bayes as B
from tessera.operators import mixture as GM
from tessera.operators import split as U
from tessera.operators import text as T
from tessera.operators import topics as TP
from tessera.plans.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SMALL


def test_bernoulli_sample_size_within_4_sigma(spark):
    df = spark.range(20000)
    n = U.bernoulli_sample(df, 0.05, seed=3).count()
    sd = math.sqrt(20000 * 0.05 * 0.95)
    assert abs(n - 1000) < 4 * sd


def test_hash_sample_is_reproducible_and_sized(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = U.hash_sample(df, "k", 0.1).select("k")
    b = U.hash_sample(df.repartition(7), "k", 0.1).select("k")
    assert sorted(a.collect()) == sorted(b.collect())
    assert abs(a.count() - 2000) < 4 * math.sqrt(20000 * 0.1 * 0.9)


def test_rebalance_fractions(spark):
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    r = U.rebalance(df, "y", minority=1, minority_fraction=1.4, majority_fraction=0.4, seed=5)
    counts = dict(r.groupBy("y").count().collect())
    assert abs(counts[1] - 2800) < 4 * math.sqrt(2800)
    assert abs(counts[0] - 7200) < 4 * math.sqrt(18000 * 0.4 * 0.6)


def test_expanding_folds_shape(spark):
    df = spark.range(100).select(F.col("id").alias("t"))
    folds = U.expanding_folds(df, "t", 3)
    got = {(r["fold"], r["role"]): r["count"] for r in folds.groupBy("fold", "role").count().collect()}
    assert got[(1, "train")] == 20 and got[(1, "validate")] == 20 and got[(1, "test")] == 20
    assert got[(3, "train")] == 60 and got[(3, "test")] == 20


def test_em_log_likelihood_does_not_decrease(spark):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(0, 1, (150, 2)), rng.normal(4, 0.5, (150, 2))])
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)],
                               "id long, v array<double>")
    for cov in GM.COV_TYPES:
        mix, hist = GM.fit_em(df, "v", "id", 2, cov, dims=2, max_iter=10, tol=0)
        assert all(b >= a - 1e-6 for a, b in zip(hist, hist[1:])), (cov, hist)
        assert mix.weights.sum() == pytest.approx(1.0)


def test_parameter_count_formula():
    assert GM.n_parameters("full", 2, 2) == ((2 + 3 + 1) * 2 - 1) * 2
    assert GM.n_parameters("tied", 2, 3) == (3 * 2 + 3 + 3 - 1) * 2
    assert GM.n_parameters("spherical", 3, 4) == ((3 + 1 + 1) * 4 - 1) * 2


def test_nmf_loss_decreases_and_factors_nonnegative(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    v = T.tfidf(T.term_counts(docs))
    w, h, loss = TP.nmf(v, 3, rounds=6, alpha=0.1, l1_ratio=0.5)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(loss, loss[1:])), loss
    assert w.where(" OR ".join(f"w{j} < 0" for j in range(3))).count() == 0
    assert h.where(" OR ".join(f"h{j} < 0" for j in range(3))).count() == 0


def test_bernoulli_samples_follow_probabilities(spark):
    train = spark.createDataFrame([(i, [1.0 if (i + j) % 4 == 0 else -1.0 for j in range(8)], i % 2)
                                   for i in range(200)], "id long, v array<double>, y int")
    model = B.fit_bernoulli_nb(train, "v", "y", alpha=1.0)
    s = B.sample_from_bernoulli(model, 400, seed=3)
    means = s.select("label", F.posexplode("pixels").alias("j", "b")).groupBy("label", "j") \
             .agg(F.avg("b").alias("m")).collect()
    probs = {(c["label"], j): math.exp(p) for c in model.first()["classes"] for j, p in enumerate(c["lp"])}
    for r in means:
        p = probs[(r["label"], r["j"])]
        assert abs(r["m"] - p) < 4 * math.sqrt(p * (1 - p) / 400) + 1e-9


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_accuracy_many_matches_column_classifier(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(0, 1, (80, 2)), rng.normal(3, 1, (80, 2))])
    df = spark.createDataFrame([(i, [float(a), float(b)], int(i >= 80)) for i, (a, b) in enumerate(pts)],
                               "id long, v array<double>, y int")
    models = {c: GM.fit_em(df.where(F.col("y") == c), "v", "id", 2, "diag", dims=2, max_iter=5)[0]
              for c in (0, 1)}
    via_numpy = GM.accuracy_many(df, "v", "y", [models])[0]
    via_columns = GM.classify_by_density(df, models, "v").agg(
        F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert via_numpy == pytest.approx(via_columns)
