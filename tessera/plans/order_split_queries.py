"""Registered queries for windows/ordering (W, O), splits (U), encoding (N)
and score curves (W-08, M-05, M-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import curves as CV
from tessera.operators import encode as N
from tessera.operators import split as U
from tessera.operators.ranking import first_come_deciles, lagged, percent_rank_global, positions
from tessera.plans.registry import register
from tessera.sources.tables import Tables

# ---------------------------------------------------------------- windows / ordering


@register("w04_percent_rank", sql="""
SELECT o_orderkey, round(percent_rank() OVER (ORDER BY o_orderdate), 9) AS pct_rank FROM orders""")
def w04_percent_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return percent_rank_global(o, "o_orderdate").select(
        "o_orderkey", F.round("pct_rank", 9).alias("pct_rank"))


def daily_totals(t: Tables) -> DataFrame:
    """Daily order totals: the date-ordered series of the reference's daily data."""
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"))


_DAILY_SQL = """(SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS total
                 FROM orders GROUP BY 1)"""


@register("w05_lag", sql=f"""
SELECT day, total, prev_total FROM (
  SELECT day, total, lag(total) OVER (ORDER BY day) AS prev_total,
         row_number() OVER (ORDER BY day) AS rn FROM {_DAILY_SQL}) WHERE rn > 1""")
def w05_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag by one row of a date-ordered series, first row dropped; the last row of
    each range is handed over its border."""
    d = lagged(daily_totals(Tables(spark, sf_dir)), "day", ["total"])
    return d.where("pos > 0").select("day", "total", "prev_total")


@register("w06_every_nth", sql=f"""
SELECT day, total FROM (SELECT day, total, row_number() OVER (ORDER BY day) AS rn FROM {_DAILY_SQL})
WHERE (rn - 1) % 21 = 0""")
def w06_every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = positions(daily_totals(Tables(spark, sf_dir)), "day")
    return d.where(F.col("pos") % 21 == 0).select("day", "total")


@register("w07_deciles", sql="""
WITH u AS (SELECT user_id, round(sum(value), 2) AS total FROM events GROUP BY 1),
r AS (SELECT user_id, row_number() OVER (ORDER BY total, user_id) AS r, count(*) OVER () AS n FROM u)
SELECT user_id, CAST(CASE WHEN n <= 1 THEN 0 ELSE greatest(0, ceil(10.0 * (r - 1) / (n - 1)) - 1) END
                     AS INTEGER) AS decile FROM r""")
def w07_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    u = ev.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("total"))
    return first_come_deciles(u, "total", "user_id").select("user_id", "decile")


_SCORES_SQL = """(SELECT doc_id, n_chars % 50 AS score, quality AS label
                  FROM labels JOIN documents USING (doc_id))"""


def _scores(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", (F.col("n_chars") % 50).alias("score"), F.col("quality").alias("label"))


_CUM_SQL = f"""
WITH c AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
                  count(*) FILTER (WHERE label != 1) AS neg FROM {_SCORES_SQL} GROUP BY score),
s AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp,
             sum(neg) OVER (ORDER BY score DESC) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS neg_below FROM c)"""


@register("w08_roc_points", sql=f"""{_CUM_SQL}
SELECT score AS threshold, round(tp / P, 9) AS tpr, round(fp / N, 9) AS fpr FROM s""")
def w08_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = CV.roc_points(_scores(Tables(spark, sf_dir)), "score", "label")
    return r.select("threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@register("m11_pr_points", sql=f"""{_CUM_SQL}
SELECT score AS threshold, round(tp / nullif(tp + fp, 0), 9) AS precision,
       round(tp / P, 9) AS recall FROM s""")
def m11_pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = CV.pr_points(_scores(Tables(spark, sf_dir)), "score", "label")
    return r.select("threshold", F.round("precision", 9).alias("precision"),
                    F.round("recall", 9).alias("recall"))


@register("m05_auc", sql=f"""{_CUM_SQL}
SELECT round(sum(pos * (neg_below + neg / 2.0)) / (max(P) * max(N)), 9) AS auc FROM s""")
def m05_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = CV.auc(_scores(Tables(spark, sf_dir)), "score", "label")
    return a.select(F.round("auc", 9).alias("auc"))


@register("o01_top10", sql="""
SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
ORDER BY total DESC, o_custkey LIMIT 10""")
def o01_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    return o.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total")) \
            .orderBy(F.col("total").desc(), "o_custkey").limit(10)


@register("o03_preview", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5""")
def o03_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@register("o04_first_n_per_class", sql="""
SELECT vec_id, label FROM (SELECT vec_id, label,
  row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) WHERE rn <= 10""")
def o04_first_n_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_number <= n: Spark plans a per-partition group limit below the
    shuffle, so each task ships at most n rows per class."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "label")
    w = Window.partitionBy("label").orderBy("vec_id")
    return e.withColumn("_rn", F.row_number().over(w)).where("_rn <= 10").drop("_rn")


@register("o05_permutation")
def o05_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random permutation key per row (features and labels move together)."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "label")
    return e.withColumn("perm_key", F.xxhash64("vec_id", F.lit(42)))


@register("o05_hash_permutation", sql=f"""
SELECT vec_id, label, row_number() OVER (ORDER BY {U.hash_value_sql('vec_id', 42)}, vec_id) - 1 AS place FROM embeddings""")
def o05_hash_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each row in a permutation by a keyed hash, over key ranges."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "label").withColumn("_h", U.hash_value("vec_id", 42))
    return positions(e, ["_h", "vec_id"], "place").select("vec_id", "label", F.col("place").cast("long").alias("place"))


@register("p25_hash_noise", sql=f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx,
  round(CAST(embedding[i] AS DOUBLE) + 0.1 * ({U.hash_uniform_sql('(vec_id * 64 + i - 1)', 5)} - 0.5), 7) AS x
FROM (SELECT *, generate_subscripts(embedding, 1) AS i FROM embeddings)""")
def p25_hash_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with uniform noise drawn from a hash of the key and the place."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", F.posexplode("embedding").alias("idx", "v"))
    noise = 0.1 * (U.hash_uniform(F.col("vec_id") * 64 + F.col("idx"), 5) - 0.5)
    return e.select("vec_id", "idx", F.round(F.col("v").cast("double") + noise, 7).alias("x"))


# ---------------------------------------------------------------- sets, sampling, splits


@register("u01_union", sql="""
SELECT event_id, event_type FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'signup'""")
def u01_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type")
    return U.union_all([ev.where(F.col("event_type") == "purchase"),
                        ev.where(F.col("event_type") == "signup")])


@register("u02_hash_sample", sql=f"""
SELECT event_id FROM events WHERE {U.hash_value_sql('event_id', 7)} < {U.below(0.05)}""")
def u02_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id")
    return U.hash_sample(ev, "event_id", 0.05, seed=7)


@register("u02_bernoulli_sample")
def u02_bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type")
    return U.bernoulli_sample(ev, 0.01, seed=11)


@register("u03_rebalance")
def u03_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Tables(spark, sf_dir).labels
    return U.rebalance(lab, "quality", minority=0, minority_fraction=1.4,
                       majority_fraction=0.4, seed=3)


_REBALANCED_SQL = f"""(SELECT doc_id, quality, unnest(range(CASE
  WHEN quality = 0 THEN 1 + CAST({U.hash_value_sql('doc_id', 3)} < {U.below(1.4 - 1)} AS INTEGER)
  ELSE CAST({U.hash_value_sql('doc_id', 3)} < {U.below(0.4)} AS INTEGER) END)) AS copy FROM labels)"""


def _hash_rebalanced(t: Tables) -> DataFrame:
    return U.hash_rebalance(t.labels.select("doc_id", "quality"), "quality", 0, 1.4, 0.4, "doc_id", seed=3)


@register("u03_hash_rebalance", sql=f"SELECT doc_id, quality, CAST(copy AS INTEGER) AS copy FROM {_REBALANCED_SQL}")
def u03_hash_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_rebalanced(Tables(spark, sf_dir))


@register("a10_hash_rebalanced_counts", sql=f"SELECT quality, count(*) AS n FROM {_REBALANCED_SQL} GROUP BY quality")
def a10_hash_rebalanced_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_rebalanced(Tables(spark, sf_dir)).groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@register("a10_rebalanced_counts")
def a10_rebalanced_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = u03_rebalance(spark, sf_dir)
    return r.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@register("u04_class_weights", sql="""
SELECT doc_id, quality, count(*) OVER () / ((SELECT count(DISTINCT quality) FROM labels)
       * count(*) OVER (PARTITION BY quality)) AS weight FROM labels""")
def u04_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Tables(spark, sf_dir).labels.select("doc_id", "quality")
    return U.class_weights(lab, "quality", "balanced")


@register("u04_fixed_weights", sql="""
SELECT doc_id, CAST(CASE quality WHEN 0 THEN 0.33 WHEN 1 THEN 1.0 END AS DOUBLE) AS weight FROM labels""")
def u04_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Tables(spark, sf_dir).labels.select("doc_id", "quality")
    return U.class_weights(lab, "quality", {0: 0.33, 1: 1.0}).select("doc_id", "weight")


@register("u05_hash_split", sql=f"""
SELECT doc_id, CASE WHEN {U.hash_value_sql('doc_id', 0)} < {U.below(0.8)} THEN 'train' ELSE 'dev' END
       AS split FROM documents""")
def u05_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents.select("doc_id")
    return U.hash_split(d, "doc_id", 0.8)


@register("u05_exact_split", sql=f"""
WITH x AS (SELECT doc_id, {U.hash_value_sql('doc_id', 0)} AS h FROM documents),
r AS (SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) - 1 AS rk, count(*) OVER () AS n FROM x)
SELECT doc_id, CASE WHEN rk < ceil(0.2 * n) THEN 'dev' ELSE 'train' END AS split FROM r""")
def u05_exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents.select("doc_id")
    return U.exact_split(d, "doc_id", 0.2)


@register("u06_positional_split", sql="""
SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY vec_id) - 1 < floor(count(*) OVER () / 2)
       THEN 'first' ELSE 'rest' END AS part FROM embeddings""")
def u06_positional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings.select("vec_id")
    return U.positional_split(e, "vec_id")


@register("u07_calendar_split", sql="""
SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1999 THEN 'train'
       WHEN year(o_orderdate) = 2000 THEN 'validate' WHEN year(o_orderdate) = 2001 THEN 'test' END
       AS split FROM orders""")
def u07_calendar_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return U.calendar_split(o, "o_orderdate", 1999, 2000, 2001).select("o_orderkey", "split")


@register("u08_time_folds", sql="""
WITH r AS (SELECT o_orderkey, percent_rank() OVER (ORDER BY o_orderdate) AS pr,
                  rank() OVER (ORDER BY o_orderdate) - 1 AS b, count(*) OVER () - 1 AS m FROM orders),
f AS (SELECT o_orderkey, i AS fold, CASE WHEN b * 5 <= i * m THEN 'train'
          WHEN b * 5 <= (i + 1) * m THEN 'validate' WHEN b * 5 <= (i + 2) * m THEN 'test' END AS role
      FROM r, range(1, 4) t(i))
SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS n FROM f WHERE role IS NOT NULL GROUP BY 1, 2""")
def u08_time_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    folds = U.expanding_folds(o, "o_orderdate", 3)
    return folds.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"))


@register("u09_ts_split", sql=f"""
WITH d AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS pos, count(*) OVER () AS n
           FROM {_DAILY_SQL}),
f AS (SELECT day, j AS fold, CASE WHEN pos < n - 250 + j * 50 THEN 'train'
          WHEN pos < n - 250 + j * 50 + 50 THEN 'test' END AS role FROM d, range(0, 5) t(j))
SELECT day, CAST(fold AS INTEGER) AS fold, role FROM f WHERE role IS NOT NULL""")
def u09_ts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily_totals(Tables(spark, sf_dir)).select("day")
    return U.sliding_test_folds(d, "day", n_splits=5, test_size=50)


@register("u10_repeated_holdout", sql=f"""
WITH x AS (SELECT doc_id, rep, {U.hash_value_sql('doc_id + rep * 7919', 5)} AS h
           FROM documents, range(0, 25) t(rep)),
r AS (SELECT rep, row_number() OVER (PARTITION BY rep ORDER BY h, doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY rep) AS n FROM x)
SELECT CAST(rep AS INTEGER) AS rep, CASE WHEN rk < ceil(0.1 * n) THEN 'dev' ELSE 'train' END AS split,
       count(*) AS n FROM r GROUP BY 1, 2""")
def u10_repeated_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents.select("doc_id")
    r = U.repeated_holdout(d, "doc_id", 25, 0.1, seed=5)
    return r.groupBy(F.col("rep").cast("int").alias("rep"), "split").agg(
        F.count(F.lit(1)).alias("n"))


@register("u10_holdout_members", sql=f"""
WITH x AS (SELECT doc_id, rep, {U.hash_value_sql('doc_id + rep * 7919', 5)} AS h
           FROM documents, range(0, 25) t(rep)),
r AS (SELECT doc_id, rep, row_number() OVER (PARTITION BY rep ORDER BY h, doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY rep) AS n FROM x)
SELECT doc_id, CAST(rep AS INTEGER) AS rep FROM r WHERE rk < ceil(0.1 * n)""")
def u10_holdout_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dev members of every repetition (which rows, not just how many)."""
    d = Tables(spark, sf_dir).documents.select("doc_id")
    r = U.repeated_holdout(d, "doc_id", 25, 0.1, seed=5)
    return r.where(F.col("split") == "dev").select("doc_id", F.col("rep").cast("int").alias("rep"))


@register("u11_kfold", sql=f"""
SELECT doc_id, CAST({U.hash_bucket_sql('doc_id', 5, 1)} AS INTEGER) AS fold FROM labels""")
def u11_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Tables(spark, sf_dir).labels.select("doc_id")
    return U.kfold(lab, "doc_id", 5, seed=1)


# ---------------------------------------------------------------- normalisation, encoding

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("n01_zscore", sql=f"""
SELECT l_orderkey, l_linenumber, {', '.join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / nullif((SELECT stddev_samp({c}) FROM lineitem), 0), 6) "
    f"AS {c}_scaled" for c in _NUM)} FROM lineitem""")
def n01_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = N.zscore(Tables(spark, sf_dir).lineitem, _NUM, keep=["l_orderkey", "l_linenumber"])
    return z.select("l_orderkey", "l_linenumber",
                    *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _NUM])


@register("n03_frequency_index", sql="""
SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS index
FROM events GROUP BY event_type""")
def n03_frequency_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.frequency_index(Tables(spark, sf_dir).events, "event_type")


@register("n03_onehot_pipeline")
def n03_onehot_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    ev = Tables(spark, sf_dir).events.select("event_id", "event_type",
                                             F.hour("ts").cast("string").alias("hour"), "value")
    model = Pipeline(stages=N.categorical_pipeline(["event_type", "hour"], ["value"])).fit(ev)
    out = model.transform(ev)
    return out.select("event_id", vector_to_array("features").alias("features"))


@register("n04_drop_label", sql="""
WITH idx AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS label
             FROM events GROUP BY event_type)
SELECT event_id, label FROM events JOIN idx USING (event_type) WHERE label != 2""")
def n04_drop_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type")
    idx = N.frequency_index(ev, "event_type", out="label").select("event_type", "label")
    return N.drop_label(ev.join(idx, "event_type"), "label", 2) \
            .select("event_id", "label")
