"""Registered queries for SQL-checkable models and metrics (L-06..L-10, L-12,
L-19, M-01..M-10).

Image fixture: ``embeddings`` (64 values = 8x8), label 0-9, split 80/20 by a
key hash. Text fixture: ``documents`` term counts, label ``lang``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import bayes as B
from tessera.operators import metrics as M
from tessera.operators import neighbors as NB
from tessera.operators import text as T
from tessera.operators.ranking import positions
from tessera.operators.split import hash_bucket, hash_bucket_sql
from tessera.plans.registry import register
from tessera.plans.text_queries import _TF_SQL
from tessera.session import cut_lineage
from tessera.sources.tables import Tables

# Calibration bucket edges of the reference's posterior report.
CALIBRATION_EDGES = [0.5, 0.9, 0.999, 0.99999, 0.9999999, 0.999999999, 0.99999999999,
                     0.9999999999999, 1.0]

BNB_ALPHA = 0.001
KS = [1, 3, 5]
SIZES = [25, 50, 100, 200, 400, 800, 1600, 3200]


def image_split(t: Tables):
    e = t.embeddings.select("vec_id", "embedding", "label")
    side = hash_bucket("vec_id", 100, 0) < 80
    return e.where(side), e.where(~side)


_IMG_SPLIT = hash_bucket_sql("vec_id", 100, 0)
_TRAIN_IMG = f"(SELECT vec_id, embedding, label FROM embeddings WHERE {_IMG_SPLIT} < 80)"
_DEV_IMG = f"(SELECT vec_id, embedding, label FROM embeddings WHERE {_IMG_SPLIT} >= 80)"
_DIST_SQL = f"""(SELECT q.vec_id AS qid, r.vec_id AS rid, r.label,
  list_sum(list_transform(range(1, len(q.embedding) + 1),
           lambda i: pow(CAST(q.embedding[i] AS DOUBLE) - CAST(r.embedding[i] AS DOUBLE), 2))) AS dist
  FROM {_DEV_IMG} q, {_TRAIN_IMG} r)"""


@register("l06_knn", sql=f"""
WITH rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rn FROM {_DIST_SQL}),
v AS (SELECT qid, kk.k, label, count(*) AS votes FROM rk, (VALUES {', '.join(f'({k})' for k in KS)}) kk(k)
      WHERE rn <= kk.k GROUP BY 1, 2, 3)
SELECT qid, CAST(k AS INTEGER) AS k, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY votes DESC, label) AS r2 FROM v) WHERE r2 = 1""")
def l06_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, dev = image_split(Tables(spark, sf_dir))
    cands = NB.knn_candidates(dev, train, max(KS), "vec_id", "vec_id", "embedding", "label")
    return NB.knn_vote(cands, KS)


_TEXT_BUCKET = hash_bucket_sql("doc_id", 100, 0)


@register("l06_knn_terms", sql=f"""
WITH tf AS {_TF_SQL}, dv AS (SELECT * FROM tf WHERE {_TEXT_BUCKET} >= 80), tr AS (SELECT * FROM tf WHERE {_TEXT_BUCKET} < 80),
q AS (SELECT doc_id, sum(tf * tf) AS s FROM dv GROUP BY 1), r AS (SELECT doc_id, sum(tf * tf) AS s FROM tr GROUP BY 1),
p AS (SELECT dv.doc_id AS qid, tr.doc_id AS rid, sum(dv.tf * tr.tf) AS p FROM dv JOIN tr USING (term) GROUP BY 1, 2),
d AS (SELECT q.doc_id AS qid, r.doc_id AS rid, q.s + r.s - 2 * coalesce(p, 0) AS dist
      FROM q CROSS JOIN r LEFT JOIN p ON p.qid = q.doc_id AND p.rid = r.doc_id),
rk AS (SELECT qid, lang AS label, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rn
       FROM d JOIN documents ON doc_id = rid),
v AS (SELECT qid, kk.k, label, count(*) AS votes FROM rk, (VALUES {', '.join(f'({k})' for k in KS)}) kk(k)
      WHERE rn <= kk.k GROUP BY 1, 2, 3)
SELECT qid, CAST(k AS INTEGER) AS k, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY votes DESC, label) AS r2 FROM v) WHERE r2 = 1""")
def l06_knn_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-NN on sparse term counts, label ``lang``; documents without terms have no vector."""
    t = Tables(spark, sf_dir)
    tf = T.term_counts(t.documents.select("doc_id", "text"))
    x = cut_lineage(T.term_vectors(tf).join(t.documents.select("doc_id", "lang"), "doc_id"))
    side = hash_bucket("doc_id", 100, 0) < 80
    cands = NB.knn_candidates(x.where(~side), x.where(side), max(KS), "doc_id", "doc_id", "vector", "lang")
    return NB.knn_vote(cands, KS)


@register("m10_learning_curve", sql=f"""
WITH tr AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM {_TRAIN_IMG}),
d AS (SELECT d.*, tr.pos FROM {_DIST_SQL} d JOIN tr ON d.rid = tr.vec_id),
s AS (SELECT qid, sz.size, label, row_number() OVER (PARTITION BY qid, sz.size ORDER BY dist, rid) AS rn
      FROM d, (VALUES {', '.join(f'({s})' for s in SIZES)}) sz(size) WHERE pos < sz.size)
SELECT CAST(size AS BIGINT) AS size, count(*) AS n,
       round(avg(CASE WHEN s.label = q.label THEN 1.0 ELSE 0.0 END), 9) AS accuracy
FROM s JOIN {_DEV_IMG} q ON s.qid = q.vec_id WHERE rn = 1 GROUP BY size""")
def m10_learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-NN accuracy when training on the first s rows (by vec_id), all sizes in
    one distance pass."""
    train, dev = image_split(Tables(spark, sf_dir))
    best = NB.nearest_within_prefix(dev, positions(train, "vec_id"), SIZES, "vec_id", "vec_id", "pos",
                                    "embedding", "label")
    x = best.join(dev.select(F.col("vec_id").alias("qid"), F.col("label").alias("truth")), "qid")
    return x.groupBy("size").agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.avg((F.col("label") == F.col("truth")).cast("double")), 9)
                                 .alias("accuracy"))


def _bnb_sql(alpha: float) -> str:
    return f"""
WITH tr AS {_TRAIN_IMG},
x AS (SELECT label, i - 1 AS idx, CASE WHEN embedding[i] > 0 THEN 1.0 ELSE 0.0 END AS b
      FROM (SELECT *, generate_subscripts(embedding, 1) AS i FROM tr)),
cc AS (SELECT label, count(*) AS n_c FROM tr GROUP BY label),
m AS (SELECT label, idx, ln((sum(b) + {alpha}) / (min(n_c) + 2 * {alpha})) AS lp,
             ln(1 - (sum(b) + {alpha}) / (min(n_c) + 2 * {alpha})) AS lq
      FROM x JOIN cc USING (label) GROUP BY label, idx),
pr AS (SELECT label, ln(n_c / (SELECT count(*) FROM tr)) AS prior FROM cc),
dx AS (SELECT vec_id, i - 1 AS idx, embedding[i] > 0 AS is_on
       FROM (SELECT *, generate_subscripts(embedding, 1) AS i FROM {_DEV_IMG})),
s AS (SELECT dx.vec_id, m.label AS cls, sum(CASE WHEN is_on THEN lp ELSE lq END) AS s
      FROM dx JOIN m USING (idx) GROUP BY 1, 2),
j AS (SELECT vec_id, cls, s + prior AS jll FROM s JOIN pr ON s.cls = pr.label),
t AS (SELECT vec_id, max(jll) AS top FROM j GROUP BY vec_id),
z AS (SELECT j.vec_id, sum(exp(j.jll - t.top)) AS z FROM j JOIN t USING (vec_id) GROUP BY 1),
p AS (SELECT vec_id, cls AS prediction FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY jll DESC, cls) AS rn FROM j) WHERE rn = 1)
SELECT p.vec_id, p.prediction, q.label, 1.0 / z.z AS max_posterior
FROM p JOIN z USING (vec_id) JOIN {_DEV_IMG} q USING (vec_id)"""


def _bnb(t: Tables, alpha: float = BNB_ALPHA) -> DataFrame:
    train, dev = image_split(t)
    model = B.fit_bernoulli_nb(train, "embedding", "label", alpha)
    return B.predict_bernoulli_nb(dev, model, "embedding").select(
        "vec_id", "prediction", "label", "max_posterior")


@register("l07_bernoulli_nb", sql=f"""
SELECT vec_id, prediction, round(max_posterior, 6) AS max_posterior FROM ({_bnb_sql(BNB_ALPHA)})""")
def l07_bernoulli_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _bnb(Tables(spark, sf_dir))
    return p.select("vec_id", "prediction", F.round("max_posterior", 6).alias("max_posterior"))


@register("m06_calibration", sql=f"""
WITH p AS ({_bnb_sql(BNB_ALPHA)}),
e(bucket, lo, hi) AS (VALUES {', '.join(
    f"({i}, {float(CALIBRATION_EDGES[i - 1]) if i else 0.0}, {float(CALIBRATION_EDGES[i])})"
    for i in range(len(CALIBRATION_EDGES)))}),
c AS (SELECT bucket, count(*) AS total, count(*) FILTER (WHERE prediction = label) AS correct
      FROM p JOIN e ON max_posterior > lo AND max_posterior <= hi GROUP BY bucket)
SELECT CAST(bucket AS INTEGER) AS bucket, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi,
       coalesce(total, 0) AS total,
       coalesce(correct, 0) AS correct,
       round(CASE WHEN coalesce(total, 0) > 0 THEN correct / total ELSE 0.0 END, 9) AS accuracy
FROM e LEFT JOIN c USING (bucket)""")
def m06_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = M.calibration(_bnb(Tables(spark, sf_dir)), CALIBRATION_EDGES)
    return c.select("bucket", "lo", "hi", "total", "correct", F.round("accuracy", 9).alias("accuracy"))


@register("l09_gaussian_nb", sql=f"""
WITH tr AS {_TRAIN_IMG},
x AS (SELECT label, i - 1 AS idx, CAST(embedding[i] AS DOUBLE) AS v
      FROM (SELECT *, generate_subscripts(embedding, 1) AS i FROM tr)),
eps AS (SELECT max(vv) * 1e-9 AS eps FROM (SELECT idx, var_pop(v) AS vv FROM x GROUP BY idx)),
m AS (SELECT label, idx, avg(v) AS theta, var_pop(v) + (SELECT eps FROM eps) AS var FROM x GROUP BY 1, 2),
pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM tr)) AS prior FROM tr GROUP BY label),
dx AS (SELECT vec_id, i - 1 AS idx, CAST(embedding[i] AS DOUBLE) AS v
       FROM (SELECT *, generate_subscripts(embedding, 1) AS i FROM {_DEV_IMG})),
j AS (SELECT dx.vec_id, m.label AS cls,
             sum(-0.5 * ln(2 * pi() * var) - 0.5 * pow(v - theta, 2) / var) AS s
      FROM dx JOIN m USING (idx) GROUP BY 1, 2)
SELECT vec_id, cls AS prediction FROM (
  SELECT j.*, row_number() OVER (PARTITION BY vec_id ORDER BY s + prior DESC, cls) AS rn
  FROM j JOIN pr ON j.cls = pr.label) WHERE rn = 1""")
def l09_gaussian_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, dev = image_split(Tables(spark, sf_dir))
    model = B.fit_gaussian_nb(train, "embedding", "label")
    return B.predict_gaussian_nb(dev, model, "embedding").select("vec_id", "prediction")


@register("l10_bernoulli_samples")
def l10_bernoulli_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = image_split(Tables(spark, sf_dir))
    model = B.fit_bernoulli_nb(train, "embedding", "label", BNB_ALPHA)
    return B.sample_from_bernoulli(model, 20, seed=13)


@register("l12_cluster_radius", sql="""
WITH x AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS v
           FROM (SELECT *, generate_subscripts(embedding, 1) AS i FROM embeddings)),
c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2),
d AS (SELECT x.vec_id, x.label, sqrt(sum(pow(x.v - c.m, 2))) AS dist FROM x JOIN c USING (label, i)
      GROUP BY 1, 2)
SELECT label, round(max(dist), 9) AS radius FROM d GROUP BY label""")
def l12_cluster_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings
    r = NB.cluster_radius(e, NB.centroids(e, "embedding", "label"), "embedding", "label")
    return r.select("label", F.round("radius", 9).alias("radius"))


# ---------------------------------------------------------------- multinomial NB on text

def _mnb(t: Tables, fold, alphas, scored=None) -> DataFrame:
    """Documents of the scored folds, by models of the other folds; one read of the texts."""
    docs = t.documents.select("doc_id", F.col("lang").alias("label"), fold.alias("fold"), "text")
    return B.multinomial_nb(T.term_counts(docs, carry=("label", "fold")), docs.drop("text"), alphas, scored)


def mnb_sql(alpha: float, train_cond: str, dev_cond: str) -> str:
    return f"""(WITH tf AS {_TF_SQL}, lab AS (SELECT doc_id, lang AS label FROM documents),
tr AS (SELECT * FROM tf WHERE {train_cond}), dv AS (SELECT * FROM tf WHERE {dev_cond}),
v AS (SELECT DISTINCT term FROM tr),
nct AS (SELECT label, term, sum(tf) AS n_ct FROM tr JOIN lab USING (doc_id) GROUP BY 1, 2),
nc AS (SELECT label, sum(n_ct) AS n_c FROM nct GROUP BY 1),
dc AS (SELECT label, count(*) AS d_c FROM lab WHERE {train_cond} GROUP BY 1),
cls AS (SELECT label, ln(d_c / (SELECT sum(d_c) FROM dc)) AS prior,
               ln({alpha} / (n_c + {alpha} * (SELECT count(*) FROM v))) AS def FROM nc JOIN dc USING (label)),
x AS (SELECT * FROM dv WHERE term IN (SELECT term FROM v)),
tot AS (SELECT doc_id, sum(tf) AS n FROM x GROUP BY 1),
g AS (SELECT doc_id, label, sum(tf * (ln(n_ct + {alpha}) - ln({alpha}))) AS g FROM x JOIN nct USING (term)
      GROUP BY 1, 2),
s AS (SELECT tot.doc_id, cls.label AS cls, prior + n * def + coalesce(g.g, 0) AS jll
      FROM tot CROSS JOIN cls LEFT JOIN g ON g.doc_id = tot.doc_id AND g.label = cls.label),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY jll DESC, cls) AS rn,
             max(jll) OVER (PARTITION BY doc_id) AS top FROM s)
SELECT r.doc_id, r.cls AS prediction, lab.label, r.top - t.jll AS log_r_ratio
FROM r JOIN lab USING (doc_id) JOIN s t ON t.doc_id = r.doc_id AND t.cls = lab.label WHERE rn = 1)"""


_TEXT_SPLIT = hash_bucket_sql("doc_id", 100, 0)


@register("l08_multinomial_nb", sql=f"""
SELECT doc_id, prediction FROM {mnb_sql(1.0, f'{_TEXT_SPLIT} < 80', f'{_TEXT_SPLIT} >= 80')}""")
def l08_multinomial_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    dev = (hash_bucket("doc_id", 100, 0) >= 80).cast("int")
    return _mnb(Tables(spark, sf_dir), dev, [1.0], [1]).select("doc_id", "prediction")


@register("m07_r_ratio", sql=f"""
SELECT doc_id, prediction, label, round(log_r_ratio, 6) AS log_r_ratio
FROM {mnb_sql(1.0, f'{_TEXT_SPLIT} < 80', f'{_TEXT_SPLIT} >= 80')}
ORDER BY log_r_ratio DESC, doc_id LIMIT 3""")
def m07_r_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R = max probability / probability of the true class, top 3 (as ln R,
    which stays finite when the true class's probability underflows)."""
    dev = (hash_bucket("doc_id", 100, 0) >= 80).cast("int")
    p = _mnb(Tables(spark, sf_dir), dev, [1.0], [1])
    top = F.array_max(F.transform("scores", lambda s: s["jll"]))
    true = F.filter("scores", lambda s: s["label"] == F.col("label"))[0]["jll"]
    r = p.select("doc_id", "prediction", "label", F.round(top - true, 6).alias("log_r_ratio"))
    return r.orderBy(F.col("log_r_ratio").desc(), "doc_id").limit(3)


_ALPHAS = [0.01, 0.1, 1.0]


@register("m09_alpha_sweep", sql="WITH a AS (" + " UNION ALL ".join(
    f"SELECT {a} AS alpha, {f} AS fold, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS acc "
    f"FROM {mnb_sql(a, f'{hash_bucket_sql('doc_id', 2, 3)} != {f}', f'{hash_bucket_sql('doc_id', 2, 3)} = {f}')}"
    for a in _ALPHAS for f in (0, 1)) + """),
m AS (SELECT alpha, avg(acc) AS mean_score FROM a GROUP BY alpha)
SELECT CAST(alpha AS DOUBLE) AS alpha, round(mean_score, 9) AS mean_score,
       CAST(row_number() OVER (ORDER BY mean_score DESC, alpha) = 1 AS INTEGER) AS is_best FROM m""")
def m09_alpha_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean 2-fold accuracy of multinomial NB per smoothing value, best flagged: all
    folds and values by one join."""
    p = _mnb(Tables(spark, sf_dir), hash_bucket("doc_id", 2, 3), _ALPHAS)
    rows = p.groupBy("alpha", "fold").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc"))
    m = M.mean_by_param(rows, ["alpha"], "acc")
    return m.select("alpha", F.round("mean_score", 9).alias("mean_score"), "is_best")


# ---------------------------------------------------------------- rule predictions, metrics

_MARKERS = [("en", "the"), ("fr", "le"), ("de", "der"), ("es", "el")]


def lang_rule(t: Tables) -> DataFrame:
    """A rule classifier for the topic label: the language whose marker word is
    most frequent (first in marker order on ties)."""
    d = t.documents.select("doc_id", "lang", X.tokens("text").alias("toks"))
    def count_of(word: str):
        return F.size(F.filter("toks", lambda w: w == word))

    counts = [count_of(m) for _, m in _MARKERS]
    best = F.array_max(F.array(*counts))
    pred = F.element_at(F.array(*[F.lit(l) for l, _ in _MARKERS]),
                        F.array_position(F.array(*counts), best).cast("int"))
    return d.select("doc_id", F.col("lang").alias("label"), pred.alias("prediction"))


_RULE_SQL = rf"""(SELECT doc_id, lang AS label, CASE
  {' '.join(f"WHEN c_{l} = greatest({', '.join(f'c_{x}' for x, _ in _MARKERS)}) THEN '{l}'" for l, _ in _MARKERS)}
  END AS prediction FROM (SELECT doc_id, lang, {', '.join(
      f"len(list_filter(toks, lambda w: w = '{m}')) AS c_{l}" for l, m in _MARKERS)}
  FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS toks
        FROM documents)))"""

_BIN_SQL = """(SELECT doc_id, quality AS label, CAST(n_chars >= {cut} AS INTEGER) AS prediction
               FROM labels JOIN documents USING (doc_id))"""


def _binary_preds(t: Tables, cut: int) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("label"),
        (F.col("n_chars") >= cut).cast("int").alias("prediction"))


def _metrics_sql(src: str) -> str:
    return f"""(WITH c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE label != 1 AND prediction != 1) AS tn,
       count(*) FILTER (WHERE label != 1 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction != 1) AS fn FROM {src}),
m AS (SELECT *, CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0.0 END AS accuracy,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision FROM c)
SELECT tp, tn, fp, fn, round(accuracy, 9) AS accuracy, round(recall, 9) AS recall,
       round(precision, 9) AS precision,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END,
             9) AS f1 FROM m)"""


def _round_metrics(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if c in ("accuracy", "recall", "precision", "f1")
                       else F.col(c) for c in df.columns])


@register("m01_binary_metrics", sql=f"SELECT * FROM {_metrics_sql(_BIN_SQL.format(cut=2000))}")
def m01_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_metrics(M.binary_metrics(_binary_preds(Tables(spark, sf_dir), 2000)))


@register("m08_comparison", sql=f"""
SELECT 'chars_2000' AS model, * FROM {_metrics_sql(_BIN_SQL.format(cut=2000))}
UNION ALL SELECT 'chars_1000' AS model, * FROM {_metrics_sql(_BIN_SQL.format(cut=1000))}""")
def m08_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return M.comparison_table({f"chars_{c}": _round_metrics(M.binary_metrics(_binary_preds(t, c)))
                               for c in (2000, 1000)})


@register("m02_class_report", sql=f"""
WITH p AS {_RULE_SQL},
s AS (SELECT label AS cls, count(*) AS support FROM p GROUP BY 1),
pc AS (SELECT prediction AS cls, count(*) AS predicted FROM p GROUP BY 1),
tp AS (SELECT label AS cls, count(*) AS tp FROM p WHERE label = prediction GROUP BY 1),
x AS (SELECT coalesce(s.cls, pc.cls) AS cls, coalesce(support, 0) AS support,
             coalesce(predicted, 0) AS predicted, coalesce(tp.tp, 0) AS tp
      FROM s FULL JOIN pc ON s.cls = pc.cls LEFT JOIN tp ON tp.cls = coalesce(s.cls, pc.cls)),
y AS (SELECT cls, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM x)
SELECT cls, round(precision, 9) AS precision, round(recall, 9) AS recall, support,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END,
             9) AS f1 FROM y""")
def m02_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = M.per_class_report(lang_rule(Tables(spark, sf_dir)))
    return r.select("cls", *[F.round(c, 9).alias(c) for c in ("precision", "recall")], "support",
                    F.round("f1", 9).alias("f1"))


@register("m02_weighted_f1", sql=f"""
WITH p AS {_RULE_SQL},
s AS (SELECT label AS cls, count(*) AS support FROM p GROUP BY 1),
pc AS (SELECT prediction AS cls, count(*) AS predicted FROM p GROUP BY 1),
tp AS (SELECT label AS cls, count(*) AS tp FROM p WHERE label = prediction GROUP BY 1),
x AS (SELECT s.cls, support, coalesce(predicted, 0) AS predicted, coalesce(tp.tp, 0) AS tp
      FROM s LEFT JOIN pc USING (cls) LEFT JOIN tp USING (cls)),
y AS (SELECT support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
             tp / support AS rc FROM x)
SELECT round(sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * support) / sum(support), 9)
       AS weighted_f1 FROM y""")
def m02_weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = M.per_class_report(lang_rule(Tables(spark, sf_dir)))
    return M.weighted_f1(r).select(F.round("weighted_f1", 9).alias("weighted_f1"))


_CM_SQL = f"""(WITH p AS {_RULE_SQL},
c AS (SELECT DISTINCT label AS v FROM p UNION SELECT DISTINCT prediction FROM p),
n AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2)
SELECT a.v AS label, b.v AS prediction, coalesce(n.n, 0) AS n FROM c a CROSS JOIN c b
LEFT JOIN n ON n.label = a.v AND n.prediction = b.v)"""


@register("m03_confusion_matrix", sql=f"SELECT * FROM {_CM_SQL}")
def m03_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion_matrix(lang_rule(Tables(spark, sf_dir)))


@register("m04_most_confused", sql=f"""
WITH m AS {_CM_SQL},
top AS (SELECT label, prediction FROM m WHERE label != prediction ORDER BY n DESC, label, prediction LIMIT 1)
SELECT p.doc_id, p.label, p.prediction FROM {_RULE_SQL} p JOIN top USING (label, prediction)""")
def m04_most_confused(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = lang_rule(Tables(spark, sf_dir))
    top = M.most_confused(M.confusion_matrix(preds)).select("label", "prediction")
    return preds.join(top, ["label", "prediction"], "left_semi").select("doc_id", "label", "prediction")


# ---------------------------------------------------------------- ensemble


def _vocab_share(t: Tables) -> DataFrame:
    """Text score in [0, 1]: share of a document's tokens found in ``benchmark``."""
    vocab = t.benchmark.select(F.explode(X.tokens("text")).alias("term")).distinct()
    return T.vocabulary_share(t.documents.select("doc_id", "text"), vocab).withColumnRenamed("share", "p_text")


@register("l19_or_ensemble", sql=f"""
WITH tf AS {_TF_SQL}, v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'))
                            AS term FROM benchmark),
s AS (SELECT doc_id, coalesce(sum(tf) FILTER (WHERE term IN (SELECT term FROM v)), 0) / sum(tf) AS p_text
      FROM tf GROUP BY doc_id)
SELECT l.doc_id, CAST((d.n_chars >= 2000) OR coalesce(s.p_text >= 0.499, false) AS INTEGER) AS prediction
FROM labels l JOIN documents d USING (doc_id) LEFT JOIN s USING (doc_id)""")
def l19_or_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive when the tabular rule says 1 or the text score is >= .499."""
    t = Tables(spark, sf_dir)
    tab = _binary_preds(t, 2000).select("doc_id", F.col("prediction").alias("p_tab"))
    x = tab.join(_vocab_share(t), "doc_id", "left")
    return x.select("doc_id", ((F.col("p_tab") == 1) | F.coalesce(F.col("p_text") >= 0.499, F.lit(False)))
                    .cast("int").alias("prediction"))
