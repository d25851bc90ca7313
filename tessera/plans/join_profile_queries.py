"""Registered queries for joins (J) and aggregation / profiling (A)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import micros
from tessera.operators import joins as J
from tessera.operators import profile as P
from tessera.operators.ranking import box_plot, exact_quantiles
from tessera.plans.core_queries import ASOF_BUCKET_SECONDS, _EVENTS_SQL, _J04_SQL, clean_events, enriched_purchases
from tessera.plans.registry import register
from tessera.sources.tables import Tables


def _route_fact(t: Tables) -> DataFrame:
    """lineitem with the customer's and the supplier's nation (J-01 roles)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    fact = li.join(o, li["l_orderkey"] == o["o_orderkey"]) \
             .join(c, F.col("o_custkey") == F.col("c_custkey")) \
             .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return J.role_join(fact, t.nation, "n_nationkey",
                       {"c_nationkey": "CUST_", "s_nationkey": "SUPP_"},
                       ["n_name", "n_regionkey"])


_ROUTE_SQL = """
(SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, c.c_nationkey, s.s_nationkey,
        cn.n_name AS CUST_n_name, cn.n_regionkey AS CUST_n_regionkey,
        sn.n_name AS SUPP_n_name, sn.n_regionkey AS SUPP_n_regionkey
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
 JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN supplier s ON l.l_suppkey = s.s_suppkey
 LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
 LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey)"""


@register("j01_role_join", sql=f"""
SELECT l_orderkey, l_linenumber, CUST_n_name, CUST_n_regionkey, SUPP_n_name, SUPP_n_regionkey
FROM {_ROUTE_SQL}""")
def j01_role_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _route_fact(Tables(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "CUST_n_name", "CUST_n_regionkey", "SUPP_n_name",
        "SUPP_n_regionkey")


@register("w01_nearest_ties", sql="""
SELECT s_nationkey, s_suppkey, s_acctbal FROM (
  SELECT *, min(s_acctbal) OVER (PARTITION BY s_nationkey) AS best FROM supplier)
WHERE s_acctbal = best""")
def w01_nearest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = Tables(spark, sf_dir).supplier.select("s_nationkey", "s_suppkey", "s_acctbal")
    return J.nearest_per_group(sup, "s_nationkey", "s_acctbal", keep_ties=True)


@register("j02_nearest_attach", sql="""
WITH n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey
                                                       ORDER BY s_acctbal, s_suppkey) AS rn
                          FROM supplier) WHERE rn = 1)
SELECT c_custkey, n.s_suppkey AS nearest_suppkey, n.s_acctbal AS nearest_acctbal
FROM customer LEFT JOIN n ON customer.c_nationkey = n.s_nationkey""")
def j02_nearest_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    sup = t.supplier.select("s_nationkey", "s_suppkey", "s_acctbal")
    nearest = J.nearest_per_group(sup, "s_nationkey", "s_acctbal", keep_ties=False,
                                  tiebreak=["s_suppkey"])
    cust = t.customer.select("c_custkey", "c_nationkey")
    return cust.join(nearest, cust["c_nationkey"] == nearest["s_nationkey"], "left").select(
        "c_custkey", F.col("s_suppkey").alias("nearest_suppkey"),
        F.col("s_acctbal").alias("nearest_acctbal"))


@register("j03_range_max", sql=f"""
SELECT p.event_id, max(epoch_us(v.ts)) AS latest_right_us
FROM (SELECT event_id, user_id, ts FROM {_EVENTS_SQL} WHERE event_type = 'purchase') p
JOIN (SELECT user_id, ts FROM {_EVENTS_SQL} WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND v.ts <= p.ts - INTERVAL 2 HOUR
GROUP BY p.event_id""")
def j03_range_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest right time at or before the cut-off, matched rows only.

    Answered by the as-of operator (no pairwise fan-out); the reference's
    join + filter + group max is kept as the brute-force check in the tests.
    """
    ev = clean_events(Tables(spark, sf_dir))
    left = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    j = J.asof_join(left, right, "user_id", "ts", "view_ts", ["view_ts"], lead_seconds=7200,
                    right_tiebreak="view_id", bucket_seconds=ASOF_BUCKET_SECONDS)
    return j.where(F.col("view_ts").isNotNull()) \
            .select("event_id", micros("view_ts").alias("latest_right_us"))


@register("a08_group_max", sql=f"""
SELECT user_id, max(epoch_us(ts)) AS latest_view_us FROM {_EVENTS_SQL}
WHERE event_type = 'view' GROUP BY user_id""")
def a08_group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = clean_events(Tables(spark, sf_dir)).where(F.col("event_type") == "view")
    return P.window_free_max(ev.withColumn("_us", micros("ts")), ["user_id"], "_us",
                             "latest_view_us")


@register("j05_multikey", sql="""
WITH l AS (SELECT l_orderkey, year(l_shipdate) AS ship_year, count(*) AS n_lines,
                  sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey, l.n_lines, l.qty FROM orders o
LEFT JOIN l ON o.o_orderkey = l.l_orderkey AND year(o.o_orderdate) = l.ship_year""")
def j05_multikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    l = t.lineitem.groupBy("l_orderkey", F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("ship_year"))
    return o.join(l.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey", "ship_year"],
                  "left").select("o_orderkey", "n_lines", "qty")


@register("j06_stats_attach", sql="""
SELECT l_orderkey, l_linenumber,
       round(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem), 6) AS price_dev,
       round(l_quantity / nullif((SELECT max(l_quantity) FROM lineitem), 0), 6) AS qty_share
FROM lineitem""")
def j06_stats_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row statistics attached to every row as scalar subqueries: Catalyst
    merges them into one aggregate job and inlines the values (no cross join)."""
    li = Tables(spark, sf_dir).lineitem
    mean = li.select(F.avg("l_extendedprice")).scalar()
    top = li.select(F.max("l_quantity")).scalar()
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.col("l_extendedprice") - mean, 6).alias("price_dev"),
                     F.round(F.col("l_quantity") / F.nullif(top, F.lit(0.0)), 6).alias("qty_share"))


@register("j07_inner_key", sql="""
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def j07_inner_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(n, "c_nationkey").select("c_custkey", "n_name")


@register("j08_keyed_concat", sql="""
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1),
b AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n_shipped FROM lineitem GROUP BY 1)
SELECT day, n_orders, n_shipped FROM a JOIN b USING (day)""")
def j08_keyed_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-wise concatenation of two daily series on the explicit date key."""
    t = Tables(spark, sf_dir)
    a = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_shipped"))
    return a.join(b, "day")


@register("a02_edge_list", sql=f"""
SELECT c_nationkey AS src, s_nationkey AS dst, CUST_n_regionkey AS src_region,
       SUPP_n_regionkey AS dst_region, count(*) AS n,
       min(CUST_n_name) AS src_name, min(SUPP_n_name) AS dst_name
FROM {_ROUTE_SQL} GROUP BY 1, 2, 3, 4""")
def a02_edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _route_fact(Tables(spark, sf_dir)).select(
        F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst"),
        F.col("CUST_n_regionkey").alias("src_region"), F.col("SUPP_n_regionkey").alias("dst_region"),
        "CUST_n_name", "SUPP_n_name")
    return P.edge_list(fact, ["src", "dst", "src_region", "dst_region"],
                       {"src_name": "CUST_n_name", "dst_name": "SUPP_n_name"})


@register("a03_counts", sql="""
SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers,
       count(DISTINCT CAST(o_orderdate AS DATE)) AS n_days FROM orders""")
def a03_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    return o.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("o_custkey").alias("n_customers"),
                 F.count_distinct(F.to_date("o_orderdate")).alias("n_days"))


@register("a04_minmax", sql="""
SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders""")
def a04_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    return o.agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@register("a05_null_profile", sql=f"""
WITH j AS ({_J04_SQL}), c AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE event_id IS NULL) AS event_id,
  count(*) FILTER (WHERE user_id IS NULL) AS user_id,
  count(*) FILTER (WHERE view_id IS NULL) AS view_id,
  count(*) FILTER (WHERE view_value IS NULL) AS view_value FROM j)
SELECT column_name, n_null, round(n_null * 100.0 / nullif(n, 0), 2) AS pct_null,
       (n_null = n AND n > 0) AS all_null
FROM c UNPIVOT (n_null FOR column_name IN (event_id, user_id, view_id, view_value))""")
def a05_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = enriched_purchases(clean_events(Tables(spark, sf_dir)))
    return P.null_profile(j)


@register("a06_class_balance", sql="""
SELECT count(*) FILTER (WHERE quality = 1) AS n_pos, count(*) FILTER (WHERE quality != 1) AS n_neg,
       count(*) FILTER (WHERE quality = 1) * 100.0 / nullif(count(quality), 0) AS pct_pos
FROM labels""")
def a06_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.class_balance(Tables(spark, sf_dir).labels, "quality", 1)


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a07_describe", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"""
                                                for c in _NUM))
def a07_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = P.describe_long(Tables(spark, sf_dir).lineitem, _NUM)
    return d.select("column_name", "n", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"), "min", "max")


@register("a09_correlation", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM lineitem"
    for i, a in enumerate(_NUM) for b in _NUM[i + 1:]))
def a09_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = P.correlation_long(Tables(spark, sf_dir).lineitem, _NUM)
    return c.select("col_a", "col_b", F.round("r", 9).alias("r"))


@register("a10_class_counts", sql="""
SELECT quality, count(*) AS n FROM labels GROUP BY quality""")
def a10_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).labels.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@register("a11_rate_by_source", sql="""
SELECT source, count(*) AS n, round(avg(CAST(quality AS DOUBLE)), 9) AS rate
FROM documents JOIN labels USING (doc_id) GROUP BY source""")
def a11_rate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    x = t.documents.select("doc_id", "source").join(t.labels, "doc_id")
    return P.rate_by(x, ["source"], "quality").withColumn("rate", F.round("rate", 9))


@register("a12_histogram", sql="""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 10.0)), 9)
                  END AS INTEGER) AS bin, lo, hi FROM lineitem, s WHERE l_extendedprice IS NOT NULL)
SELECT bin, count(*) AS n, round(min(lo) + bin * (min(hi) - min(lo)) / 10.0, 6) AS bin_lo,
       round(min(lo) + (bin + 1) * (min(hi) - min(lo)) / 10.0, 6) AS bin_hi FROM b GROUP BY bin""")
def a12_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = P.histogram(Tables(spark, sf_dir).lineitem, "l_extendedprice", 10)
    return h.select("bin", "n", F.round("bin_lo", 6).alias("bin_lo"),
                    F.round("bin_hi", 6).alias("bin_hi"))


@register("a13_five_number", sql="""
SELECT min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 6) AS q3, max(l_extendedprice) AS max
FROM lineitem""")
def a13_five_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    q = exact_quantiles(li, "l_extendedprice", [0.0, 0.25, 0.5, 0.75, 1.0],
                        ["min", "q1", "median", "q3", "max"])
    return q.select("min", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "max")


@register("a13_box_plot", sql="""
WITH f AS (SELECT l_returnflag AS flag, l_linestatus AS status, min(l_extendedprice) AS min,
  quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
  quantile_cont(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS max
  FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM f)
SELECT flag, status, count(*) AS n, any_value(min) AS min, round(any_value(q1), 6) AS q1,
  round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3, any_value(max) AS max,
  round(any_value(lower_fence), 6) AS lower_fence, round(any_value(upper_fence), 6) AS upper_fence,
  min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lower_fence AND upper_fence) AS lower_whisker,
  max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lower_fence AND upper_fence) AS upper_whisker,
  count(*) FILTER (WHERE l_extendedprice NOT BETWEEN lower_fence AND upper_fence) AS n_outliers
FROM b JOIN lineitem ON l_returnflag = flag AND l_linestatus = status GROUP BY 1, 2""")
def a13_box_plot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot data per group: quartiles, fences, whiskers and outliers."""
    li = Tables(spark, sf_dir).lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
                                               "l_extendedprice")
    b = box_plot(li, "l_extendedprice", by=["flag", "status"])
    return b.select(*[F.round(c, 6).alias(c) if c in ("q1", "median", "q3", "lower_fence", "upper_fence") else c
                      for c in b.columns])


@register("a14_ledger", sql="""
SELECT 'raw' AS stage, year(o_orderdate) AS part, count(*) AS n_rows FROM orders GROUP BY 2
UNION ALL
SELECT 'not_pending', year(o_orderdate), count(*) FROM orders WHERE o_orderstatus != 'P' GROUP BY 2
UNION ALL
SELECT 'with_customer', year(o_orderdate), count(*) FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey WHERE o_orderstatus != 'P' GROUP BY 2""")
def a14_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    raw = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    kept = raw.where(F.col("o_orderstatus") != "P")
    joined = kept.join(t.customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    return P.row_count_ledger({"raw": raw, "not_pending": kept, "with_customer": joined},
                              by=F.year("o_orderdate"), by_name="part") \
        .select("stage", F.col("part").cast("long").alias("part"), "n_rows")


@register("a16_least_squares", sql="""
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 9) AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem""")
def a16_least_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = P.least_squares(Tables(spark, sf_dir).lineitem, "l_extendedprice", "l_quantity")
    return r.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
                    F.round("r2", 9).alias("r2"), "n")
