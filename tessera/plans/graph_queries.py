"""Registered queries for graph features (G), J-09 and N-02.

Route graph: customer nation -> supplier nation over all lineitem rows,
weighted by line count. PageRank fixture with dangling nodes: customer ->
supplier, weighted by line count (suppliers have no out-edges).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators.encode import zscore
from tessera.plans.join_profile_queries import _ROUTE_SQL, _route_fact
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources.tables import Tables

ROUNDS = 20
ALPHA = 0.85


def nation_edges(t: Tables) -> DataFrame:
    return G.weighted_edges(_route_fact(t), "c_nationkey", "s_nationkey")


_NATION_EDGES_SQL = f"""(SELECT c_nationkey AS src, s_nationkey AS dst, CAST(count(*) AS DOUBLE) AS weight
                         FROM {_ROUTE_SQL} GROUP BY 1, 2)"""


def customer_supplier_edges(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    fact = li.join(o, "l_orderkey").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("c"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("s"))
    return G.weighted_edges(fact, "c", "s")


_CS_EDGES_SQL = """(SELECT 'c' || CAST(o.o_custkey AS VARCHAR) AS src, 's' || CAST(l.l_suppkey AS VARCHAR) AS dst,
                           CAST(count(*) AS DOUBLE) AS weight
                    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""


def pagerank_sql(edges_sql: str, rounds: int = ROUNDS, alpha: float = ALPHA) -> str:
    """Unrolled fixed-round PageRank in SQL (the oracle)."""
    parts = [f"e AS MATERIALIZED {edges_sql}",
             "nodes AS MATERIALIZED (SELECT src AS node FROM e UNION SELECT dst FROM e)",
             "cnt AS MATERIALIZED (SELECT count(*) AS n FROM nodes)",
             "ow AS MATERIALIZED (SELECT src, sum(weight) AS w FROM e GROUP BY src)",
             "en AS MATERIALIZED (SELECT e.src, e.dst, e.weight / ow.w AS p FROM e JOIN ow USING (src))",
             "dang AS MATERIALIZED (SELECT node FROM nodes WHERE node NOT IN (SELECT src FROM ow))",
             "r0 AS MATERIALIZED (SELECT node, 1.0 / (SELECT n FROM cnt) AS r FROM nodes)"]
    for k in range(1, rounds + 1):
        p = f"r{k - 1}"
        parts.append(f"""r{k} AS MATERIALIZED (
  SELECT nodes.node, {alpha} * coalesce(c.s, 0) +
         ({alpha} * (SELECT coalesce(sum(r), 0) FROM {p} WHERE node IN (SELECT node FROM dang))
          + {1 - alpha}) / (SELECT n FROM cnt) AS r
  FROM nodes LEFT JOIN (SELECT en.dst, sum({p}.r * en.p) AS s FROM en JOIN {p} ON en.src = {p}.node
                        GROUP BY en.dst) c ON nodes.node = c.dst)""")
    return "WITH " + ",\n".join(parts) + f"\nSELECT node, round(r, 12) AS rank FROM r{rounds}"


@register("g01_edges", sql=f"SELECT src, dst, weight FROM {_NATION_EDGES_SQL}")
def g01_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nation_edges(Tables(spark, sf_dir))


_DEGREE_SQL = f"""
WITH e AS {_NATION_EDGES_SQL}, nodes AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
o AS (SELECT src AS node, count(DISTINCT dst) AS d FROM e GROUP BY 1),
i AS (SELECT dst AS node, count(DISTINCT src) AS d FROM e GROUP BY 1)
SELECT nodes.node, (coalesce(o.d, 0) + coalesce(i.d, 0)) / ((SELECT count(*) FROM nodes) - 1.0)
       AS degree_centrality
FROM nodes LEFT JOIN o USING (node) LEFT JOIN i USING (node)"""


@register("g02_degree", sql=f"SELECT node, round(degree_centrality, 9) AS degree_centrality FROM ({_DEGREE_SQL})")
def g02_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = G.degree_centrality(cut_lineage(nation_edges(Tables(spark, sf_dir))))
    return d.select("node", F.round("degree_centrality", 9).alias("degree_centrality"))


@register("g03_pagerank", sql=pagerank_sql(_CS_EDGES_SQL))
def g03_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = G.pagerank(customer_supplier_edges(Tables(spark, sf_dir)), ALPHA, fixed_rounds=ROUNDS)
    return r.select("node", F.round("rank", 12).alias("rank"))


@register("g03_pagerank_converged")
def g03_pagerank_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library defaults: up to 100 rounds, stop at L1 change < n * 1e-6."""
    return G.pagerank(nation_edges(Tables(spark, sf_dir)), ALPHA)


def nation_metrics(t: Tables) -> DataFrame:
    e = cut_lineage(nation_edges(t))  # read by both metrics
    d = G.degree_centrality(e)
    r = G.pagerank(e, ALPHA, fixed_rounds=ROUNDS).withColumnRenamed("rank", "page_rank")
    return cut_lineage(d.join(r, "node"))


_NATION_METRICS_SQL = f"""(SELECT d.node, d.degree_centrality, p.r AS page_rank
   FROM ({_DEGREE_SQL}) d JOIN ({pagerank_sql(_NATION_EDGES_SQL).replace(
       'SELECT node, round(r, 12) AS rank FROM r20', 'SELECT node, r FROM r20')}) p USING (node))"""


@register("g04_metrics_sorted", sql=f"""
SELECT node, round(degree_centrality, 9) AS degree_centrality, round(page_rank, 12) AS page_rank
FROM {_NATION_METRICS_SQL}""")
def g04_metrics_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = nation_metrics(Tables(spark, sf_dir))
    return m.orderBy(F.col("degree_centrality").desc(), "node").select(
        "node", F.round("degree_centrality", 9).alias("degree_centrality"),
        F.round("page_rank", 12).alias("page_rank"))


@register("g05_route_map", sql=f"""
SELECT c_nationkey AS src, s_nationkey AS dst, count(*) AS n,
       min(CUST_n_regionkey) AS src_region, min(SUPP_n_regionkey) AS dst_region
FROM {_ROUTE_SQL} WHERE c_nationkey = 7 GROUP BY 1, 2""")
def g05_route_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-pair counts with end attributes, for one origin (a parameter)."""
    fact = _route_fact(Tables(spark, sf_dir)).where(F.col("c_nationkey") == 7)
    return fact.groupBy(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).agg(
        F.count(F.lit(1)).alias("n"), F.min("CUST_n_regionkey").alias("src_region"),
        F.min("SUPP_n_regionkey").alias("dst_region"))


@register("j09_graph_attach", sql=f"""
WITH m AS {_NATION_METRICS_SQL}
SELECT f.l_orderkey, f.l_linenumber, round(a.degree_centrality, 9) AS CUST_degree_centrality,
       round(a.page_rank, 12) AS CUST_page_rank, round(b.degree_centrality, 9) AS SUPP_degree_centrality,
       round(b.page_rank, 12) AS SUPP_page_rank
FROM {_ROUTE_SQL} f LEFT JOIN m a ON f.c_nationkey = a.node LEFT JOIN m b ON f.s_nationkey = b.node""")
def j09_graph_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    m = nation_metrics(t)
    x = G.attach_node_metrics(_route_fact(t), m, {"c_nationkey": "CUST_", "s_nationkey": "SUPP_"})
    return x.select("l_orderkey", "l_linenumber",
                    F.round("CUST_degree_centrality", 9).alias("CUST_degree_centrality"),
                    F.round("CUST_page_rank", 12).alias("CUST_page_rank"),
                    F.round("SUPP_degree_centrality", 9).alias("SUPP_degree_centrality"),
                    F.round("SUPP_page_rank", 12).alias("SUPP_page_rank"))


@register("n02_node_zscore", sql=f"""
WITH m AS {_NATION_METRICS_SQL}
SELECT node, round((degree_centrality - (SELECT avg(degree_centrality) FROM m))
                   / nullif((SELECT stddev_samp(degree_centrality) FROM m), 0), 6) AS degree_centrality_scaled,
       round((page_rank - (SELECT avg(page_rank) FROM m))
             / nullif((SELECT stddev_samp(page_rank) FROM m), 0), 6) AS page_rank_scaled
FROM m""")
def n02_node_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = zscore(nation_metrics(Tables(spark, sf_dir)), ["degree_centrality", "page_rank"], keep=["node"])
    return z.select("node", F.round("degree_centrality_scaled", 6).alias("degree_centrality_scaled"),
                    F.round("page_rank_scaled", 6).alias("page_rank_scaled"))
