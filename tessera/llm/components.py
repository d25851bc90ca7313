"""Connected components of an edge table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node) of every node of ``edges`` (a, b).

    Alternates two steps until nothing changes: every node hands the least of
    its neighbours and itself to its larger neighbours, then to its smaller
    ones. Only the number of edges and a checksum reach the driver. A node with
    very many edges is one group of an aggregation summed within each task and
    the hot key of a join that adaptive execution splits.
    """
    edges = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a != b").distinct())
    before = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        edges = larger.where("a != b").distinct()
        # small star: b's smaller neighbours and b itself are tied to the least of them
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        smaller = edges.join(least, "b")
        edges = cut_lineage(
            smaller.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a != b").distinct())
        after = _digest(edges)
        if after == before:
            break
        before = after
    # now every node is tied to the least node of its component alone
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
