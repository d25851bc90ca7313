"""Graph metrics on an edge table (G-01 .. G-05, J-09).

A directed weighted graph is an edge table ``(src, dst, weight)`` plus the node
table derived from it. Degree centrality is two aggregates; PageRank is an
iterative DataFrame job: nodes are dealt to parts and numbered within them, and
edges are kept once as arrays of numbers by blocks of their source's part
(persisted on disk as they are dealt, so they are never shuffled again). In a
round (one job) the parts send their ranks to their blocks, the blocks one sum
per node that they lead to, and the ranks are written to the shared checkpoint
directory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import topics as TP
from tessera.session import cut_lineage, scratch_path


def weighted_edges(facts: DataFrame, src: str, dst: str, weight: str | None = None) -> DataFrame:
    """G-01: one row per (src, dst) with the summed weight (row count by default)."""
    w = F.col(weight) if weight else F.lit(1)
    return facts.where(F.col(src).isNotNull() & F.col(dst).isNotNull()) \
                .groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")) \
                .agg(F.sum(w).cast("double").alias("weight"))


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).union(edges.select(F.col("dst").alias("node"))) \
                .distinct()


def degree_centrality(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """G-02: (distinct out-neighbours + distinct in-neighbours) / (n - 1).

    A self loop counts once in each direction, as in a directed graph library.
    """
    nodes = nodes if nodes is not None else nodes_of(edges)
    pairs = edges.select("src", "dst").distinct()
    out_deg = pairs.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("_out"))
    in_deg = pairs.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("_in"))
    n = nodes.select(F.count(F.lit(1))).scalar()
    x = nodes.join(out_deg, "node", "left").join(in_deg, "node", "left")
    deg = F.coalesce(F.col("_out"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0))
    return x.select("node", F.when(n > 1, deg / (n - 1)).otherwise(F.lit(0.0))
                    .alias("degree_centrality"))


#: Edges of a part's nodes that are kept in one block; the edges of a hub are dealt to several.
HUB_EDGES = 2_000_000
#: Nodes of one part on the average, and the parts that smaller graphs of so many nodes are dealt to.
PART_NODES, PARTS, SMALL_PART = 65_536, 24, 2_048


def _start_ranks(rank: float):
    """A part's mail before the first round: equal ranks, the places of its dangling nodes."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["i"].to_numpy())
        dangling = np.flatnonzero(table["dangling"].to_numpy(zero_copy_only=False)[order]).astype(np.int32)
        x = np.full(len(order), rank)
        return TP._mail([("r", table["p"][0].as_py(), -1, dangling, x, np.array([x[dangling].sum(), 0.0]))])

    return run


def _new_ranks(alpha: float, base: float):
    """A part's new ranks from its mail: the old ones (r) and sums of what edges bring (b)."""
    def run(key: tuple[pa.Scalar, ...], mail: pa.Table) -> pa.Table:
        rows = list(zip(*(mail[c].to_pylist() for c in ("kind", "frm", "idx", "x"))))
        _, _, places, old = next(r for r in rows if r[0] == "r")
        dangling, old = np.frombuffer(places, np.int32), np.frombuffer(old, np.float64)
        x = np.zeros(len(old))
        for _, _, at, sums in sorted((r for r in rows if r[0] == "b"), key=lambda r: r[1]):
            x[np.frombuffer(at, np.int32)] += np.frombuffer(sums, np.float64)
        new = alpha * x + base
        return TP._mail([("r", key[0].as_py(), -1, dangling, new, np.array([new[dangling].sum(), np.abs(new - old).sum()]))])

    return run


def _sent_on(key: tuple[pa.Scalar, ...], kept: pa.Table, mail: pa.Table) -> pa.Table:
    """What a block's edges bring: one sum per node that they lead to, by the node's part."""
    out = []
    for row in kept.to_pylist():
        d, t, parts, places = (np.frombuffer(row[c], np.int32) for c in ("d", "t", "term_part", "term_at"))
        rank = np.frombuffer(mail["x"][0].as_py(), np.float64)
        first, n = int(t[0]), int(t[-1]) - int(t[0]) + 1
        out.append((row["seq"], np.bincount(t - first, np.frombuffer(row["v"], np.float64) * rank[d], n), first, parts, places))
    if not out:
        return TP._mail([])
    out.sort(key=lambda o: o[0])
    parts, places = (np.concatenate([o[c] for o in out]) for c in (3, 4))
    sums = np.zeros(len(parts))
    for _, x, first, _, _ in out:
        sums[first:first + len(x)] += x
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
    return TP._mail([("b", int(parts[a]), key[0].as_py(), places[a:e], sums[a:e], None) for a, e in zip(cuts, cuts[1:])])


def pagerank(edges: DataFrame, alpha: float = 0.85, max_iter: int = 100, tol: float = 1e-6,
             fixed_rounds: int | None = None, partitions: int | None = None) -> DataFrame:
    """G-03: weighted PageRank with uniform teleport and uniform dangling mass.

    Each round: r'(v) = alpha * sum_{u->v} r(u) w(u,v) / W(u)
                        + (alpha * sum_{dangling d} r(d) + 1 - alpha) / n.
    Stops when the L1 change is below ``n * tol`` or after ``max_iter`` rounds;
    ``fixed_rounds`` runs exactly that many rounds without the test.

    A round is one job: a part's ranks go to the blocks of its edges, each block adds
    up what its edges bring to a node, and the node's part adds up the blocks' sums.
    The dangling mass and the change are summed over the written ranks; two tables take
    turns, so the scratch space holds two rounds. A part with more than ``HUB_EDGES``
    edges has several blocks, to which they are dealt by target (so a hub's edges are,
    too). Blocks are dealt to ``partitions``, else to three each or as many as a shuffle has. No setting of the
    session is changed.
    """
    spark = edges.sparkSession
    edges = cut_lineage(edges.select("src", "dst", "weight"))
    e = edges.where((F.col("weight") > 0) & F.col("src").isNotNull())
    sources = e.groupBy("src").agg(F.sum("weight").alias("_w"))
    nodes = cut_lineage(nodes_of(edges))
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    n_parts = max(1, min(PARTS, n // SMALL_PART), n // PART_NODES)
    nodes = cut_lineage(TP._numbered(nodes, "node", n_parts).join(
        sources.select(F.col("src").alias("node"), F.lit(False).alias("dangling"), "_w"), "node", "left")
        .select("node", "p", "i", "_w", F.coalesce("dangling", F.lit(True)).alias("dangling")))
    ends = nodes.select(F.col("node").alias("dst"), F.col("p").alias("q"), F.col("i").alias("j"))
    flows = e.join(nodes.select(F.col("node").alias("src"), "p", "i", "_w"), "src")
    flows = cut_lineage(flows.join(ends, flows["dst"].eqNullSafe(ends["dst"])).select(
        "p", "q", "j", "i", (F.col("weight") / F.col("_w")).alias("v")))
    n_blocks = {r["p"]: -(-r["n"] // HUB_EDGES) for r in flows.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_blocks = [n_blocks.get(p, 0) for p in range(n_parts)]
    blocks = F.array(*[F.lit(b) for b in n_blocks])
    first_block = F.array(*[F.lit(sum(n_blocks[:p])) for p in range(n_parts)])
    dealt = flows.withColumn("p", (first_block[F.col("p")] + F.pmod(F.xxhash64("q", "j"), blocks[F.col("p")])).cast("int"))
    if not partitions:  # Spark deals rows again that lie in fewer parts than a shuffle has; small graphs may be
        least = int(spark.conf.get("spark.sql.shuffle.partitions")) if sum(n_blocks) >= PARTS else 1
        partitions = max(3 * sum(n_blocks), least)
    dealt = dealt.repartition(partitions, "p").sortWithinPartitions("p", "q", "j")
    # a checkpoint does not remember how its rows are dealt, persisted rows do; lost ones are read from the table again
    kept = cut_lineage(dealt.mapInArrow(TP._kept_rows, TP._ROW)).repartition(partitions, "p").persist(StorageLevel.DISK_ONLY)
    kept.count()  # how they are dealt is known once they are there

    paths = [scratch_path(spark, "pagerank-a"), scratch_path(spark, "pagerank-b")]
    ranks = cut_lineage(nodes.groupBy("p").applyInArrow(_start_ranks(1.0 / n), TP._MAIL), path=paths[1])
    try:
        for i in range(fixed_rounds if fixed_rounds is not None else max_iter):
            dangling_mass = ranks.agg(F.sum(F.col("stats")[0])).first()[0]
            # a part without edges has no block
            told = ranks.where(blocks[F.col("to")] > 0).select(F.explode(F.sequence(
                first_block[F.col("to")], first_block[F.col("to")] + blocks[F.col("to")] - 1)).alias("to"), "x")
            brought = kept.groupBy("p").cogroup(told.groupBy("to")).applyInArrow(_sent_on, TP._MAIL)
            base = (alpha * dangling_mass + 1.0 - alpha) / n
            ranks = cut_lineage(brought.unionByName(ranks).groupBy("to").applyInArrow(_new_ranks(alpha, base), TP._MAIL),
                                path=paths[i % 2])
            if fixed_rounds is None and ranks.agg(F.sum(F.col("stats")[1])).first()[0] < n * tol:
                break
    finally:
        kept.unpersist()
    return nodes.join(TP._unpacked(ranks, "r", ["rank"]), ["p", "i"]).select("node", "rank")


def attach_node_metrics(facts: DataFrame, metrics: DataFrame, roles: dict[str, str],
                        node: str = "node") -> DataFrame:
    """J-09: metrics of both endpoints joined to the facts, prefixed per role."""
    out = facts
    cols = [c for c in metrics.columns if c != node]
    for fact_col, prefix in roles.items():
        m = metrics.select(F.col(node).alias(f"_{prefix}node"),
                           *[F.col(c).alias(f"{prefix}{c}") for c in cols])
        out = out.join(m, out[fact_col] == m[f"_{prefix}node"], "left").drop(f"_{prefix}node")
    return out
