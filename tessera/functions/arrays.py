"""Per-row array expressions for dense vectors (images stored row-major).

Higher-order functions (``transform``, ``aggregate``, ``filter``) run inside
the JVM; no vector ever leaves its row, so there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(arr: str | Column) -> Column:
    return F.transform(_c(arr), lambda x: x.cast("double"))


def array_sum(arr: str | Column) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def binarize(arr: str | Column, threshold: float) -> Column:
    """P-23: 1 where value > threshold, else 0."""
    return F.transform(_c(arr), lambda x: F.when(x > threshold, 1).otherwise(0))


def three_levels(arr: str | Column, low: float, high: float) -> Column:
    """P-23: 0 below ``low``, 1 in [low, high), 2 from ``high`` up."""
    return F.transform(_c(arr), lambda x: F.when(x >= high, 2).when(x >= low, 1).otherwise(0))


def scale(arr: str | Column, factor: float) -> Column:
    """P-23: value scaling (e.g. pixel / 255)."""
    return F.transform(_c(arr), lambda x: x.cast("double") * factor)


def row_moments(arr: str | Column) -> Column:
    """Struct (mean, sd) of an array's values (population sd)."""
    a = _c(arr)
    n = F.size(a)
    s = F.aggregate(a, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
                    lambda acc, x: F.struct((acc["s"] + x.cast("double")).alias("s"),
                                            (acc["q"] + x.cast("double") * x.cast("double")).alias("q")))
    return F.struct((s["s"] / n).alias("mean"),
                    F.sqrt(F.greatest(s["q"] / n - F.pow(s["s"] / n, 2), F.lit(0.0))).alias("sd"))


def standardize(df, arr: str, out: str = "standardized"):
    """P-24: per-row (x - mean) / population sd; sd 0 divides by 1.

    Two projections: the row's moments are computed once, then the array is
    transformed (a moment expression inside the lambda would be re-evaluated
    for every element)."""
    x = df.withColumn("_mom", row_moments(arr))
    denom = F.when((F.col("_mom.sd") == 0) | F.col("_mom.sd").isNull(), F.lit(1.0)) \
             .otherwise(F.col("_mom.sd"))
    return x.withColumn(out, F.transform(F.col(arr), lambda v: (v.cast("double") - F.col("_mom.mean"))
                                         / denom)).drop("_mom")


def add_gaussian_noise(arr: str | Column, sd: float, seed: int) -> Column:
    """P-25: x + N(0, sd) per element. ``randn`` is seeded per partition, so
    the stream is reproducible for a fixed input partitioning."""
    a = as_double(arr)
    return F.transform(a, lambda x: x + F.randn(seed) * sd)


def box_filter(arr: str | Column, height: int, width: int) -> Column:
    """P-26: 3x3 mean filter on a row-major height x width grid.

    Each cell becomes the sum of itself and its 8 neighbours times 1/9, with
    zero beyond the edge (so border cells shrink, as in the reference).
    """
    a = _c(arr)

    def cell(i):
        r = F.floor(i / width)
        c = i % width
        total = F.lit(0.0)
        for dr in (-1, 0, 1):
            for dc in (-1, 0, 1):
                inside = ((r + dr) >= 0) & ((r + dr) < height) & ((c + dc) >= 0) & ((c + dc) < width)
                total = total + F.when(inside, F.get(a, i + dr * width + dc).cast("double")) \
                                 .otherwise(F.lit(0.0))
        return total / 9.0

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), cell)


def _box_filter_sql(height: int = 8, width: int = 8, col: str = "embedding") -> str:
    terms = []
    for dr in (-1, 0, 1):
        for dc in (-1, 0, 1):
            cond = (f"(i // {width}) + ({dr}) BETWEEN 0 AND {height - 1} AND "
                    f"(i % {width}) + ({dc}) BETWEEN 0 AND {width - 1}")
            terms.append(f"CASE WHEN {cond} THEN CAST({col}[i + ({dr * width + dc}) + 1] AS DOUBLE) "
                         f"ELSE 0 END")
    body = " + ".join(terms)
    return f"""
WITH f AS (SELECT vec_id, list_transform(range({height * width}), lambda i: ({body}) / 9.0) AS ff
           FROM embeddings)
SELECT vec_id, round(list_sum(ff), 6) AS f_sum, round(ff[10], 6) AS f_9, round(ff[1], 6) AS f_0
FROM f"""


BOX_FILTER_SQL = _box_filter_sql()
