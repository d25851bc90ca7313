"""Joins: role-playing dimensions, nearest-per-group attach, as-of enrichment.

No side is hinted for broadcast: the planner and adaptive execution decide from
the bytes of a side, known from its files or measured at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import micros


def prefixed(df: DataFrame, cols: Sequence[str], prefix: str) -> list[Column]:
    """P-12: qualified, renamed projection of ``cols`` (``x`` -> ``PREFIX_x``)."""
    return [df[c].alias(f"{prefix}{c}") for c in cols]


def role_join(fact: DataFrame, dim: DataFrame, dim_key: str,
              roles: dict[str, str], cols: Sequence[str]) -> DataFrame:
    """J-01: join one dimension once per role (e.g. origin, destination).

    ``roles`` maps a fact column to a prefix; each role is a left join against
    the dimension with its columns renamed by the prefix.
    """
    small = dim.select(dim_key, *cols)
    out = fact
    for fact_key, prefix in roles.items():
        d = small.select(F.col(dim_key).alias(f"{prefix}{dim_key}"),
                         *[F.col(c).alias(f"{prefix}{c}") for c in cols])
        out = out.join(d, out[fact_key] == d[f"{prefix}{dim_key}"], "left") \
                 .drop(f"{prefix}{dim_key}")
    return out


def nearest_per_group(df: DataFrame, group: Sequence[str] | str, dist: str,
                      keep_ties: bool = True, tiebreak: Sequence[str] = ()) -> DataFrame:
    """W-01: rows at the minimum distance of their group.

    ``keep_ties=True`` is the reference's behaviour (ties all survive); the
    tie-broken form (one row per group) is what J-02 needs so that an attach
    never multiplies fact rows. Implemented as an aggregate + join (partial
    aggregation, no per-group sort), which stays balanced for a hot group.
    """
    group = [group] if isinstance(group, str) else list(group)
    if keep_ties:
        best = df.groupBy(*group).agg(F.min(dist).alias("_best"))
        joined = df.join(best, group, "inner")
        return joined.filter(F.col(dist) == F.col("_best")).drop("_best")
    order = F.struct(F.col(dist), *[F.col(c) for c in tiebreak])
    others = [c for c in df.columns if c not in group]
    picked = df.groupBy(*group).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return picked.select(*group, "_row.*")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str] | str,
              left_ts: str, right_ts: str, right_cols: Sequence[str],
              lead_seconds: int = 0, prefix: str = "", right_tiebreak: str | None = None,
              bucket_seconds: int | None = None) -> DataFrame:
    """J-04: left as-of join with a lead time.

    Each left row gets the latest right row of the same key whose time is
    <= left time - ``lead_seconds`` (inclusive); unmatched left rows are kept
    with nulls. Right ties on time resolve to the largest ``right_tiebreak``.

    Single pass: the left rows (at their cut-off) and the right rows are
    unioned, sorted once per key and the last right row seen is carried
    forward with ``last(..., ignorenulls)``; no fan-out, no group max.

    ``bucket_seconds`` splits hot keys: the sort runs per (key, time bucket)
    and a tiny carry table (last right row of every earlier bucket, a window
    over key-buckets only) fills left rows whose own bucket has no earlier
    right row. Both forms return the same rows.
    """
    by = [by] if isinstance(by, str) else list(by)
    tb = right_tiebreak or right_ts
    tb_type = right.schema[tb].dataType  # the tie-break keeps its own type
    lcols = left.columns
    l = left.withColumn("_cut", micros(left_ts) - F.lit(lead_seconds * 1_000_000)) \
            .withColumn("_side", F.lit(1)).withColumn("_tb", F.lit(None).cast(tb_type))
    r = right
    for k in by:
        r = r.where(F.col(k).isNotNull())
    r = r.where(F.col(right_ts).isNotNull()).select(
        *by,
        micros(right_ts).alias("_cut"),
        F.lit(0).alias("_side"),
        F.col(tb).alias("_tb"),
        F.struct(*[F.col(c).alias(f"{prefix}{c}") for c in right_cols]).alias("_r"),
    )
    u = l.unionByName(r, allowMissingColumns=True)
    order = [F.col("_cut").asc_nulls_first(), F.col("_side"), F.col("_tb")]

    if not bucket_seconds:
        w = Window.partitionBy(*by).orderBy(*order) \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
        return out.select(*lcols, "_m.*")

    width = bucket_seconds * 1_000_000
    u = u.withColumn("_b", F.floor(F.col("_cut") / F.lit(width)))
    w_in = Window.partitionBy(*by, "_b").orderBy(*order) \
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w_in)).where("_side = 1")

    # Carry: latest right row of each (key, bucket), then for every bucket the
    # latest one strictly before it. Only key-bucket rows are windowed here.
    last_r = u.where("_side = 0").groupBy(*by, "_b").agg(
        F.max_by("_r", F.struct("_cut", "_tb")).alias("_r"), F.lit(1).alias("_k"))
    marks = u.where("_side = 1").select(*by, "_b").distinct() \
             .withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)) \
             .withColumn("_k", F.lit(0))
    wk = Window.partitionBy(*by).orderBy("_b", "_k") \
               .rowsBetween(Window.unboundedPreceding, -1)
    carry = marks.unionByName(last_r) \
                 .withColumn("_carry", F.last("_r", ignorenulls=True).over(wk)) \
                 .where("_k = 0").select(*by, "_b", "_carry")
    out = inside.join(carry, [*by, "_b"], "left") \
                .withColumn("_m", F.coalesce("_m", "_carry"))
    return out.select(*lcols, "_m.*")
