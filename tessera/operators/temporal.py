"""Lag and trailing-window features over time-ordered events.

Both operators have a plain form (one window per unit / per (date, place))
and a bucketed form that splits every partition into fixed time buckets and
repairs bucket edges with a carry table built over bucket rows only. The
bucketed form returns the same rows and keeps each sort bounded by one bucket
even when a single unit or place holds a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import MICROS_PER_MINUTE, micros


def _prev_leg_flag(cut_us, date, p1_us, p1_date, p1_delay, p2_us, p2_date, p2_delay,
                   gap_minutes: float, threshold: float):
    gap = F.lit(gap_minutes * MICROS_PER_MINUTE)
    d1 = cut_us - p1_us
    d2 = cut_us - p2_us
    return (
        F.when((d1 >= gap) & (p1_date == date) & (p1_delay >= threshold), F.lit(1))
         .when((d2 >= gap) & (d1 < gap) & (p2_date == date) & (p2_delay >= threshold), F.lit(1))
         .otherwise(F.lit(0))
    )


def previous_leg_flag(df: DataFrame, unit: str, ts: str, delay: str, date: str | None = None,
                      lead_minutes: int = 120, gap_minutes: float = 15, threshold: float = 15,
                      tiebreak: str | None = None, out: str = "prev_delayed",
                      bucket_seconds: int | None = None) -> DataFrame:
    """W-02: 1 when the unit's previous leg (or, if that one is too recent, the
    one before it) was delayed >= ``threshold`` on the same date and departed
    at least ``gap_minutes`` before the cut-off (``ts`` - ``lead_minutes``).
    Never null.

    Partitioning is (unit, date): a leg on another date can never qualify, so
    the result equals the per-unit window whenever ``date`` does not decrease
    with ``ts`` (true for a date derived from ``ts``). ``bucket_seconds`` further
    splits each (unit, date) into time buckets; the two latest legs of earlier
    buckets come from a carry table.
    """
    date_col = F.col(date) if date else F.to_date(F.col(ts))
    tb = tiebreak or ts
    base = df.withColumn("_us", micros(ts)).withColumn("_date", date_col) \
             .withColumn("_cut", F.col("_us") - F.lit(lead_minutes * MICROS_PER_MINUTE))
    leg = F.struct(F.col("_us").alias("us"), F.col("_date").alias("d"),
                   F.col(delay).cast("double").alias("delay"))
    order = [F.col("_us"), F.col(tb)]

    if not bucket_seconds:
        w = Window.partitionBy(unit, "_date").orderBy(*order)
        x = base.withColumn("_p1", F.lag(leg, 1).over(w)).withColumn("_p2", F.lag(leg, 2).over(w))
    else:
        width = bucket_seconds * 1_000_000
        keys = [unit, "_date", "_b"]
        b = base.withColumn("_b", F.floor(F.col("_us") / F.lit(width))).withColumn("_leg", leg)
        w = Window.partitionBy(*keys).orderBy(*order)
        wall = Window.partitionBy(*keys)
        b = b.withColumn("_rn", F.row_number().over(w)) \
             .withColumn("_n", F.count(F.lit(1)).over(wall)) \
             .withColumn("_l1", F.lag("_leg", 1).over(w)) \
             .withColumn("_l2", F.lag("_leg", 2).over(w))
        tails = b.where(F.col("_rn") > F.col("_n") - 2).groupBy(*keys).agg(
            F.max(F.when(F.col("_rn") == F.col("_n"), F.col("_leg"))).alias("_t1"),
            F.max(F.when(F.col("_rn") == F.col("_n") - 1, F.col("_leg"))).alias("_t2"))
        wb = Window.partitionBy(unit, "_date").orderBy("_b")
        carry = tails.select(
            *keys,
            F.lag("_t1", 1).over(wb).alias("_x1"),
            F.coalesce(F.lag("_t2", 1).over(wb), F.lag("_t1", 2).over(wb)).alias("_x2"))
        # null-safe: rows without a unit form a group of their own, as in the plain form
        carry = carry.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], "_x1", "_x2")
        same = [F.col(k).eqNullSafe(F.col(f"_c{i}")) for i, k in enumerate(keys)]
        x = b.join(carry, same, "left") \
             .withColumn("_p1", F.when(F.col("_rn") >= 2, F.col("_l1")).otherwise(F.col("_x1"))) \
             .withColumn("_p2", F.when(F.col("_rn") >= 3, F.col("_l2"))
                                 .when(F.col("_rn") == 2, F.col("_x1")).otherwise(F.col("_x2")))
    flag = _prev_leg_flag(F.col("_cut"), F.col("_date"),
                          F.col("_p1.us"), F.col("_p1.d"), F.col("_p1.delay"),
                          F.col("_p2.us"), F.col("_p2.d"), F.col("_p2.delay"),
                          gap_minutes, threshold)
    return x.withColumn(out, flag).select(*df.columns, out)


def trailing_count(df: DataFrame, place: str, ts: str, delay: str, date: str | None = None,
                   offset_minutes: int = 135, threshold: float = 15,
                   out: str = "n_prev_delays", bucket_seconds: int | None = None) -> DataFrame:
    """W-03: delayed rows (``delay >= threshold``) of the same (date, place) whose
    time is at least ``offset_minutes`` before this row's; null when no row of
    the (date, place) lies in that range (empty frame).

    Plain form: ``RANGE BETWEEN UNBOUNDED PRECEDING AND offset PRECEDING`` on
    epoch microseconds. Bucketed form: every row becomes a data point at its
    time and a probe at time - offset; probes count data points of their own
    time bucket with a running sum and add the totals of earlier buckets of
    the same (date, place) from a small per-bucket prefix table.
    """
    date_col = F.col(date) if date else F.to_date(F.col(ts))
    base = df.withColumn("_us", micros(ts)).withColumn("_date", date_col) \
             .withColumn("_hit", F.when(F.col(delay) >= threshold, 1).otherwise(0))
    off = offset_minutes * MICROS_PER_MINUTE

    if not bucket_seconds:
        w = Window.partitionBy("_date", place).orderBy("_us") \
                  .rangeBetween(Window.unboundedPreceding, -off)
        return base.withColumn(out, F.sum("_hit").over(w)).select(*df.columns, out)

    width = bucket_seconds * 1_000_000
    keys = ["_date", place]
    start_us = micros(F.col("_date").cast("timestamp"))
    row = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    data = base.select(*keys, F.col("_us").alias("_t"), F.lit(0).alias("_side"), "_hit",
                       F.lit(None).cast(df.select(row).schema["_row"].dataType).alias("_row"))
    probes_all = base.withColumn("_t", F.col("_us") - F.lit(off))
    # A probe before the start of its date has an empty frame: null directly.
    early = probes_all.where(~(F.col("_t") >= start_us) | F.col("_t").isNull()) \
                      .select(*df.columns, F.lit(None).cast("long").alias(out))
    probes = probes_all.where(F.col("_t") >= start_us) \
                       .select(*keys, "_t", F.lit(1).alias("_side"), F.lit(0).alias("_hit"), row)
    u = data.unionByName(probes).withColumn("_b", F.floor(F.col("_t") / F.lit(width)))
    bk = [*keys, "_b"]
    w = Window.partitionBy(*bk).orderBy("_t", "_side") \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_in_n", F.sum(1 - F.col("_side")).over(w)) \
         .withColumn("_in_hit", F.sum("_hit").over(w))
    totals = u.where("_side = 0").groupBy(*bk).agg(
        F.count(F.lit(1)).alias("_bn"), F.sum("_hit").alias("_bh"))
    marks = u.where("_side = 1").select(*bk).distinct()
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    zero = marks.select(*bk, F.lit(0).cast("long").alias("_bn"), F.lit(0).cast("long").alias("_bh"))
    sums = totals.unionByName(zero).groupBy(*bk).agg(F.sum("_bn").alias("_bn"), F.sum("_bh").alias("_bh"))
    prefix = sums.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(bk)],
                          F.coalesce(F.sum("_bn").over(wb), F.lit(0)).alias("_pn"),
                          F.coalesce(F.sum("_bh").over(wb), F.lit(0)).alias("_ph"))
    # null-safe: rows without a place form a group of their own, as in the plain form
    same = [F.col(k).eqNullSafe(F.col(f"_c{i}")) for i, k in enumerate(bk)]
    got = u.where("_side = 1").join(prefix, same, "left") \
           .select("_row.*",
                   F.when(F.col("_in_n") + F.col("_pn") > 0,
                          F.col("_in_hit") + F.col("_ph")).cast("long").alias(out))
    return got.unionByName(early)
