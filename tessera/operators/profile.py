"""Aggregation and profiling: one pass per question, partial aggregation always.

The reference scans once per column or once per key; here every profile is a
single ``agg`` (grouping sets for multi-key sums, conditional counts for null
profiles) so the table is read once and combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """A-15: one row per key, the first by a total ``order`` (deterministic).

    A ``min_by`` aggregate rather than ``row_number``: it combines map-side,
    so a key with millions of copies never lands whole on one sorter.
    """
    key = list(key)
    others = [c for c in df.columns if c not in key]
    ordering = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.groupBy(*key).agg(F.min_by(F.struct(*others), ordering).alias("_row")) \
             .select(*key, "_row.*")


def flag_sums_by_keys(df: DataFrame, keys: dict[str, Column], flag: Column,
                      name_col: str = "key_name", value_col: str = "key_value") -> DataFrame:
    """A-01: sum of a 0/1 flag (and row count) by each of several keys in one pass.

    ``GROUPING SETS`` over all keys: one scan, one shuffle, partial sums.
    Output is long: (key_name, key_value as string, n_rows, n_flag).
    """
    names = list(keys)
    base = df.select(*[c.alias(n) for n, c in keys.items()], flag.cast("long").alias("_flag"))
    g = base.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_flag").alias("n_flag"),
        *[F.grouping(n).alias(f"_g_{n}") for n in names])
    name_expr = F.lit(None).cast("string")
    value_expr = F.lit(None).cast("string")
    for n in reversed(names):
        name_expr = F.when(F.col(f"_g_{n}") == 0, F.lit(n)).otherwise(name_expr)
        value_expr = F.when(F.col(f"_g_{n}") == 0, F.col(n).cast("string")).otherwise(value_expr)
    return g.select(name_expr.alias(name_col), value_expr.alias(value_col), "n_rows", "n_flag")


def edge_list(df: DataFrame, keys: Sequence[str], labels: dict[str, str]) -> DataFrame:
    """A-02: count per key tuple plus ``min`` of descriptive columns."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 *[F.min(src).alias(dst) for dst, src in labels.items()])


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A-05: null count and percentage (2 dp) per column in one scan, long form.

    ``all_null`` marks the columns with no value at all; an empty table gives
    counts of 0 and a null percentage.
    """
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = wide.unpivot("_n", cols, "column_name", "n_null")
    return stacked.select(
        "column_name", F.col("n_null").cast("long").alias("n_null"),
        F.round(F.col("n_null") * 100.0 / F.nullif(F.col("_n"), F.lit(0)), 2).alias("pct_null"),
        ((F.col("n_null") == F.col("_n")) & (F.col("_n") > 0)).alias("all_null"))


def class_balance(df: DataFrame, label: str, positive=1) -> DataFrame:
    """A-06: positives, negatives and the positive rate in percent."""
    pos = F.count_if(F.col(label) == F.lit(positive))
    neg = F.count_if(F.col(label) != F.lit(positive))
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"),
                  (pos * 100.0 / F.nullif(pos + neg, F.lit(0))).alias("pct_pos"))


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A-07: count, mean, sample stddev, min, max per column, long form, one scan."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").alias("n"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__stddev").alias("stddev"), F.col(f"{c}__min").alias("min"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A-09: Pearson r for every column pair (pairwise complete), long (a, b, r)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                     F.col(f"{a}__{b}").alias("r")) for a, b in pairs]
    return wide.select(F.inline(F.array(*rows)))


def rate_by(df: DataFrame, group: Sequence[str], flag: str) -> DataFrame:
    """A-11: total and mean of a 0/1 flag by category."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                                  F.avg(F.col(flag).cast("double")).alias("rate"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """A-12: fixed-width bins between min and max; the last bin is closed.

    min/max come from a scalar subquery (one merged aggregate job), so no
    cross join and nothing passes through the driver.
    """
    x = F.col(col).cast("double")
    stats = df.select(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo = stats.select("lo").scalar()
    hi = stats.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", "n", (lo + F.col("bin") * width).alias("bin_lo"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_hi"))


def five_number(df: DataFrame, col: str, group: Sequence[str] = ()) -> DataFrame:
    """A-13: min, quartiles (exact, linear interpolation), max and IQR fences."""
    x = F.col(col).cast("double")
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    g = df.groupBy(*group) if group else df.groupBy()
    out = g.agg(F.min(x).alias("min"), q.alias("_q"), F.max(x).alias("max"))
    out = out.select(*group, "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                     F.col("_q")[2].alias("q3"), "max")
    iqr = F.col("q3") - F.col("q1")
    return out.withColumn("lower_fence", F.col("q1") - 1.5 * iqr) \
              .withColumn("upper_fence", F.col("q3") + 1.5 * iqr)


def least_squares(df: DataFrame, y: str, x: str, group: Sequence[str] = ()) -> DataFrame:
    """A-16: slope, intercept and R^2 of y on x (built-in regression aggregates)."""
    g = df.groupBy(*group) if group else df.groupBy()
    return g.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def row_count_ledger(stages: dict[str, DataFrame], by: Column | None = None,
                     by_name: str = "part") -> DataFrame:
    """A-14: row count per stage (and per ``by`` value) as one union query."""
    out = None
    for stage, frame in stages.items():
        g = frame.groupBy(by.alias(by_name)) if by is not None else frame.groupBy()
        part = g.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("stage", F.lit(stage))
        out = part if out is None else out.unionByName(part)
    return out


def window_free_max(df: DataFrame, group: Sequence[str], col: str, out: str) -> DataFrame:
    """A-08: group max."""
    return df.groupBy(*group).agg(F.max(col).alias(out))

