"""Normalisation and categorical encoding (N-01 .. N-04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def zscore(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
           suffix: str = "_scaled") -> DataFrame:
    """N-01 / N-02: (x - mean) / sample sd for many columns in one projection.

    All means and deviations come from scalar subqueries over the same frame;
    Catalyst merges them into a single aggregate job and inlines the values,
    so the table is scanned once for statistics and once for the projection,
    with no cross join and no positional re-alignment. sd = 0 -> null; nulls stay.
    """
    stats = df.select(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                      *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])
    out = [F.col(k) for k in keep]
    for c in cols:
        mean = stats.select(f"m_{c}").scalar()
        sd = stats.select(f"s_{c}").scalar()
        out.append(((F.col(c).cast("double") - mean) / F.nullif(sd, F.lit(0.0))).alias(f"{c}{suffix}"))
    return df.select(*out)


def frequency_index(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """N-03 as a table: (value, index) with index 0 for the most frequent value,
    ties by value (StringIndexer's ``frequencyDesc``). Nulls are not indexed.

    The window runs over the distinct values only (one row per category).
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.col("n").desc(), F.col(col))
    return counts.select(col, "n", (F.row_number().over(w) - 1).cast("long").alias(out))


def categorical_pipeline(cat_cols: Sequence[str], num_cols: Sequence[str],
                         label: str | None = None, features: str = "features"):
    """N-03: StringIndexer (frequency order, unseen/null skipped) -> one-hot ->
    VectorAssembler (rows with null numerics skipped). Returns the stages."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="skip",
                         stringOrderType="frequencyDesc") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols],
                        outputCols=[f"{c}_ohe" for c in cat_cols], handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}_ohe" for c in cat_cols] + list(num_cols),
                          outputCol=features, handleInvalid="skip")
    stages = [*idx, ohe, asm]
    if label is not None:
        stages.insert(0, StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip",
                                       stringOrderType="frequencyDesc"))
    return stages


def drop_label(df: DataFrame, label: str = "label", value: int = 2) -> DataFrame:
    """N-04: remove a spurious indexed label value."""
    return df.where(F.col(label) != value)
