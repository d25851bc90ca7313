"""File sources and sinks (S-01 .. S-09).

Readers declare their schema (no ``inferSchema`` pass over the data); writers
never ``coalesce(1)``. Paths handed to the writers must be on storage shared by
all executors; ``tessera.session.scratch_path`` gives one under the
checkpoint root.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def timeslice_bounds(timeframe: str, start_year: int) -> tuple[dt.datetime, dt.datetime]:
    """S-01: half-open [lo, hi) of a timeframe: "3m", "6m", "<n>y" from
    ``start_year``, or a single year such as "2017"."""
    lo = dt.datetime(start_year, 1, 1)
    if timeframe.endswith("m"):
        months = int(timeframe[:-1])
        hi = dt.datetime(start_year + (months // 12), 1 + months % 12, 1)
        return lo, hi
    if timeframe.endswith("y"):
        return lo, dt.datetime(start_year + int(timeframe[:-1]), 1, 1)
    year = int(timeframe)
    return dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1)


def load_timeslice(spark: SparkSession, path: str, ts_col: str, timeframe: str,
                   start_year: int, cols: Sequence[str] | None = None,
                   year_partition: str | None = None) -> DataFrame:
    """S-01: read ``path`` restricted to the timeframe; the typed bounds reach the
    parquet scan as pushed filters. When the data is laid out one directory per
    year (``year_partition``, e.g. ``year=2017/``), a predicate on that
    partition column also prunes whole directories before any file is opened."""
    lo, hi = timeslice_bounds(timeframe, start_year)
    df = spark.read.parquet(path)
    if cols:
        keep = list(cols) + ([year_partition] if year_partition and year_partition not in cols else [])
        df = df.select(*keep)
    ts = F.col(ts_col)
    cond = (ts >= F.lit(lo)) & (ts < F.lit(hi))
    if year_partition:
        last = hi.year - 1 if (hi.month, hi.day) == (1, 1) else hi.year
        cond = cond & F.col(year_partition).between(lo.year, last)
    out = df.where(cond)
    return out.drop(year_partition) if year_partition and cols and year_partition not in cols else out


def read_headerless_csv(spark: SparkSession, path: str, names: Sequence[str],
                        types: Sequence[str]) -> DataFrame:
    """S-02: CSV without a header, columns named by position (declared schema)."""
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    return spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE").csv(path)


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType | str,
                         date_cols: dict[str, str] | None = None,
                         renames: dict[str, str] | None = None) -> DataFrame:
    """S-03: CSV with a header, parse date columns (``{col: pattern}``), bulk rename.

    A malformed date becomes null instead of failing the job (ANSI mode)."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    for c, pattern in (date_cols or {}).items():
        df = df.withColumn(c, F.to_date(F.try_to_timestamp(F.col(c), F.lit(pattern))))
    if renames:
        df = df.withColumnsRenamed(renames)
    return df


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      multiline: bool = False) -> DataFrame:
    """S-04: JSON records. JSON-lines (the default) splits across tasks; a single
    top-level array needs ``multiline=True`` and is read by one task per file."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def parse_json_column(col: str | Column, schema: T.StructType | str) -> Column:
    """S-04 on a string column: typed struct, malformed -> null fields."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def render_sparse_lines(df: DataFrame, label: str, vector: str, threshold: float = 0.0) -> DataFrame:
    """Write-side helper for S-05: ``label idx:1 idx:1 ...`` for entries > threshold
    (0-based indices), one line per row."""
    idx = F.filter(F.transform(F.col(vector), lambda x, i: F.when(x > threshold, i)),
                   lambda i: i.isNotNull())
    return df.select(F.concat_ws(" ", F.col(label).cast("string"),
                                 F.array_join(F.transform(idx, lambda i: F.concat(i.cast("string"),
                                                                                  F.lit(":1"))),
                                              " ")).alias("value"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): every line of a text source with its place, the block of
    the file that a task reads and the line's number in it, so equal lines stay apart. The
    numbers are the same in every evaluation with one ``spark.sql.files.maxPartitionBytes``."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"), "value")

    def run(batches):
        import pyarrow as pa

        seen: dict = {}
        for batch in batches:
            numbers = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                numbers.append(seen.get(key, 0))
                seen[key] = numbers[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(numbers, pa.int64()), batch.column(2)],
                                             ["file", "block", "line", "value"])

    return lines.mapInArrow(run, "file string, block long, line long, value string")


def read_sparse_text(spark: SparkSession, path: str, names: DataFrame | None = None) -> DataFrame:
    """S-05: ``label idx:val ...`` text to long form (file, block, line, label, idx[, name]).

    As in the reference the value is ignored (presence = 1) and the index is used
    as given. ``names`` (idx, name) is a dimension joined on the index.
    """
    lines = numbered_lines(spark, path).where(F.length(F.trim("value")) > 0)
    parts = F.split(F.trim(F.col("value")), r"\s+")
    x = lines.select("file", "block", "line",
                     F.get(parts, 0).alias("label"),
                     F.explode(F.slice(parts, 2, 1 << 30)).alias("_tok"))
    x = x.select("file", "block", "line", "label",
                 F.get(F.split("_tok", ":"), 0).try_cast("int").alias("idx"))
    if names is not None:
        x = x.join(names, "idx", "left")
    return x


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] = ()) -> None:
    """S-06: parquet sink; default mode fails if the path exists."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S-07: CSV with a header line per part file (no single-file funnel)."""
    df.write.mode(mode).option("header", True).csv(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """S-08: write and read back, freezing non-deterministic columns and cutting
    lineage on shared storage."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_model(model, path: str) -> None:
    """S-09: persist a fitted MLlib model or pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
