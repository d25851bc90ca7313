"""Scalar column expressions (no shuffles): parsing, cleaning, time handling.

Everything here returns ``Column`` objects built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen. ANSI mode stays on: ``try_cast``,
``get`` and ``try_to_timestamp`` give null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a timestamp or timestamp_ntz (session zone UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    """Elapsed minutes ``later - earlier`` as double (P-30)."""
    return (micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_MINUTE))


def either_not_null(a: str | Column, b: str | Column) -> Column:
    """P-02: keep rows where at least one of two columns is present."""
    return _c(a).isNotNull() | _c(b).isNotNull()


def repair_null_flag(actual: str | Column, scheduled: str | Column, flag: str | Column) -> Column:
    """P-05: flag is 0 when actual equals scheduled and the flag is missing."""
    return F.when((_c(actual) == _c(scheduled)) & _c(flag).isNull(), F.lit(0)).otherwise(_c(flag))


def nullify(value: str | Column, sentinel, quality: str | Column | None = None,
            bad_codes: Iterable = ()) -> Column:
    """P-06: value -> null when it equals the sentinel or its quality code is bad.

    Quality codes are compared as strings, so letter codes never raise under
    ANSI mode; a null quality keeps the value.
    """
    v = _c(value)
    bad = v == F.lit(sentinel)
    codes = [str(code) for code in bad_codes]
    if quality is not None and codes:
        bad = bad | F.coalesce(_c(quality).cast("string").isin(codes), F.lit(False))
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(None)).otherwise(v)


def packed_fields(packed: str | Column, types: Sequence[str], names: Sequence[str],
                  sep: str = ",") -> list[Column]:
    """P-07: split a packed composite once and type each position.

    Short fields give null (``get``), unparsable parts give null (``try_cast``).
    """
    parts = F.split(_c(packed), sep)
    out = []
    for i, (typ, name) in enumerate(zip(types, names)):
        piece = F.get(parts, i)
        out.append((piece if typ == "string" else piece.try_cast(typ)).alias(name))
    return out


def hhmm_to_timestamp(date_str: str | Column, hhmm: str | Column) -> Column:
    """P-08: 'yyyy-MM-dd' + integer hhmm -> local timestamp; 2400/garbage -> null."""
    text = F.concat(_c(date_str), F.lpad(_c(hhmm).cast("string"), 4, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-ddHHmm"))


def hour_of_hhmm(hhmm: str | Column) -> Column:
    """P-11: hour of an integer hhmm clock value."""
    return F.floor(_c(hhmm) / 100).cast("int")


def to_utc(local_ts: str | Column, zone: str | Column) -> Column:
    """P-10: local wall-clock timestamp in a per-row zone -> UTC; null zone -> null."""
    z = _c(zone)
    return F.when(z.isNotNull(), F.to_utc_timestamp(_c(local_ts), z))


def lead_time(ts: str | Column, hours: int = 2) -> Column:
    """P-09: prediction cut-off, ``hours`` before the (UTC) schedule."""
    return _c(ts) - F.make_interval(hours=F.lit(hours))


def row_mean(cols: Sequence[str | Column]) -> Column:
    """P-13: mean across columns, skipping nulls; null when all are null."""
    arr = F.filter(F.array(*[_c(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    return F.when(F.size(arr) > 0,
                  F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / F.size(arr))


def row_argmax_name(cols: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """P-14: name of the column holding the row maximum, first wins, nulls skipped."""
    names = list(names or cols)
    vals = F.array(*[_c(c).cast("double") for c in cols])
    best = F.array_max(vals)
    return F.when(best.isNotNull(),
                  F.element_at(F.array(*[F.lit(n) for n in names]),
                               F.array_position(vals, best).cast("int")))


def epoch_parts(epoch_seconds: str | Column, prefix: str = "") -> list[Column]:
    """P-18: year, month, day, hour and weekday (Sunday = 0) of epoch seconds (UTC)."""
    ts = F.timestamp_seconds(_c(epoch_seconds))
    return [
        F.year(ts).alias(f"{prefix}year"),
        F.month(ts).alias(f"{prefix}month"),
        F.dayofmonth(ts).alias(f"{prefix}day"),
        F.hour(ts).alias(f"{prefix}hour"),
        (F.dayofweek(ts) - 1).alias(f"{prefix}weekday"),
    ]


def first_half_of_month(ts: str | Column) -> Column:
    """P-19: 1 when the day of month is at most 15."""
    return (F.dayofmonth(_c(ts)) <= 15).cast("int")


def hour_buckets(ts: str | Column, width: int = 4, prefix: str = "hour_bucket_") -> list[Column]:
    """P-20: 24/width one-hot columns of the hour of day."""
    h = F.hour(_c(ts))
    return [(F.floor(h / width) == i).cast("int").alias(f"{prefix}{i}") for i in range(24 // width)]


def contains_any(arr: str | Column, values: Sequence[str]) -> Column:
    """P-21: 1 when a list column holds any of the given values."""
    return F.coalesce(F.arrays_overlap(_c(arr), F.array(*[F.lit(v) for v in values])),
                      F.lit(False)).cast("int")


def regex_flag(text: str | Column, pattern: str) -> Column:
    """P-22: 1 when the pattern occurs (case-insensitive)."""
    return (F.regexp_count(_c(text), F.lit("(?i)" + pattern)) > 0).cast("int")


def log_odds(y: str | Column) -> Column:
    """P-27: odds y/(1-y); null at y = 1."""
    return _c(y) / F.nullif(F.lit(1.0) - _c(y), F.lit(0.0))


def file_row_id() -> Column:
    """P-03: surrogate row id from the parquet file and the row's index in it.

    Unique per physical row (identical copies included), stable when the plan
    is re-evaluated or a task is retried, and computed in the scan with no
    shuffle. Must be taken on a frame read directly from files.
    """
    return F.concat(F.hex(F.xxhash64(F.col("_metadata.file_path"))), F.lit(":"),
                    F.col("_metadata.row_index").cast("string"))
