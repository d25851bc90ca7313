"""Global ranks, neighbouring rows and exact quantiles without a single-partition window.

``Window.orderBy(x)`` with no partition moves the whole table to one task. Here
rows are dealt to ranges of the key by ``repartitionByRange``: Spark samples the
bounds on the key itself, of any type that it can order, and the number of
ranges is that of its shuffle partitions, so it grows with the setting and the
data. The ranges are written once; totals per range give each range its offset,
and a window within the ranges finishes the prefix. Only the totals, one row
per range, are ever summed in one place.

Ranks need one row per distinct key, so a key that many rows share is one row.
Quantiles need no ranks at all: the interval that holds an order statistic is
narrowed by quantile sketches and counts until few values are left in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

_RANGE = "_range"


def in_ranges(df: DataFrame, keys: Sequence[str], n_ranges: int | None = None) -> DataFrame:
    """``df`` with ``_range``: the rows dealt to ranges of ``keys`` (nulls first), later
    ranges holding larger keys. Equal keys share a range. Written as a table, so that
    every use sees the same ranges."""
    dealt = df.repartitionByRange(n_ranges, *keys) if n_ranges else df.repartitionByRange(*keys)
    return cut_lineage(dealt.withColumn(_RANGE, F.spark_partition_id()))


def _before(totals: DataFrame, names: Sequence[str]) -> list[Column]:
    """Sums over the earlier ranges, of a table with one row per range."""
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_off_{n}") for n in names]


def prefix_sums(df: DataFrame, key: str, weights: dict[str, Column], n_buckets: int | None = None) -> DataFrame:
    """One row per distinct non-null ``key`` with, for every named weight w:
    ``w`` (sum at the key), ``w_before`` (sum over smaller keys) and
    ``w_total`` (sum over all keys). ``df`` may already be one row per key.
    ``n_buckets``: number of ranges, else as many as shuffle partitions.
    """
    names = list(weights)
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.sum(c).alias(n) for n, c in weights.items()])
    rows = in_ranges(per_key, [key], n_buckets)
    totals = rows.groupBy(_RANGE).agg(*[F.sum(n).alias(n) for n in names])
    offsets = totals.select(_RANGE, *_before(totals, names),
                            *[F.sum(n).over(Window.partitionBy()).alias(f"{n}_total") for n in names])
    wi = Window.partitionBy(_RANGE).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    within = rows.select(key, _RANGE, *names,
                         *[F.coalesce(F.sum(n).over(wi), F.lit(0)).alias(f"_in_{n}") for n in names])
    return within.join(offsets, _RANGE).select(
        key, *names,
        *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(f"{n}_before") for n in names],
        *[f"{n}_total" for n in names])


def counts_with_prefix(df: DataFrame, key: str, n_buckets: int | None = None,
                       weight: Column | None = None) -> DataFrame:
    """One row per distinct non-null ``key``: (key, n, before, total).

    ``n`` rows carry the key, ``before`` rows carry a smaller key and ``total``
    is the number of non-null rows. With ``weight`` the counts are weighted sums.
    """
    w = weight if weight is not None else F.lit(1)
    p = prefix_sums(df, key, {"_w": w}, n_buckets)
    return p.select(key, F.col("_w").alias("n"), F.col("_w_before").alias("before"),
                    F.col("_w_total").alias("total"))


def _numbered(df: DataFrame, keys: Sequence[str], out: str, n_ranges: int | None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_range`` and the 0-based place ``out`` of each row, and per range
    its first place and the number of all rows (``_off_n``, ``_total``)."""
    rows = in_ranges(df, keys, n_ranges)
    sizes = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select(_RANGE, *_before(sizes, ["n"]), F.sum("n").over(Window.partitionBy()).alias("_total"))
    place = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*keys)) - 1
    numbered = rows.withColumn("_in", place).join(starts, _RANGE)
    return numbered.withColumn(out, F.col("_in") + F.col("_off_n")).drop("_in", "_off_n"), starts


def positions(df: DataFrame, keys: Sequence[str] | str, out: str = "pos", n_ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``, the 0-based place of each row in the order of ``keys`` (nulls
    first). Rows with equal keys get different places in any order."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _numbered(df, keys, out, n_ranges)[0].select(*df.columns, out)


def lagged(df: DataFrame, keys: Sequence[str] | str, cols: Sequence[str], lag: int = 1, prefix: str = "prev_",
           n_ranges: int | None = None) -> DataFrame:
    """``df`` with the values of ``cols`` ``lag`` rows earlier in the order of ``keys``, as
    ``prefix`` + name, and the place ``pos``; the first ``lag`` rows have nulls.

    The last ``lag`` rows before each range are handed over its border, whichever
    ranges they lie in; all other lags stay within a range.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows, starts = _numbered(df, keys, "pos", n_ranges)
    handed = rows.select("pos", *cols, F.explode(F.sequence(F.lit(1), F.lit(lag))).alias("_ahead"))
    borders = starts.select(_RANGE, F.col("_off_n").alias("_start"))
    handed = handed.withColumn("_start", F.col("pos") + F.col("_ahead")).join(borders, "_start").select(
        _RANGE, "pos", *cols, F.lit(True).alias("_handed"))
    both = rows.withColumn("_handed", F.lit(False)).unionByName(handed, allowMissingColumns=True)
    w = Window.partitionBy(_RANGE).orderBy("pos")
    return both.select("*", *[F.lag(c, lag).over(w).alias(prefix + c) for c in cols]).where(~F.col("_handed")).select(
        *df.columns, "pos", *[prefix + c for c in cols])


def percent_rank_global(df: DataFrame, key: str, out: str = "pct_rank",
                        n_buckets: int | None = None) -> DataFrame:
    """W-04: ``percent_rank()`` over the whole table, ties equal, as a join.

    (rank - 1) / (n - 1) with rank = 1 + rows with a smaller key; 0 when n = 1.
    Null keys sort first, as in Spark's ascending order: they rank 1 and shift
    every non-null rank by their count.
    """
    ranks = counts_with_prefix(df, key, n_buckets)
    # Both counts from one aggregate over the input (merged scalar subqueries),
    # not from the rank table, which would be planned a second time.
    counts = df.agg(F.count_if(F.col(key).isNull()).alias("nn"), F.count(F.lit(1)).alias("n"))
    n_null = counts.select("nn").scalar()
    total = counts.select("n").scalar()
    pr = F.when(total <= 1, F.lit(0.0)).otherwise(
        (F.col("before") + n_null) / (total - 1).cast("double"))
    table = ranks.select(key, pr.alias(out))
    joined = df.join(table, key, "left")
    return joined.withColumn(out, F.when(F.col(key).isNull(), F.lit(0.0)).otherwise(F.col(out))) \
                 .select(*df.columns, out)


#: Values that may be left in the interval of an order statistic before they are sorted.
FEW = 10_000
#: Quantiles that a sketch gives of an interval, and the precision of the sketch.
CUTS = 1_000
SKETCH = 10_000


def order_statistics(df: DataFrame, col: str, places: Sequence, by: Sequence[str] = (), few: int = FEW) -> DataFrame:
    """Exact order statistics of ``col`` per group ``by``: (by..., n, v0, v1, ...).

    ``places`` are functions from a group's number of non-null values ``n`` to a
    0-based place. A place has an interval, at first of all values. A quantile
    sketch of the values inside gives bounds on either side of the place, and counts
    tell how many lie below and between; this goes on while more than ``few`` are
    left between different bounds, and then those few are sorted. Every pass keeps
    one row per group, so a group of any size is summed within the tasks. Bounds
    that miss their place, which counts tell, leave the interval as it was.
    """
    spots = range(len(places))
    g = [f"_g{i}" for i in range(max(1, len(by)))]
    keys = [F.col(c).alias(n) for c, n in zip(by, g)] or [F.lit(0).alias("_g0")]
    x = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("_x"))

    def sketch(values: Column) -> Column:
        return F.percentile_approx(values, F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)]), SKETCH)

    def attached(rows: DataFrame, state: DataFrame) -> DataFrame:
        """Each row with the columns of its group's row of ``state``."""
        columns = [c for c in state.columns if c not in g]
        if not by:  # one row: a scalar, no join
            return rows.withColumn("_row", state.select(F.struct(*columns).alias("r")).scalar()).select(
                *rows.columns, *[F.col(f"_row.{c}").alias(c) for c in columns])
        named = state.select(*[F.col(c).alias(f"_s{c}") for c in g], *columns)
        same = F.lit(True)
        for c in g:
            same = same & F.col(c).eqNullSafe(F.col(f"_s{c}"))
        return rows.join(named, same).drop(*[f"_s{c}" for c in g])

    def narrowed(state: DataFrame) -> DataFrame:
        """New intervals from the quantiles ``q{i}`` of the old ones, counted in one pass."""
        def bound(i, step):
            at = F.floor((F.col(f"p{i}") - F.col(f"below{i}")) / F.col(f"inside{i}") * CUTS).cast("int") + step
            end = F.col(f"lo{i}" if step < 0 else f"hi{i}")
            return F.when((at >= 1) & (at < CUTS), F.get(f"q{i}", at - 1)).otherwise(end)

        wide = state.select(*g, "n", *[c for i in spots for c in (
            f"p{i}", f"lo{i}", f"hi{i}", f"below{i}", f"inside{i}", bound(i, -3).alias(f"a{i}"), bound(i, 4).alias(f"b{i}"))])
        counts = attached(x, wide.select(*g, *[f"{c}{i}" for i in spots for c in "ab"])).groupBy(*g).agg(*[
            c for i in spots for c in (F.count_if(F.col("_x") < F.col(f"a{i}")).alias(f"u{i}"),
                                       F.count_if(F.col("_x") <= F.col(f"b{i}")).alias(f"w{i}"))])
        rows, out = attached(wide, counts), []
        for i in spots:
            hit = (F.col(f"u{i}") <= F.col(f"p{i}")) & (F.col(f"p{i}") < F.col(f"w{i}")) & F.col(
                f"a{i}").isNotNull() & F.col(f"b{i}").isNotNull()
            for name, new in (("lo", F.col(f"a{i}")), ("hi", F.col(f"b{i}")), ("below", F.col(f"u{i}")),
                              ("inside", F.col(f"w{i}") - F.col(f"u{i}"))):
                out.append(F.when(hit, new).otherwise(F.col(f"{name}{i}")).alias(f"{name}{i}"))
        return cut_lineage(rows.select(*g, "n", *[f"p{i}" for i in spots], *out))

    state = x.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"),
                              sketch(F.col("_x")).alias("q"))
    state = cut_lineage(state)
    state = narrowed(state.select(*g, "n", *[c for i in spots for c in (
        places[i](F.col("n")).cast("long").alias(f"p{i}"), F.col("lo").alias(f"lo{i}"), F.col("hi").alias(f"hi{i}"),
        F.lit(0).cast("long").alias(f"below{i}"), F.col("n").alias(f"inside{i}"), F.col("q").alias(f"q{i}"))]))

    def is_wide(i):
        return (F.col(f"inside{i}") > few) & (F.col(f"lo{i}") < F.col(f"hi{i}"))

    def total(s):
        return s.agg(F.sum(sum((F.when(is_wide(i), F.col(f"inside{i}")).otherwise(0) for i in spots), F.lit(0)))).first()[0]

    left = total(state) or 0
    while left:
        inner = attached(x, state.select(*g, *[c for i in spots for c in (
            F.when(is_wide(i), F.col(f"lo{i}")).alias(f"a{i}"), F.col(f"hi{i}").alias(f"b{i}"))]))
        quantiles = inner.groupBy(*g).agg(*[sketch(F.when(F.col("_x").between(F.col(f"a{i}"), F.col(f"b{i}")), F.col("_x")))
                                            .alias(f"q{i}") for i in spots])
        state = narrowed(cut_lineage(attached(state, quantiles)))
        before, left = left, total(state) or 0
        if left >= before:  # ties that a sketch cannot part: they are sorted as they are
            break

    spans = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"p{i}").alias("p"), F.col(f"lo{i}").alias("lo"),
                               F.col(f"hi{i}").alias("hi"), F.col(f"below{i}").alias("below")) for i in spots])
    near = F.lit(False)
    for i in spots:
        near = near | F.col("_x").between(F.col(f"lo{i}"), F.col(f"hi{i}"))
    inside = attached(x, state).where(near).withColumn("_spans", spans).select(
        *g, "n", "_x", F.inline(F.filter("_spans", lambda s: F.col("_x").between(s["lo"], s["hi"]))))
    counted = inside.groupBy(*g, "n", "i", "p", "below", "_x").agg(F.count(F.lit(1)).alias("c"))
    upto = F.col("below") + F.sum("c").over(Window.partitionBy(*g, "i").orderBy("_x"))
    found = counted.withColumn("_upto", upto).where(F.col("_upto") > F.col("p"))
    return found.groupBy(*g, "n").agg(*[F.min(F.when(F.col("i") == i, F.col("_x"))).alias(f"v{i}") for i in spots]).select(
        *[F.col(n).alias(c) for c, n in zip(by, g)], "n", *[f"v{i}" for i in spots])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str] | None = None,
                    by: Sequence[str] = (), few: int = FEW) -> DataFrame:
    """Exact quantiles with linear interpolation (``quantile_cont``) per group ``by``
    (one row without groups), by ``order_statistics``. Nulls are left out; a group of
    nulls alone has no row, and the one row without groups is of nulls."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])

    def at(p, rounded):
        return lambda n: rounded((n - 1) * F.lit(float(p)))

    places = [at(p, r) for p in probs for r in (F.floor, F.ceil)]
    found = order_statistics(df, col, places, by, few)
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        out.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    if by:
        return found.select(*by, *out)
    return found.select(*out).agg(*[F.first(n).alias(n) for n in names])


def box_plot(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """A-13: the five numbers of ``col`` per group, the fences ``whisker`` quartile ranges
    beyond the quartiles, the least and greatest values within them (the whiskers'
    ends) and the number of values outside: n, min, q1, median, q3, max, lower_fence,
    upper_fence, lower_whisker, upper_whisker, n_outliers."""
    five = exact_quantiles(df, col, [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q1", "median", "q3", "max"], by)
    reach = whisker * (F.col("q3") - F.col("q1"))
    fenced = five.select("*", (F.col("q1") - reach).alias("lower_fence"), (F.col("q3") + reach).alias("upper_fence"))
    x = df.where(F.col(col).isNotNull()).select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)],
                                                F.col(col).cast("double").alias("_x"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(f"_g{i}").eqNullSafe(F.col(c))
    value, inside = F.col("_x"), F.col("_x").between(F.col("lower_fence"), F.col("upper_fence"))
    if not by:  # one row of bounds
        row = cut_lineage(fenced)
        lower, upper = row.select("lower_fence").scalar(), row.select("upper_fence").scalar()
        ends = x.select("_x", ((value >= lower) & (value <= upper)).alias("_in")).agg(*_ends(value, F.col("_in")))
        return row.select("*", *[ends.select(c).scalar().alias(c) for c in ends.columns]).select(*_BOX)
    fenced = cut_lineage(fenced)
    ends = x.join(fenced, same).groupBy(*fenced.columns).agg(*_ends(value, inside))
    return ends.select(*by, *_BOX)


_BOX = ["n", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence", "lower_whisker", "upper_whisker",
        "n_outliers"]


def _ends(value: Column, inside: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.min(F.when(inside, value)).alias("lower_whisker"),
            F.max(F.when(inside, value)).alias("upper_whisker"), F.count_if(~inside).alias("n_outliers")]


def first_come_rank(df: DataFrame, value: str, key: str, out: str = "rank",
                    n_buckets: int | None = None) -> DataFrame:
    """1-based rank by (value, key) with ties in ``value`` broken by ``key``
    (``rank(method='first')`` when ``key`` is the arrival order), plus the row
    count ``_total``. Null values are dropped.

    Rows are dealt to ranges of (value, key), so one value that most rows hold is
    dealt to many ranges.
    """
    rows, _ = _numbered(df.where(F.col(value).isNotNull()), [value, key], "_at", n_buckets)
    return rows.select(*df.columns, (F.col("_at") + 1).alias(out), "_total")


def first_come_deciles(df: DataFrame, value: str, key: str, q: int = 10,
                       out: str = "decile", n_buckets: int | None = None) -> DataFrame:
    """W-07: ``qcut(rank(method='first'), q)`` as integers.

    With r = ``first_come_rank`` and n rows: bucket = max(0, ceil(q (r-1) / (n-1)) - 1),
    0 when n = 1.
    """
    x = first_come_rank(df, value, key, "_r", n_buckets)
    r = F.col("_r")
    n = F.col("_total")
    dec = F.when(n <= 1, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.ceil(F.lit(q) * (r - 1) / (n - 1)) - 1)).cast("int")
    return x.withColumn(out, dec).select(*df.columns, out)
