"""Sampling, rebalancing and train/validation/test splits.

Reproducible splits hash the key instead of drawing ``rand()``: a row's side
never depends on partitioning, task retries or the order rows arrive in, and
features and labels stay aligned because they share the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import counts_with_prefix

_P = 2147483647  # 2^31 - 1
_A = 48271       # MINSTD multiplier; products stay below 2^47


def hash_value(key: str | Column, seed: int = 0) -> Column:
    """Two Lehmer steps of (key + seed) mod 2^31-1: a bijection on [0, 2^31-1),
    so distinct keys below that bound never collide (larger ones can: exact
    orders break ties by the key)."""
    k = F.col(key) if isinstance(key, str) else key
    x = F.pmod(F.pmod(k.cast("long"), F.lit(_P)) + F.lit(seed), F.lit(_P))
    x = F.pmod(x * _A, F.lit(_P))
    return F.pmod(x * _A, F.lit(_P))


def hash_value_sql(key: str, seed: int = 0) -> str:
    x = f"(({key} + {seed}) % {_P})"
    x = f"(({x} * {_A}) % {_P})"
    return f"(({x} * {_A}) % {_P})"


def below(fraction: float) -> int:
    """Hash values below this bound make up ``fraction`` of [0, 2^31-1)."""
    return round(fraction * _P)


def hash_bucket(key: str | Column, modulus: int, seed: int = 0) -> Column:
    """Deterministic bucket in [0, modulus) of an integer key (two Lehmer steps).

    Only integer arithmetic that any SQL engine reproduces exactly; for
    non-integer keys pass ``F.xxhash64(...)``.
    """
    return F.pmod(hash_value(key, seed), F.lit(modulus))


def hash_bucket_sql(key: str, modulus: int, seed: int = 0) -> str:
    return f"({hash_value_sql(key, seed)} % {modulus})"


def hash_uniform(key: str | Column, seed: int = 0) -> Column:
    """A number in [0, 1) per key, the same in every engine, run and partitioning."""
    return hash_value(key, seed).cast("double") / F.lit(float(_P))


def hash_uniform_sql(key: str, seed: int = 0) -> str:
    return f"(CAST({hash_value_sql(key, seed)} AS DOUBLE) / {float(_P)!r})"


def hash_rebalance(df: DataFrame, label: str, minority, minority_fraction: float, majority_fraction: float, key: str,
                   seed: int = 0, copy: str = "copy") -> DataFrame:
    """U-03 by hashes: a minority row comes floor(fraction) times and once more where its
    hash lies below the rest of the fraction; a majority row stays where its hash lies
    below its fraction. ``copy`` numbers the copies from 0. Null labels are majority."""
    is_minority = F.coalesce(F.col(label) == F.lit(minority), F.lit(False))
    whole, rest = int(minority_fraction), minority_fraction - int(minority_fraction)
    h = hash_value(key, seed)
    copies = F.when(is_minority, F.lit(whole) + (h < below(rest)).cast("int")).otherwise(
        (h < below(majority_fraction)).cast("int"))
    return df.withColumn("_copies", copies).where("_copies > 0").withColumn(
        copy, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """U-02: Spark's seeded Bernoulli sample (stable for a fixed partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: str | Column, fraction: float,
                seed: int = 0) -> DataFrame:
    """U-02: keep rows whose key hashes below ``fraction``; reproducible anywhere."""
    return df.where(hash_value(key, seed) < below(fraction))


def rebalance(df: DataFrame, label: str, minority, minority_fraction: float,
              majority_fraction: float, seed: int) -> DataFrame:
    """U-03: oversample the minority class with replacement (fraction may exceed 1)
    and undersample the majority without replacement, then union."""
    mino = df.where(F.col(label) == F.lit(minority)) \
             .sample(withReplacement=True, fraction=minority_fraction, seed=seed)
    majo = df.where(F.col(label) != F.lit(minority)) \
             .sample(withReplacement=False, fraction=majority_fraction, seed=seed + 1)
    return mino.unionByName(majo)


def class_weights(df: DataFrame, label: str, weights: dict | str = "balanced",
                  out: str = "weight") -> DataFrame:
    """U-04: per-row class weight: a fixed mapping or 'balanced' = n / (k * n_c)."""
    if weights == "balanced":
        counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
        n = counts.select(F.sum("_nc")).scalar()
        k = counts.select(F.count(F.lit(1))).scalar()
        table = counts.select(label, (n / (k * F.col("_nc"))).alias(out))
        return df.join(table, label, "left")
    mapping = F.create_map(*[x for kv in weights.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
    return df.withColumn(out, mapping[F.col(label)])


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 0,
               out: str = "split") -> DataFrame:
    """U-05: 'train' / 'dev' by key hash; features and labels align by key."""
    train = hash_value(key, seed) < below(train_fraction)
    return df.withColumn(out, F.when(train, "train").otherwise("dev"))


def exact_split(df: DataFrame, key: str, dev_fraction: float = 0.2, seed: int = 0,
                out: str = "split") -> DataFrame:
    """U-05 with exact sizes: exactly ceil(dev_fraction * n) rows are 'dev',
    chosen by a keyed hash order, ties by the key; the position comes from
    distributed prefix counts. Keys are integers and unique."""
    return repeated_holdout(df, key, 1, dev_fraction, seed).drop("rep") \
        .withColumnRenamed("split", out)


def positional_split(df: DataFrame, order_key: str, first_n: int | None = None,
                     out: str = "part") -> DataFrame:
    """U-06: 'first' for the first ``first_n`` rows by ``order_key`` (default: half),
    'rest' otherwise; positions come from distributed prefix counts."""
    pos = counts_with_prefix(df.select(order_key), order_key)
    total = df.where(F.col(order_key).isNotNull()).select(F.count(F.lit(1))).scalar()
    cut = F.lit(first_n) if first_n is not None else F.floor(total / 2)
    x = df.join(pos.select(order_key, "before"), order_key)
    return x.withColumn(out, F.when(F.col("before") < cut, "first").otherwise("rest")).drop("before")


def calendar_split(df: DataFrame, ts: str, train_until: int, validate_year: int,
                   test_year: int, out: str = "split") -> DataFrame:
    """U-07: train <= train_until, then one validation and one test year."""
    y = F.year(ts)
    return df.withColumn(out, F.when(y <= train_until, "train").when(y == validate_year, "validate")
                         .when(y == test_year, "test"))


def expanding_folds(df: DataFrame, order_col: str, k: int) -> DataFrame:
    """U-08: expanding-window time folds as one table with (fold, role).

    With p = 1/(k+2) and pr = percent rank by ``order_col``: fold i trains on
    pr <= p*i, validates on (p*i, p*(i+1)] and tests on (p*(i+1), p*(i+2)].
    Compared in integers, (rank-1)(k+2) <= i(n-1), so no float literal decides
    a boundary row. A row appears once per fold that uses it (at most k rows).
    """
    if order_col not in df.columns:
        raise ValueError(f"missing column {order_col}")
    pos = counts_with_prefix(df, order_col)
    x = df.join(pos.select(order_col, "before", "total"), order_col)
    b = F.col("before") * (k + 2)
    m = F.col("total") - 1

    def role(i):
        return F.when(b <= i * m, "train").when(b <= (i + 1) * m, "validate") \
                .when(b <= (i + 2) * m, "test")

    folds = F.array(*[F.struct(F.lit(i).alias("fold"), role(i).alias("role"))
                      for i in range(1, k + 1)])
    x = x.withColumn("_f", F.explode(F.filter(folds, lambda s: s["role"].isNotNull())))
    return x.select(*df.columns, "_f.fold", "_f.role")


def sliding_test_folds(df: DataFrame, order_col: str, n_splits: int, test_size: int) -> DataFrame:
    """U-09: ``TimeSeriesSplit(n_splits, test_size)``: fold j tests on the j-th of
    the last ``n_splits`` blocks of ``test_size`` rows and trains on all rows
    before it. Returns (…, fold, role)."""
    pos = counts_with_prefix(df.select(order_col), order_col)
    x = df.join(pos.select(order_col, "before", "total"), order_col)
    start = F.col("total") - n_splits * test_size

    def role(j):
        s = start + j * test_size
        return F.when(F.col("before") < s, "train") \
                .when(F.col("before") < s + test_size, "test")

    folds = F.array(*[F.struct(F.lit(j).alias("fold"), role(j).alias("role"))
                      for j in range(n_splits)])
    x = x.withColumn("_f", F.explode(F.filter(folds, lambda s: s["role"].isNotNull())))
    return x.select(*df.columns, "_f.fold", "_f.role")


def repeated_holdout(df: DataFrame, key: str, repeats: int, dev_fraction: float,
                     seed: int = 0) -> DataFrame:
    """U-10: ``repeats`` independent random hold-outs, each with exactly
    ceil(dev_fraction * n) dev rows, in one pass.

    Every row is expanded to one row per repetition (a generator, not a join);
    within repetition r rows are ordered by a keyed hash, ties by the key itself,
    and the first ceil(fraction * n) are 'dev'. The position within a repetition
    comes from distributed prefix counts over (r, hash, key) as one decimal, so
    no repetition is sorted on a single task. Keys are integers and unique.
    """
    n = df.select(F.count(F.lit(1))).scalar()
    x = df.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    k = F.col(key).cast("long")
    h = F.col("rep").cast("long") * _P + hash_value(F.pmod(k, F.lit(_P)) + F.col("rep") * 7919, seed)
    x = x.withColumn("_h", (h.cast("decimal(18,0)") * F.lit(Decimal(1 << 64))
                            + k.cast("decimal(19,0)")).cast("decimal(38,0)"))
    pos = counts_with_prefix(x.select("_h"), "_h").select("_h", "before")
    x = x.join(pos, "_h")
    rank_in_rep = F.col("before") - F.col("rep") * n
    return x.withColumn("split", F.when(rank_in_rep < F.ceil(F.lit(dev_fraction) * n), "dev")
                        .otherwise("train")).drop("_h", "before")


def kfold(df: DataFrame, key: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """U-11: fold number in [0, k) from the key hash (usable as ``foldCol``)."""
    return df.withColumn(out, hash_bucket(key, k, seed).cast("int"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """U-01: union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
