"""Splits with large keys and small fractions, prefix sums over text keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import split as U
from tessera.operators.ranking import counts_with_prefix

BIG = 2147483647


@pytest.fixture(scope="module")
def big_keys(spark):
    # every three keys are equal modulo 2^31-1
    return spark.range(0, 1002).select(
        (F.floor(F.col("id") / 3) + (F.col("id") % 3) * BIG * 1000 - 5).cast("long").alias("k"))


@pytest.mark.parametrize("fraction", [0.101, 0.25, 0.999])
def test_exact_split_sizes_with_colliding_keys(big_keys, fraction):
    dev = U.exact_split(big_keys, "k", fraction).where("split = 'dev'").count()
    assert dev == -(-1002 * round(fraction * 1000) // 1000)


def test_repeated_holdout_sizes_with_colliding_keys(big_keys):
    got = U.repeated_holdout(big_keys, "k", 4, 0.1, 5).where("split = 'dev'").groupBy("rep").count().collect()
    assert {r["rep"]: r["count"] for r in got} == {i: 101 for i in range(4)}


@pytest.mark.parametrize("fraction", [0.995, 0.00001, 0.5])
def test_hash_fractions_are_not_rounded(spark, fraction):
    n = 400_000
    keys = spark.range(n)
    slack = 5 * (n * fraction * (1 - fraction)) ** 0.5 + 1
    train = U.hash_split(keys, "id", fraction).where("split = 'train'").count()
    kept = U.hash_sample(keys, "id", fraction, 3).count()
    assert abs(train - n * fraction) <= slack
    assert abs(kept - n * fraction) <= slack


def test_prefix_counts_over_text_keys(spark):
    words = ["", "a", "a", "ab", "abcdefgh", "abcdefgi", "abcdefgi", "b", "zé", "z", "日本", "日"]
    got = counts_with_prefix(spark.createDataFrame([(w,) for w in [*words, None]], "w string"), "w", 4).collect()
    for r in got:
        code = r["w"].encode()
        assert r["before"] == sum(x.encode() < code for x in words)
        assert r["n"] == words.count(r["w"])
        assert r["total"] == len(words)
