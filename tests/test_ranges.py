"""Ranks, neighbouring rows and quantiles over key ranges, against plain windows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ranking as R


def test_text_keys_with_a_common_prefix_spread(spark):
    keys = spark.range(4000).select(F.format_string("https://example.com/page/%06d", "id").alias("k"))
    rows = R.in_ranges(keys, ["k"], 8)
    sizes = [r["count"] for r in rows.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 500
    got = R.counts_with_prefix(keys, "k", 8).orderBy("k").select("before").collect()
    assert [r["before"] for r in got] == list(range(4000))


def test_nested_keys_are_ranged(spark):
    rows = [(i, (i % 3, f"x{i % 7}")) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k struct<a: int, b: string>")
    got = {(r["k"]["a"], r["k"]["b"]): (r["n"], r["before"]) for r in R.counts_with_prefix(df, "k", 5).collect()}
    keys = [k for _, k in rows]
    assert got == {k: (keys.count(k), sum(x < k for x in keys)) for k in set(keys)}


@pytest.mark.parametrize("lag, ranges", [(1, 5), (3, 4), (7, 12), (50, 3), (1, None)])
def test_lagged_hands_rows_over_borders(spark, lag, ranges):
    rng = random.Random(lag)
    rows = [(i, f"key{i:04d}", rng.choice([None, 1.0, 2.5])) for i in rng.sample(range(300), 40)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = R.lagged(df, "k", ["v", "id"], lag, n_ranges=ranges)
    w = Window.orderBy("k")
    want = df.select("*", (F.row_number().over(w) - 1).alias("pos"), F.lag("v", lag).over(w).alias("prev_v"),
                     F.lag("id", lag).over(w).alias("prev_id"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_positions_of_equal_and_null_keys(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3) for i in range(50)], "id long, k int")
    rows = R.positions(df, "k", n_ranges=3).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(50))
    keys = [r["k"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert R.positions(df.where("false"), "k").count() == 0


@pytest.mark.parametrize("few", [10_000, 3])
def test_quantiles_by_group(spark, few):
    rng = np.random.default_rng(few)
    groups = {"a": rng.normal(size=2000).tolist(), "b": [4.0] * 900 + [1.0, 2.0], "c": [7.5],
              None: rng.integers(0, 5, 700).astype(float).tolist()}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("only", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: list(r)[1:] for r in R.exact_quantiles(df, "v", probs, by=["g"], few=few).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(list(np.quantile(vs, probs)), abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert list(R.exact_quantiles(df, "v", [0.25, 0.5]).first()) == [None, None]
    assert R.box_plot(df.withColumn("g", F.lit(1)), "v", ["g"]).count() == 0


def test_box_plot_counts_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -90.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = R.box_plot(df, "v").first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (row["q1"], row["q3"], row["n"], row["n_outliers"]) == (q1, q3, 7, 2)
    assert (row["lower_whisker"], row["upper_whisker"]) == (1.0, 5.0)
    assert row["upper_fence"] == pytest.approx(q3 + 1.5 * (q3 - q1))
