"""Null keys and tie-breaks of any type in the temporal operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators.joins import asof_join
from tessera.operators.temporal import previous_leg_flag, trailing_count

T0 = datetime(2024, 3, 1, 0, 5)
ROWS = [(k, None if k % 3 == 0 else f"u{k % 2}", T0 + timedelta(minutes=97 * (k // 2)), 20 if k % 4 else 3)
        for k in range(60)]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(ROWS, "id long, unit string, ts timestamp, delay int")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_previous_leg_bucketed_equals_plain_with_null_units(events):
    plain = previous_leg_flag(events, "unit", "ts", "delay", tiebreak="id")
    cut = previous_leg_flag(events, "unit", "ts", "delay", tiebreak="id", bucket_seconds=7200)
    assert _rows(plain.select("id", "prev_delayed")) == _rows(cut.select("id", "prev_delayed"))
    assert plain.where("unit is null and prev_delayed = 1").count() > 0


def test_trailing_count_bucketed_equals_plain_with_null_places(events):
    plain = trailing_count(events, "unit", "ts", "delay")
    cut = trailing_count(events, "unit", "ts", "delay", bucket_seconds=7200)
    name = [c for c in plain.columns if c not in events.columns][0]
    key = F.coalesce(name, F.lit(-1))
    assert _rows(plain.select("id", key)) == _rows(cut.select("id", key))
    assert plain.where(f"unit is null and {name} > 0").count() > 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("tiebreak", [None, "name"])
@pytest.mark.parametrize("bucket", [None, 3600])
def test_asof_tie_breaks_of_any_type(spark, kind, tiebreak, bucket):
    left = spark.createDataFrame([(1, "a", T0 + timedelta(hours=3)), (2, None, T0)], "id long, k string, t timestamp")
    right = spark.createDataFrame([("a", T0, "x"), ("a", T0 + timedelta(hours=1), "y"),
                                   ("a", T0 + timedelta(hours=1), "z" if tiebreak else "y")],
                                  "k string, rt timestamp, name string")
    left, right = left.withColumn("t", F.col("t").cast(kind)), right.withColumn("rt", F.col("rt").cast(kind))
    got = asof_join(left, right, "k", "t", "rt", ["name"], prefix="r_", right_tiebreak=tiebreak, bucket_seconds=bucket)
    assert {r["id"]: r["r_name"] for r in got.collect()} == {1: "z" if tiebreak else "y", 2: None}
