"""Scratch tables of a session."""

import os

from tessera import session as S


def test_scratch_is_released(spark, monkeypatch):
    monkeypatch.setattr(S, "_SCRATCH", [])
    path = S.scratch_path(spark, "test")
    assert S.cut_lineage(spark.range(3), path=path).count() == 3
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    assert S.release_scratch(spark) == 1 and not os.path.exists(local)
    assert S.release_scratch(spark) == 0


def test_a_kept_partitioning_is_neither_shuffled_nor_sorted_again(spark):
    from tessera.session import cut_lineage

    table = spark.range(100).selectExpr("cast(id % 7 as int) as p", "id")
    kept = cut_lineage(table.repartition(9, "p").sortWithinPartitions("p"), keep_partitioning=True)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    plan = kept.groupBy("p").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort " not in plan
    assert kept.count() == 100


def test_one_scratch_table_is_dropped(spark):
    import os

    from tessera.session import _SCRATCH, cut_lineage, drop_scratch, scratch_path

    path = scratch_path(spark, "t")
    cut_lineage(spark.range(3), path=path)
    assert os.listdir(path.removeprefix("file:"))
    drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:")) and path not in _SCRATCH
