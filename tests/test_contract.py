"""The driver's entry points."""

import importlib


def test_entry_runs(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["event_type", "n_rows", "n_delayed", "n_prev_delayed", "sum_prev_delays",
                          "n_asof_matched"]


def test_oracle_keys_are_queries():
    entry = importlib.import_module("__spark_entry__")
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 100
