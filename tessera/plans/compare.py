"""Side-by-side check of a registered query against its DuckDB oracle SQL.

Mirrors the driver's gate: same column names, same row count, same multiset
of rows. Floats are compared at 9 significant digits, timestamps as ISO text.
"""

from __future__ import annotations

import datetime as dt
import math
import os

from tessera.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    try:
        import numpy as np

        if isinstance(v, np.generic):
            return _norm(v.item())
    except ImportError:  # pragma: no cover
        pass
    if hasattr(v, "to_pydatetime"):
        return _norm(v.to_pydatetime())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


_SPARK_TO_DUCK = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
    "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    if spark_type.startswith("array<"):
        return _duck_type(spark_type[6:-1]) + "[]"
    return _SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def type_mismatches(sdf, res) -> dict:
    """Columns whose Spark type maps to a different DuckDB type."""
    duck = {d[0]: str(d[1]).upper().replace(" ", "") for d in res.description}
    out = {}
    for f in sdf.schema.fields:
        want = _duck_type(f.dataType.simpleString()).replace(" ", "")
        got = duck.get(f.name)
        if got is not None and got != want:
            out[f.name] = (f.dataType.simpleString(), got)
    return out


def compare(spark, query, sql: str, sf_dir: str, con=None) -> dict:
    """Run both sides; return a dict with ``ok`` and the first differences."""
    con = con or duckdb_connection(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = _rows(s_cols, [tuple(r) for r in sdf.collect()])
    res = con.execute(sql)
    report_types = type_mismatches(sdf, res)
    d_cols = [d[0] for d in res.description]
    d_rows = _rows(d_cols, res.fetchall())
    report = {"columns_spark": sorted(s_cols), "columns_sql": sorted(d_cols),
              "rows_spark": len(s_rows), "rows_sql": len(d_rows)}
    report["cols_ok"] = sorted(s_cols) == sorted(d_cols)
    report["rows_ok"] = len(s_rows) == len(d_rows)
    report["values_ok"] = s_rows == d_rows
    if not report["values_ok"]:
        only_s = [r for r in s_rows if r not in set(d_rows)][:3]
        only_d = [r for r in d_rows if r not in set(s_rows)][:3]
        report["only_spark"] = only_s
        report["only_sql"] = only_d
    report["types"] = report_types
    report["ok"] = report["cols_ok"] and report["rows_ok"] and report["values_ok"]
    return report
