"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Arrow batch of results may hold before it is handed to Spark.
OUT_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Map each row of ``df`` to one output row in Arrow batches.

    ``make()`` runs once per task and returns a function from a row's values
    (in column order) to the tuple of the output row. Batches are cut to
    ``OUT_ROWS`` rows, so memory is bounded by that many input rows.
    """
    out = df.sparkSession.createDataFrame([], schema).schema
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                rows = [one(*r) for r in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)],
                        schema=arrow)

    return df.mapInArrow(run, out)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class Memo(dict):
    """A bounded memo table: a miss is computed, and a full table starts anew.

    Only a cache: its bound changes the speed and never a result.
    """

    def __init__(self, compute: Callable, limit: int = 300_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def let(value, body):
    """Bind ``value`` once for ``body``: an array expression that a lambda uses
    many times is then computed once per row."""
    return F.transform(F.array(value), body)[0]


def flatten(parts):
    return itertools.chain.from_iterable(parts)


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
