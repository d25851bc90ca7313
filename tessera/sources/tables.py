"""Driver tables and the role each plays for the reference's operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; projections/filters applied later reach the scan."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Attribute access to the tables of one scale factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
