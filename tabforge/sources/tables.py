"""Parquet scans of the driver tables.

Scans are lazy: Catalyst prunes columns and pushes filters into the
parquet reader, so a query that touches two columns reads two columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.contract import nan_to_null

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def missing_as_null(df: DataFrame) -> DataFrame:
    """C0 at ingest: NaN in a floating column becomes NULL.  Text sources
    pass through here; a Parquet table that may hold NaN does on request,
    as a filter on such a column no longer reaches the scan."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def table(spark: SparkSession, sf_dir: str, name: str, nan_missing: bool = False) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return missing_as_null(df) if nan_missing else df


class Tables:
    """Attribute access to the driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
