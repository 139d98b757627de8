"""CSV scans and the prediction sink.

Reads take an explicit schema (no inference pass over the data) and the
RFC-4180 quoting the reference inputs use (doubled quotes inside quoted
fields).  Column-pruned reads select right after the scan so Catalyst
passes only those columns to the CSV reader.  The sink writes a two-column
CSV with a header; on a cluster the path is on shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables import missing_as_null

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false",
               "mode": "FAILFAST", "nullValue": ""}


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
             usecols: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with a fixed schema; ``paths`` may list
    several parts, which are read as one table; ``usecols`` prunes.  A NaN
    in a number column is a missing value (C0)."""
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(
        list(paths) if not isinstance(paths, str) else paths)
    return missing_as_null(df.select(*usecols) if usecols else df)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    """Write a frame as header CSV (one file per partition)."""
    df.write.options(**CSV_OPTIONS).mode(mode).csv(path)
    return path


def write_predictions(df: DataFrame, id_col: str, pred_col: str, path: str, mode: str = "error") -> str:
    """The ``id, prediction`` submission file with a header and no index."""
    return write_csv(df.select(id_col, pred_col), path, mode)
