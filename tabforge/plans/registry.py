"""Registry of driver queries: ``name -> (spark builder, oracle SQL)``.

Each plan module registers its queries with ``@query(name, sql)``.  The
name is ``<operator id>_<slug>`` (SURVEY §2).  ``sql`` is the DuckDB form
over the same parquet tables; ``None`` marks a query that can only be
checked by row count (model fits, seeded draws).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DECIMALS = 6


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# --- value normalisation shared by both sides -----------------------------------
# Doubles are compared after ``floor(x * 1e6 + OFFSET) / 1e6``: the same IEEE
# operations in Spark and DuckDB, so equal inputs give equal outputs.  The
# rounding edge sits at a fraction of .618034 of the last digit instead of
# .5, because values built from short decimals (prices, their sums and
# variances) land exactly on .5 edges, where a last-bit difference between
# two summation orders would flip the rounded digit.
OFFSET = "0.381966"


def rnd(c: Column, decimals: int = DECIMALS) -> Column:
    scale = 10 ** decimals
    return F.floor(c * scale + F.lit(float(OFFSET))) / scale


def R(expr: str, decimals: int = DECIMALS) -> str:
    """SQL twin of ``rnd``."""
    return f"(floor(({expr}) * 1e{decimals} + CAST({OFFSET} AS DOUBLE)) / 1e{decimals})"


# Timestamps are compared as 'yyyy-MM-dd HH:mm:ss' text (the results here
# have whole seconds), so the check does not depend on the time unit each
# engine hands to the client.
TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss"


def ts_text(c: Column) -> Column:
    return F.date_format(c, TS_FMT_SPARK)


def TS(expr: str) -> str:
    """SQL twin of ``ts_text``."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def finish(df: DataFrame, decimals: int = DECIMALS, overrides: dict | None = None) -> DataFrame:
    """Round every double/float column of a query result with ``rnd``
    (``overrides`` gives other decimals per column, e.g. for variances)."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = overrides.get(f.name, decimals)
            out.append(rnd(F.col(f"`{f.name}`").cast("double"), d).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
