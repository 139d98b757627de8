"""Shared pieces of the driver-table mappings.

The driver tables hold no missing values, coordinates or binary targets,
so each mapping derives them by a fixed rule that the oracle SQL repeats
verbatim.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables
from .registry import TS, R, finish, query, rnd, ts_text  # noqa: F401  (re-exported for plan modules)


def T(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --- application rows: one per order, with customer attributes ------------------
# Sentinel '4-NOT SPECIFIED' -> missing (P08); every 7th order's price missing.
APP_SQL = """
app AS (
  SELECT o_orderkey, o_custkey, c_mktsegment,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
         o_orderstatus,
         CAST(o_orderkey % 2 AS INTEGER) AS o_flag,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         c_acctbal, c_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def application(t: Tables) -> DataFrame:
    o, c = t.orders, t.customer
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select("o_orderkey", "o_custkey", "c_mktsegment",
                    F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
                    "o_orderstatus",
                    (F.col("o_orderkey") % 2).cast("int").alias("o_flag"),
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit(None))
                    .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                    "c_acctbal", "c_nationkey"))


# --- binary target per customer --------------------------------------------------
TARGET_SQL = """
target AS (
  SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer)"""


def target(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("target"))


# --- SQL twins of the contract ------------------------------------------------------
SQL_AGG = {"mean": "avg({})", "max": "max({})", "min": "min({})",
           "sum": "coalesce(sum({}), 0)", "median": "median({})", "var": "var_samp({})",
           "std": "stddev_samp({})", "count": "count({})", "nunique": "count(DISTINCT {})"}


def sql_ratio(num: str, den: str) -> str:
    """C4: NULL on a zero denominator."""
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def sql_ratio_inf0(num: str, den: str) -> str:
    """+inf -> 0, 0/0 and -x/0 missing."""
    return (f"(CASE WHEN CAST({den} AS DOUBLE) = 0 AND {num} > 0 THEN 0.0 "
            f"ELSE {sql_ratio(num, den)} END)")


def sql_grid(keys: list[str], cols: list[str], aggs: list[str]) -> list[tuple[str, str, str]]:
    """(name, sql expression, agg) for a recipe grid, agg-major like the
    reference's recipe lists."""
    from ..operators.recipes import stat_name
    return [(stat_name(keys, a, c), SQL_AGG[a].format(c), a) for a in aggs for c in cols]


def rounded_select(items: list[tuple[str, str, str]]) -> str:
    """Round each grid column; variances to 2 decimals."""
    return ", ".join(f"{R(e, 2 if a == 'var' else 6)} AS {n}" for n, e, a in items)


def var_overrides(names) -> dict:
    return {n: 2 for n in names if "_var_" in n}
