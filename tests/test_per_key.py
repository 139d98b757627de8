"""Statistics per key: rows or partial sums move, whichever is less."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators.recipes import aggregate, recipe_grid

AGGS = ["mean", "min", "max", "sum", "var"]


def _stats(df):
    (_, stats), = aggregate(df, recipe_grid(["k"], ["x", "y"], AGGS))
    return stats


def _table(spark, small, hot):
    rows = [(i // 2, float(i % 13), float(i)) for i in range(small)] + [(-1, float(i % 7), None) for i in range(hot)] \
        + [(None, 1.0, 2.0)] * 5
    return spark.createDataFrame(rows, "k long, x double, y double").repartition(4)


@pytest.mark.parametrize(("small", "hot"), [(400, 0), (4000, 900), (20, 4000)])
def test_grid_equals_plain_aggregates(spark, small, hot):
    df = _table(spark, small, hot)
    got = {r["k"]: r for r in _stats(df).collect()}
    want = df.where("k is not null").groupBy("k").agg(
        F.avg("x").alias("k_mean_x"), F.var_samp("x").alias("k_var_x"), F.min("y").alias("k_min_y"), F.max("x").alias("k_max_x"),
        F.coalesce(F.sum("y"), F.lit(0)).alias("k_sum_y")).collect()
    assert len(want) == len(got) == small // 2 + (hot > 0)
    for r in want:
        for c, v in r.asDict().items():
            assert got[r["k"]][c] == (None if v is None else pytest.approx(v)), (r["k"], c)


def test_small_groups_move_rows_and_hot_ones_partial_sums(spark):
    small = _stats(_table(spark, 4000, 0))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in small and "Union" not in small
    both = _stats(_table(spark, 4000, 900))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in both and "LeftSemi" in both and "LeftAnti" in both
    large = _stats(_table(spark, 20, 4000))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [k" not in large


def test_groups_scattered_over_tasks_move_rows(spark):
    """Ten rows a group, but each in a task of its own."""
    apart = spark.range(0, 2000, 1, 10).select((F.col("id") % 200).alias("k"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    assert "RepartitionByExpression [k" in _stats(apart)._jdf.queryExecution().optimizedPlan().toString()


def test_no_rows(spark):
    assert _stats(_table(spark, 0, 0)).count() == 0
