"""Unit tests of the missing-value contract on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from tabforge.functions import contract as C
from tabforge.functions import rowwise as RW


def test_c0_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    out = [r[0] for r in df.select(C.nan_to_null("x")).collect()]
    assert out[0] is None and out[1] == 1.0 and out[2] is None


def test_c1_sum_of_all_missing_group_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "k int, x double")
    got = dict(df.groupBy("k").agg(C.sum0("x").alias("s")).collect())
    assert got == {1: 0.0, 2: 3.0}


def test_c2_var_of_one_row_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0)], "k int, x double")
    got = dict(df.groupBy("k").agg(C.agg_by_name("var", "x")).collect())
    assert got[1] is None and got[2] == pytest.approx(2.0)


def test_c3_missing_key_gets_no_stats(spark):
    from tabforge.operators.recipes import enrich
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, None, 10.0)], "id int, k string, x double")
    out = {r["id"]: r["k_mean_x"] for r in enrich(df, [(["k"], [("x", "mean")])]).collect()}
    assert out == {1: 2.0, 2: 2.0, 3: None}


def test_c4_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(C.ratio("a", "b")).collect()] == [None, None, 2.0]


def test_c5_ratio_inf0(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (-5.0, 0.0), (6.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(C.ratio_inf0("a", "b")).collect()] == [0.0, None, None, 2.0]


def test_c6_flags(spark):
    df = spark.createDataFrame([("Closed",), ("Active",), (None,)], "s string")
    ne = [r[0] for r in df.select(C.flag_ne("s", "Closed")).collect()]
    eq = [r[0] for r in df.select(C.flag_eq("s", "Active")).collect()]
    assert ne == [0, 1, 1] and eq == [0, 1, 0]


def test_c7_drop_keeps_missing(spark):
    from tabforge.operators.clean import drop_outside
    df = spark.createDataFrame([(100,), (200,), (None,), (90000,)], "d int")
    kept = sorted((r[0] is None, r[0]) for r in drop_outside(df, {"d": (120, 85000)}).collect())
    assert kept == [(False, 200), (True, None)]


def test_c8_last_skips_missing(spark):
    from tabforge.operators.recency import last_by
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (1, 3, None), (2, 1, None)],
                               "k int, o int, v double")
    got = {r["k"]: r["v"] for r in last_by(df, "k", ["o"], ["v"]).collect()}
    assert got == {1: 20.0, 2: None}


def test_c9_tail_counts_missing_rows(spark):
    from tabforge.operators.recency import tail_stats
    rows = [(1, i, float(i) if i != 5 else None) for i in range(1, 7)]
    df = spark.createDataFrame(rows, "k int, o int, v double")
    r = tail_stats(df, "k", ["o"], [1, 3, 5], ["v"]).collect()[0]
    # last 1 is o=6 -> 6; last 3 = {4, 5(missing), 6} -> 5; last 5 = {2,3,4,6} -> 3.75
    assert r["v_last_1_mean"] == 6.0 and r["v_last_3_mean"] == 5.0 and r["v_last_5_mean"] == 3.75


def test_c10_c11_rowwise(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    r1, r2 = df.select(RW.row_min(cols), RW.row_max(cols), RW.row_sum(cols), RW.row_mean(cols),
                       RW.row_std(cols), RW.row_median(cols)).collect()
    assert list(r1) == [1.0, 3.0, 4.0, 2.0, 1.0, 2.0]
    assert list(r2) == [None, None, 0.0, None, None, None]


def test_c12_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 2.0, 4.0), (1.0, 3.0, 6.5)], "c double, x double, y double")
    r = df.agg(C.safe_corr("c", "y").alias("k"), C.safe_corr("x", "y").alias("xy"),
               F.corr("x", "y").alias("ref")).collect()[0]
    assert r["k"] is None and r["xy"] == pytest.approx(r["ref"])


def test_c13_half_even_hour_rounding(spark):
    from tabforge.functions.timefn import round_to_minutes
    df = spark.createDataFrame([("2016-01-01 00:30:00",), ("2016-01-01 01:30:00",), ("2016-01-01 01:30:01",)],
                               "s string").select(F.to_timestamp_ntz("s").alias("t"))
    got = [str(r[0]) for r in df.select(round_to_minutes("t", 60)).collect()]
    assert got == ["2016-01-01 00:00:00", "2016-01-01 02:00:00", "2016-01-01 02:00:00"]


def test_c14_monday_is_zero(spark):
    from tabforge.functions.timefn import dow_monday0
    df = spark.createDataFrame([("2016-01-04 10:00:00",), ("2016-01-10 10:00:00",)], "s string")
    got = [r[0] for r in df.select(dow_monday0(F.to_timestamp_ntz("s"))).collect()]
    assert got == [0, 6]


def test_c15_open_left_rolling_frame(spark):
    from tabforge.operators.timebucket import rolling_mean
    rows = [("2016-01-01 00:00:00", 1, 2), ("2016-01-01 04:00:00", 1, 4), ("2016-01-01 03:00:00", 1, 6)]
    df = spark.createDataFrame(rows, "b string, k int, cnt int").select(
        F.to_timestamp_ntz("b").alias("bucket"), "k", "cnt")
    got = {str(r["bucket"]): r["rolling_mean"] for r in rolling_mean(df, "k", 240, 0).collect()}
    # the bucket exactly 240 minutes back is outside (t-240, t]
    assert got["2016-01-01 04:00:00"] == 5.0 and got["2016-01-01 00:00:00"] == 2.0


def test_c17_one_hot_missing_is_all_zero(spark):
    from tabforge.operators.encode import fit_categories, one_hot
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, s string")
    out = {r["id"]: (r["s_a"], r["s_b"]) for r in one_hot(df, fit_categories(df, ["s"])).collect()}
    assert out == {1: (1, 0), 2: (0, 1), 3: (0, 0)}


def test_c18_fill_then_null_out(spark):
    from tabforge.operators.clean import fill_constant, null_beyond
    df = spark.createDataFrame([(None,), (20000000.0,), (5.0,)], "x double")
    out = null_beyond(fill_constant(df, {"x": 0.0}), {"x": (">", 10000000)})
    assert [r[0] for r in out.collect()] == [0.0, None, 5.0]


def test_guarded_log(spark):
    from tabforge.functions.scalar import guarded_log
    df = spark.createDataFrame([(math.e,), (0.0,), (-1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(guarded_log("x")).collect()] == [pytest.approx(1.0), 0.0, 0.0, 0.0]


def test_fill_stats_median_and_mean_per_split(spark):
    """Missing values filled with the split's own exact median and mean."""
    import pandas as pd

    from tabforge.operators.clean import fill_stats
    pdf = pd.DataFrame({"id": range(7), "age": [1.0, None, 3.0, 10.0, None, 4.0, 8.0],
                        "fare": [2.0, 4.0, None, 6.0, 8.0, None, 10.0]})
    df = spark.createDataFrame(pdf)
    got = {r["id"]: (r["age"], r["fare"]) for r in fill_stats(df, median=["age"], mean=["fare"]).collect()}
    med, mean = pdf["age"].median(), pdf["fare"].mean()
    assert got[1] == (med, 4.0) and got[2] == (3.0, mean) and got[4][0] == med and got[5][1] == mean
