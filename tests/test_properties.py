"""Property and brute-force tests (SURVEY §5, 'Ours')."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.functions import geo
from tabforge.operators import encode, metrics, ml
from tabforge.operators.quantile import exact_quantiles
from tabforge.operators.recipes import enrich
from tabforge.operators.timebucket import trailing_count
from tests.conftest import SF001


def test_window_form_equals_join_form(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    joined = enrich(df, [(["o_orderpriority"], [("o_totalprice", "mean")])], deviations=False)
    w = Window.partitionBy("o_orderpriority")
    win = df.select("o_orderkey", F.avg("o_totalprice").over(w).alias("w"))
    diff = joined.join(win, "o_orderkey").where(
        F.abs(F.col("o_orderpriority_mean_o_totalprice") - F.col("w")) > 1e-9).count()
    assert diff == 0


def test_haversine_symmetric_and_zero(spark):
    df = spark.createDataFrame([(40.7, -74.0, 40.8, -73.9), (40.7, -74.0, 40.7, -74.0)], "a double, b double, c double, d double")
    r = df.select(geo.haversine("a", "b", "c", "d").alias("x"), geo.haversine("c", "d", "a", "b").alias("y")).collect()
    assert r[0]["x"] == pytest.approx(r[0]["y"]) and r[1]["x"] == 0.0
    assert r[0]["x"] == pytest.approx(13.9, abs=0.2)


def test_pca_l1_invariant_to_sign(spark):
    pts = spark.createDataFrame([(float(i), 2.0 * i + (i % 3)) for i in range(50)], "x double, y double")
    fit = ml.pca2_fit(pts, "x", "y")
    flipped = dict(fit, theta=fit["theta"] + math.pi)
    rows = spark.createDataFrame([(1.0, 2.0, 5.0, 9.0)], "ax double, ay double, bx double, by double")

    def l1(f):
        a0, a1 = ml.pca2_transform(f, "ax", "ay")
        b0, b1 = ml.pca2_transform(f, "bx", "by")
        return rows.select((F.abs(b0 - a0) + F.abs(b1 - a1)).alias("d")).first()["d"]
    assert l1(fit) == pytest.approx(l1(flipped))


def test_one_hot_row_sums_at_most_one(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("p"))
    out = encode.one_hot(df, encode.fit_categories(df, ["p"]))
    flags = [c for c in out.columns if c.startswith("p_")]
    sums = out.select(sum(F.col(c) for c in flags).alias("s")).distinct().collect()
    assert {r["s"] for r in sums} <= {0, 1}


def test_fold_counts_sum_to_n(spark):
    df = spark.read.parquet(f"{SF001}/customer.parquet")
    n = df.count()
    got = df.select(ml.fold_col("c_custkey", 5, seed=1024).alias("f")).groupBy("f").count().collect()
    assert sum(r["count"] for r in got) == n and {r["f"] for r in got} <= set(range(5))


def test_auc_matches_rank_formula_and_flips(spark):
    rng = np.random.default_rng(0)
    s = rng.integers(0, 20, 300).astype(float)
    y = (rng.random(300) < 0.3 + s / 40).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    a = metrics.auc(df, "s", "y", partitions=7).first()["auc"]
    ranks = pd.Series(s).rank()
    pos = y == 1
    ref = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert a == pytest.approx(ref)
    b = metrics.auc(df.withColumn("s", -F.col("s")), "s", "y").first()["auc"]
    assert a + b == pytest.approx(1.0)


def test_trailing_count_brute_force(spark):
    rng = np.random.default_rng(1)
    base = np.datetime64("2024-01-01T00:00:00")
    secs = np.sort(rng.integers(0, 6 * 3600, 400))
    secs[10] = secs[11]                                   # a tie
    secs[20] = secs[19] + 3600                            # exactly one span apart
    ts = pd.to_datetime(base + secs.astype("timedelta64[s]"))
    pdf = pd.DataFrame({"id": range(len(ts)), "ts": ts})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r["id"]: r["c"] for r in trailing_count(df, "ts", 60, 60, "c").collect()}
    got_fine = {r["id"]: r["c"] for r in trailing_count(df, "ts", 60, 15, "c").collect()}
    assert got == got_fine
    t = pdf["ts"].values
    for i, ti in enumerate(t):
        want = int(((t > ti - np.timedelta64(60, "m")) & (t <= ti)).sum())
        assert got[i] == want


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=1001), 3)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.75, 1.0], accuracy=100)
    want = pd.Series(x).quantile([0.0, 0.25, 0.5, 0.75, 1.0]).tolist()
    assert got == pytest.approx(want)


def test_invariant_to_repartition(spark):
    from tabforge.operators.recipes import aggregate
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    spec = [(["l_suppkey"], [("l_quantity", "mean"), ("l_extendedprice", "var"), ("l_tax", "median")])]
    a = aggregate(df, spec)[0][1].toPandas().sort_values("l_suppkey").reset_index(drop=True)
    b = aggregate(df.repartition(13), spec)[0][1].toPandas().sort_values("l_suppkey").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)


def test_noisy_copies_offsets_are_per_copy_and_column(spark):
    df = spark.createDataFrame([(1, 100, 5), (2, 200, 6)], "Id int, Elevation int, H int")
    offs = encode.draw_offsets(3, {"Elevation": (-50, 50), "H": (-10, 10)}, seed=3)
    out = encode.noisy_copies(df, "Id", 15120, offs)
    assert out.count() == 8
    shifted = out.where(F.col("Id") > 15120).select((F.col("Elevation") - F.col("Id") + 15120).alias("d"))
    assert shifted.count() == 6
