"""Plan-shape tests: the scale properties the README claims, checked on
the physical plans Spark actually produces."""

import re

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from tabforge.operators.quantile import exact_quantiles_multi, group_quantiles
from tabforge.operators.recipes import _stats_plan, aggregate
from tests.conftest import SF001


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_tail_uses_partial_window_group_limit(spark):
    plan = E.queries()["W04_tail_mean"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_no_unpartitioned_window_over_rows(spark):
    for name in ("W07_trailing_count", "V01_auc"):
        df = E.queries()[name](spark, SF001)
        plan = _plan(df)
        # a window without partition keys over raw rows would show 'SinglePartition'
        # on an exchange below a Window; the only allowed one is the tiny AUC offsets table
        windows = [ln for ln in plan.splitlines() if "Window [" in ln]
        assert windows, name
        for ln in windows:
            # "Window [exprs], [partition keys], [order]": keys must be present,
            # except for the AUC offsets table (one row per score range)
            m = re.search(r"\) AS [^\]]*\], \[([^\]]*)\](, \[([^\]]*)\])?\s*$", ln)
            assert m, ln
            partitioned = m.group(2) is not None and m.group(1).strip()
            assert partitioned or m.group(1).startswith("rng"), ln


def test_stats_join_never_shuffles_the_rows(spark):
    from tabforge.operators.recipes import enrich
    from tabforge.plans import credit
    from tabforge.plans.common import T
    recipes = [(k, [sp for sp in specs if sp[1] != "median"]) for k, specs in credit.APP_RECIPES]
    plan = _plan(enrich(credit.application(T(spark, SF001)), recipes))
    assert plan.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in plan


def test_scans_are_pruned(spark):
    df = E.queries()["A05_group_var"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def test_grouping_sets_equal_separate_aggregations(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").withColumn(
        "p", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    recipes = [(["p"], [("o_totalprice", "mean"), ("o_totalprice", "var")]),
               (["o_orderstatus", "p"], [("o_totalprice", "max"), ("o_custkey", "nunique")]),
               (["o_orderstatus"], [("o_totalprice", "sum"), ("o_totalprice", "median")])]
    together = aggregate(df, recipes)
    for (keys, a), r in zip(together, recipes):
        b = aggregate(df, [r])[0][1]
        pa = a.toPandas().sort_values(list(keys)).reset_index(drop=True)
        pb = b.toPandas().sort_values(list(keys)).reset_index(drop=True)
        pd.testing.assert_frame_equal(pa, pb, check_exact=False, rtol=1e-9)
        assert not pa[list(keys)].isna().any().any()          # C3: no group for a missing key
    combined, _ = _stats_plan(df, recipes)
    assert "Expand" in combined._jdf.queryExecution().executedPlan().toString()


def test_group_quantiles_match_pandas(spark):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    got = group_quantiles(df, "l_extendedprice", ["l_returnflag"], [0.25, 0.5, 0.75], ["a", "b", "c"]).toPandas()
    pdf = df.select("l_returnflag", "l_extendedprice").toPandas()
    want = pdf.groupby("l_returnflag")["l_extendedprice"].quantile([0.25, 0.5, 0.75]).unstack()
    for _, r in got.iterrows():
        w = want.loc[r["l_returnflag"]]
        assert abs(r["a"] - w[0.25]) < 1e-6 and abs(r["b"] - w[0.5]) < 1e-6 and abs(r["c"] - w[0.75]) < 1e-6


def test_group_quantiles_split_hot_groups(spark):
    """Every group is split into seven value ranges; ranks stay exact."""
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    got = group_quantiles(df, "l_extendedprice", ["l_returnflag"], [0.0, 0.25, 0.5, 0.9, 1.0],
                          ["a", "b", "c", "d", "e"], ranges=7).toPandas()
    pdf = df.select("l_returnflag", "l_extendedprice").toPandas()
    want = pdf.groupby("l_returnflag")["l_extendedprice"].quantile([0.0, 0.25, 0.5, 0.9, 1.0]).unstack()
    assert len(got) == len(want)
    for _, r in got.iterrows():
        w = want.loc[r["l_returnflag"]]
        for col, p in zip("abcde", [0.0, 0.25, 0.5, 0.9, 1.0]):
            assert abs(r[col] - w[p]) < 1e-6, (col, r[col], w[p])


def test_exact_quantiles_multi_match_pandas(spark):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    got = exact_quantiles_multi(df, {"l_quantity": [0.1, 0.5], "l_tax": [0.9]}, accuracy=50)
    pdf = df.select("l_quantity", "l_tax").toPandas()
    assert got["l_quantity"][0] == pdf["l_quantity"].quantile(0.1)
    assert got["l_quantity"][1] == pdf["l_quantity"].quantile(0.5)
    assert abs(got["l_tax"][0] - pdf["l_tax"].quantile(0.9)) < 1e-12


def test_hot_key_last_and_tail(spark):
    """A key with a third of the rows: last/tail results stay exact."""
    rows = [(0 if i % 3 == 0 else i, i, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    from tabforge.operators.recency import last_by, tail_stats
    last = {r["k"]: r["v"] for r in last_by(df, "k", ["o"], ["v"]).collect()}
    assert last[0] == 2997.0
    tail = tail_stats(df, "k", ["o"], [3], ["v"]).where("k = 0").first()
    assert tail["v_last_3_mean"] == (2997.0 + 2994.0 + 2991.0) / 3


def test_measured_side_too_big_is_not_broadcast(spark):
    from tabforge.operators.joins import join_measured
    big = spark.range(0, 20000).withColumnRenamed("id", "k")
    small = spark.range(0, 20000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")    # 1 KB: the side cannot fit
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1024")
        out = join_measured(big, small, "k", "left")
        plan = _plan(out)
        assert "BroadcastHashJoin" not in plan and out.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_recipe_slices_share_one_scan_of_the_source(spark):
    """Four key sets, with and without broadcast: the rows are scanned once,
    the statistics come from the stored table."""
    from tabforge.operators.recipes import enrich
    df = spark.read.parquet(f"{SF001}/orders.parquet").withColumn("m", F.month("o_orderdate"))
    recipes = [([k], [("o_totalprice", "mean")]) for k in ("o_custkey", "o_orderpriority", "o_orderstatus", "m")]
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                  "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for limit in ("10485760", "256"):
        try:
            for k in before:
                spark.conf.set(k, limit)
            out = enrich(df, recipes)
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            leaves = [ln for ln in plan.splitlines() if "Relation [" in ln]
            assert len([ln for ln in leaves if "o_orderkey" in ln]) == 1 and "Expand" not in plan
            assert out.count() == df.count()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
