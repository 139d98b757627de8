"""Operators rebuilt for size: prefix sums, dictionaries, grouped quantiles,
densities, one-scan augmentation, schema projections, C0 at ingest."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import encode, metrics, ml, prefix, profile, project
from tabforge.operators.quantile import grouping_quantiles
from tabforge.operators.recipes import enrich, stored_stats
from tabforge.operators.timebucket import trailing_count
from tabforge.sources import csv
from tabforge.sources.tables import missing_as_null
from tests.conftest import SF001


def _scans(df) -> int:
    """Parquet relations in the plan that are driver tables, not stored results."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len([ln for ln in plan.splitlines() if "Relation [" in ln])


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_sums_and_numbers(spark, ranges):
    rng = random.Random(ranges)
    keys = rng.sample(range(-10_000, 10_000), 700)
    df = spark.createDataFrame([(k, k % 13, 1) for k in keys], "k long, w long, one long").repartition(5)
    upto = {r["k"]: (r["s"], r["c"]) for r in prefix.running_sums(df, "k", {"s": "w", "c": "one"}, ranges=ranges).collect()}
    below = {r["k"]: r["s"] for r in prefix.running_sums(df, "k", {"s": "w"}, upto=False, ranges=ranges).collect()}
    total = 0
    for i, k in enumerate(sorted(keys)):
        assert below[k] == total
        total += k % 13
        assert upto[k] == (total, i + 1)
    numbers = {r["k"]: r["at"] for r in prefix.numbered(df, ["k"], "at").collect()}
    assert [numbers[k] for k in sorted(keys)] == list(range(700))
    assert prefix.running_sums(df.limit(0), "k", {"s": "w"}).count() == 0


def test_range_search_stays_short(spark):
    """A thousand cut points make no longer an expression tree than ten."""
    def depth(n):
        text = prefix.range_number(F.col("id"), list(range(n)), "bigint")._jc.toString()
        return text.count("CASE WHEN") + text.count("when")
    assert depth(1000) == depth(10)
    cuts = list(range(0, 3000, 3))
    rows = spark.range(-2, 3002).select("id", prefix.range_number(F.col("id"), cuts, "bigint").alias("r")).collect()
    assert all(r["r"] == sum(c < r["id"] for c in cuts) for r in rows[::97])


def test_trailing_count_spreads_a_burst(spark):
    """All timestamps but a few lie within one second: the ranges follow the
    rows, so no range holds much more than its share."""
    start = datetime(2024, 1, 1)
    times = [start + timedelta(microseconds=17 * i) for i in range(20_000)] + [start + timedelta(minutes=30 * i) for i in range(1, 20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, ts timestamp_ntz")
    got = {r["id"]: r["c"] for r in trailing_count(df, "ts", 60, 8, "c").collect()}
    t = np.array(times, "datetime64[us]")
    order = np.sort(t)
    want = np.searchsorted(order, t, "right") - np.searchsorted(order, t - np.timedelta64(60, "m"), "right")
    assert [got[i] for i in range(len(times))] == want.tolist()
    micros = df.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    cuts = prefix.cut_points(micros, "t", 8)
    sizes = micros.groupBy(prefix.range_number(F.col("t"), cuts, "bigint").alias("r")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * len(times) / 8


def test_auc_and_report_scan_once(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").select(
        (F.col("o_totalprice") % 97).alias("s"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"))
    plan = metrics.auc(df, "s", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "o_totalprice" not in plan        # only the stored scores are read
    report = metrics.class_report(df.withColumn("p", (F.col("s") > 50).cast("int")), "p", "y")
    assert _scans(report) == 1
    got = {r["cls"]: r for r in report.collect()}
    rows = [(r["y"], int(r["s"] > 50)) for r in df.collect()]
    for c in (0, 1):
        hit = sum(y == p == c for y, p in rows)
        assert got[c]["support"] == sum(y == c for y, _ in rows)
        assert got[c]["precision"] == pytest.approx(hit / sum(p == c for _, p in rows))
        assert got[c]["recall"] == pytest.approx(hit / got[c]["support"])


def test_a_class_that_is_only_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0), (None, 1), (1, None)], "y int, p int")
    got = {r["cls"]: (r["precision"], r["recall"], r["support"]) for r in metrics.class_report(df, "p", "y").collect()}
    assert got == {0: (0.5, 0.5, 2), 1: (0.0, 0.0, 1), 2: (0.0, 0.0, 0)}


def test_dictionary_of_many_categories(spark, monkeypatch):
    """100,000 categories: numbered without gaps in order of the features,
    met by a join; no list of them reaches the driver."""
    df = spark.range(100_000).select("id", F.concat(F.lit("c"), "id").alias("name"), F.when(F.col("id") % 3 == 0, "x").alias("kind"),
                                     (F.col("id") % 2).cast("double").alias("half"))
    seen = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(len(rows := collect(self))) or rows)
    dictionary = encode.fit_dictionary(df, ["name", "kind"], numbers=["half"])
    long = encode.encode_long(df, "id", dictionary, ["name", "kind"], ["half"])
    assert long.count() == 100_000 + 33_334 + 50_000
    sparse = encode.encode_sparse(df, "id", dictionary, ["name", "kind"], ["half"])
    assert sparse.where("size = 100002").count() == 100_000
    assert max(seen, default=0) <= 10
    monkeypatch.undo()
    at = {r["feature"]: r["index"] for r in dictionary.collect()}
    assert sorted(at, key=at.get) == sorted(at) and sorted(at.values()) == list(range(100_002))
    row = sparse.where("id = 3").first()
    assert row["indices"] == sorted([at["name=c3"], at["kind=x"], at["half"]]) and sorted(row["values"]) == [1.0, 1.0, 1.0]


def test_dictionary_unseen_missing_and_shared(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id long, c string")
    b = spark.createDataFrame([(1, "y"), (2, "z"), (3, None)], "id long, c string")
    da, db = encode.fit_dictionary(a, ["c"]), encode.fit_dictionary(b, ["c"])
    assert [(r["id"], r["feature"]) for r in encode.encode_long(b, "id", da, ["c"]).collect()] == [(1, "c=y")]
    got = {r["id"]: (r["size"], r["indices"]) for r in encode.encode_sparse(b, "id", da, ["c"]).collect()}
    assert got == {1: (2, [1]), 2: (2, []), 3: (2, [])}
    assert [(r["feature"], r["index"]) for r in encode.common_features(da, db).collect()] == [("c=y", 0)]


def test_medians_of_all_key_sets_from_one_pass(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").withColumn("p", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))) \
        .withColumn("m", F.month("o_orderdate"))
    recipes = [(["p"], [("o_totalprice", "median"), ("o_totalprice", "mean")]), (["m", "p"], [("o_totalprice", "median")]),
               (["o_orderstatus"], [("o_custkey", "median"), ("o_totalprice", "max")]), (["m"], [("o_custkey", "mean")])]
    parts = stored_stats(df, recipes)
    pdf = df.select("p", "m", "o_orderstatus", "o_totalprice", "o_custkey").toPandas()
    for (keys, stats), (_, specs) in zip(parts, recipes, strict=True):
        got = stats.toPandas().set_index(list(keys)).sort_index()
        want = pdf.groupby(list(keys))
        assert len(got) == want.ngroups
        for c, a in specs:
            assert np.allclose(got[f"{'_'.join(keys)}_{a}_{c}"], want[c].agg(a).sort_index())
    plan = enrich(df, recipes)._jdf.queryExecution().optimizedPlan().toString()
    # The rows are read once; each key set reads the one stored table.
    assert len([ln for ln in plan.splitlines() if "Relation [" in ln and "o_orderkey" in ln]) == 1
    q = grouping_quantiles(df, [["p"], ["m", "p"]], ["o_totalprice"], [0.5], ["q"])
    assert "o_orderkey" not in q._jdf.queryExecution().optimizedPlan().toString()


def test_density_matches_direct_sums(spark):
    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([rng.normal(0, 1, 300), rng.normal(40, 2, 100)]), 2)
    rows = [("a", float(v)) for v in x] + [("b", 1.0), ("b", 2.5), ("c", 7.0), ("d", 3.0), ("d", 3.0), ("a", None)]
    got = {}
    for r in profile.kde(spark.createDataFrame(rows, "k string, v double"), "v", "k", gridsize=70).collect():
        got.setdefault(r["k"], {})[r["gi"]] = (r["x"], r["density"])
    for k in "ab":
        v = np.array([b for a, b in rows if a == k and b is not None])
        bw = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 70)
        dens = np.exp(-0.5 * ((grid[:, None] - v) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))
        assert np.allclose([got[k][i][0] for i in range(70)], grid)
        assert np.allclose([got[k][i][1] for i in range(70)], dens, rtol=1e-9, atol=1e-300)
    assert all(d is None for k in "cd" for _, d in got[k].values())      # no spread, no bandwidth


def test_density_reaches_no_further_than_its_kernel(spark):
    """Values far apart against the bandwidth: each goes to few blocks."""
    df = spark.createDataFrame([(float(i % 2 * 1e6 + i * 1e-3),) for i in range(4000)], "v double")
    got = [r["density"] for r in profile.kde(df, "v", gridsize=320).collect()]
    assert len(got) == 320 and all(d >= 0 for d in got)


def test_noisy_copies_scan_once(spark):
    df = spark.read.parquet(f"{SF001}/part.parquet").select("p_partkey", "p_size")
    offsets = [{"p_size": 2}, {"p_size": -1}, {}]
    out = encode.noisy_copies(df, "p_partkey", 1000, offsets)
    assert _scans(out) == 1 and out.schema["p_size"].dataType == df.schema["p_size"].dataType
    want = sorted((r["p_partkey"] + s, r["p_size"] + o) for r in df.collect() for s, o in ((0, 0), (1000, 2), (1000, -1), (1000, 0)))
    assert sorted(map(tuple, out.collect())) == want
    apart = encode.noisy_copies(df, "p_partkey", 1000, offsets, distinct_ids=True)
    assert apart.select("p_partkey").distinct().count() == 4 * df.count()


def test_schema_projections(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, 2.5D AS c, DATE '2024-01-01' AS d, true AS e, 'y' AS `f.g`")
    assert project.without(df, ["a", "nowhere"]).columns == ["b", "c", "d", "e", "f.g"]
    assert project.by_type(df, "string").columns == ["b", "f.g"]
    assert project.by_type(df, "number", "time", keep=["e"]).columns == ["a", "c", "d", "e"]
    assert project.by_position(df, 1, -2).columns == ["b", "c", "d"]
    a, b = project.align(df, df.select("`f.g`", "a"))
    assert a.columns == b.columns == ["a", "f.g"]


def test_nan_is_missing_at_ingest(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,v,w\n1,NaN,2.5\n2,1.5,\n")
    rows = csv.read_csv(spark, str(tmp_path / "x.csv"), "id long, v double, w double").collect()
    assert [tuple(r) for r in rows] == [(1, None, 2.5), (2, 1.5, None)]
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id long, v double")
    assert [r["v"] for r in missing_as_null(df).orderBy("id").collect()] == [None, 1.0]


def test_mini_batches_come_close_to_full_kmeans(spark):
    rng = np.random.default_rng(2)
    at = rng.uniform(0, 100, size=(8, 2))
    x = np.concatenate([c + rng.normal(0, 2, size=(700, 2)) for c in at])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)] + [(9999, None, 1.0)], "id long, a double, b double")
    full = ml.centers_of(ml.kmeans_fit(df, ["a", "b"], k=8, seed=1, max_iter=40))
    small = ml.mini_batch_kmeans(df, ["a", "b"], "id", k=8, batch=500, steps=40, seed=1)
    best, got = (ml.inertia(df, ["a", "b"], c).first() for c in (full, small))
    assert got["n"] == best["n"] == 5600 and got["inertia"] <= 1.02 * best["inertia"]
    assert df.dropna().select(ml.assign_nearest(["a", "b"], small).alias("k")).where("k is null").count() == 0
    assert ml.mini_batch_kmeans(df.limit(0), ["a", "b"], "id", k=3) == []


def test_hashed_ids_do_not_depend_on_the_layout(spark):
    df = spark.range(2000)
    a = {r["id"] for r in ml.sample(df.repartition(7), 0.3, seed=4, id_col="id").collect()}
    assert a == {r["id"] for r in ml.sample(df.orderBy(F.desc("id")), 0.3, seed=4, id_col="id").collect()} and 500 < len(a) < 700
    folds = df.groupBy(ml.fold_col("id", 5, seed=1).alias("f")).count().collect()
    assert {r["f"] for r in folds} == set(range(5)) and min(r["count"] for r in folds) > 320


def test_stored_tables_are_removed_on_request(spark):
    from tabforge import session
    df = session.written(spark.range(10), "kept")
    path = session._written[-1]
    assert df.count() == 10 and session.release(spark) >= 1
    import os
    assert not os.path.exists(path) and session.release(spark) == 0
