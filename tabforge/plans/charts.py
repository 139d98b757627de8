"""Sorts, summaries and chart tables over the driver tables (O01-O03,
D03, D07, D10, D11, D13) and the ranking metric (V01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, ml, profile
from . import cover, trip
from .common import TS, R, T, finish, query, ts_text


@query("O01_sort_multi_key", f"SELECT o_custkey, {TS('o_orderdate')} AS o_orderdate, o_orderkey FROM orders "
       "ORDER BY o_custkey, orders.o_orderdate, o_orderkey")
def o01_sort_multi_key(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return (o.orderBy("o_custkey", "o_orderdate", "o_orderkey")
            .select("o_custkey", ts_text(F.col("o_orderdate")).alias("o_orderdate"), "o_orderkey"))


@query("O02_sort_desc", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1 ORDER BY count DESC")
def o02_sort_desc(spark, sf_dir):
    return T(spark, sf_dir).orders.groupBy("o_orderpriority").count().orderBy(F.desc("count"))


@query("O03_head", f"""SELECT o_orderkey, {R('o_totalprice')} AS o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o03_head(spark, sf_dir):
    o = T(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return finish(profile.head(o, 10, [F.desc("o_totalprice"), "o_orderkey"]))


DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("D03_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})')} AS std, "
    f"{R(f'min({c})')} AS min, {R(f'quantile_cont({c}, 0.25)')} AS p25, {R(f'median({c})')} AS p50, "
    f"{R(f'quantile_cont({c}, 0.75)')} AS p75, {R(f'max({c})')} AS max FROM lineitem" for c in DESC_COLS))
def d03_describe(spark, sf_dir):
    return finish(profile.describe(T(spark, sf_dir).lineitem, DESC_COLS))


@query("D07_histogram", f"""{trip.ALL_SQL},
b AS (SELECT min(log_trip_duration) AS lo, max(log_trip_duration) AS hi FROM train)
SELECT CAST(least(floor((log_trip_duration - lo) / ((hi - lo) / 100)), 99) AS INTEGER) AS bin, count(*) AS count
FROM train, b GROUP BY 1""")
def d07_histogram(spark, sf_dir):
    train, _ = trip.splits(T(spark, sf_dir))
    return profile.histogram(train, "log_trip_duration", bins=100).select("bin", "count")


_BOX = f"""WITH {cover.COVER_SQL},
q AS (SELECT Cover_Type, quantile_cont({cover.RD}, 0.25) AS q1, median({cover.RD}) AS median,
             quantile_cont({cover.RD}, 0.75) AS q3 FROM ctrain GROUP BY 1),
j AS (SELECT c.Cover_Type, q1, median, q3, CAST({cover.RD} AS DOUBLE) AS v,
             {cover.RD} >= q1 - 1.5 * (q3 - q1) AND {cover.RD} <= q3 + 1.5 * (q3 - q1) AS inside
      FROM ctrain c JOIN q USING (Cover_Type))
SELECT Cover_Type, {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3,
       {R('min(v) FILTER (WHERE inside)')} AS whisker_low, {R('max(v) FILTER (WHERE inside)')} AS whisker_high,
       count(*) FILTER (WHERE NOT inside) AS outliers
FROM j GROUP BY Cover_Type, q1, median, q3"""


@query("D10_box_stats", _BOX)
def d10_box_stats(spark, sf_dir):
    return finish(profile.box_stats(cover.train_split(T(spark, sf_dir)), cover.RD, "Cover_Type"))


@query("D11_violin", f"""WITH {cover.COVER_SQL},
d AS (SELECT Cover_Type, CAST(Elevation AS DOUBLE) AS v FROM ctrain),
s AS (SELECT Cover_Type, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS bw, min(v) AS lo, max(v) AS hi,
             quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3
      FROM d GROUP BY 1),
g AS (SELECT s.*, gi, lo - 3 * bw + gi * ((hi - lo + 6 * bw) / 99) AS x FROM s, range(100) r(gi))
SELECT g.Cover_Type, CAST(gi AS INTEGER) AS gi, {R('x')} AS x,
       {R('sum(exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) / (n * bw * sqrt(2 * pi()))')} AS density,
       {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3
FROM g JOIN d USING (Cover_Type) GROUP BY g.Cover_Type, gi, x, n, bw, q1, median, q3""")
def d11_violin(spark, sf_dir):
    return finish(profile.violin(cover.train_split(T(spark, sf_dir)), "Elevation", "Cover_Type", gridsize=100))


SCATTER = [("pickup_longitude", "pickup_latitude"), ("dropoff_longitude", "dropoff_latitude")]


@query("D13_scatter_sample", f"WITH {trip.TRIPS_SQL}, s AS (SELECT * FROM train WHERE {ml.id_hash_sql('id', 7)} < {ml.HASH_RANGE} / 8) " + " UNION ALL ".join(
    f"SELECT '{a}' AS x_name, '{b}' AS y_name, {R(a)} AS x, {R(b)} AS y, vendor_id FROM s WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    for a, b in SCATTER))
def d13_scatter_sample(spark, sf_dir):
    train, _ = trip.splits(T(spark, sf_dir))
    return finish(profile.scatter_sample(train, SCATTER, "vendor_id", fraction=0.125, seed=7, id_col="id"))


# --- V01: AUC of a deterministic score against document quality labels ----------------------------
@query("V01_auc", f"""WITH s AS (
  SELECT CAST(d.n_chars % 997 AS DOUBLE) / 997 + CAST(d.doc_id % 7 AS DOUBLE) / 10 AS s, l.quality AS y
  FROM documents d JOIN labels l USING (doc_id)),
per AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY s),
cum AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM per)
SELECT {R('sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg))')} AS auc, CAST(sum(pos) + sum(neg) AS BIGINT) AS n FROM cum""")
def v01_auc(spark, sf_dir):
    t = T(spark, sf_dir)
    s = t.documents.join(t.labels, "doc_id").select(
        ((F.col("n_chars") % 997).cast("double") / 997 + (F.col("doc_id") % 7).cast("double") / 10).alias("s"),
        F.col("quality").alias("y"))
    return finish(metrics.auc(s, "s", "y"))
