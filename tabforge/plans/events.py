"""Time-bucket features of the trip program on the ``events`` table.

Events stand in for pickups: ``ts`` is the pickup time and the cluster is
``user_id % 20`` (SURVEY §7.3).  Regression values at sf0.01: 7236
labelled buckets summing to 9992.75; 10,000 joined rows summing to
7516.666667 with 4960 zeros; trailing 60-minute counts summing to 149036.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.timebucket import attach_bucket, bucket_counts, rolling_mean, trailing_count
from .common import TS, R, T, finish, query, ts_text

EV_SQL = """
ev AS (SELECT event_id, ts, CAST(user_id % 20 AS INTEGER) AS cluster FROM events),
counts AS (SELECT date_trunc('hour', ts) AS bucket, cluster, count(event_id) AS cnt FROM ev GROUP BY 1, 2),
rolled AS (
  SELECT cluster, bucket,
         avg(cnt) OVER (PARTITION BY cluster ORDER BY epoch_us(bucket)
                        RANGE BETWEEN 14399999999 PRECEDING AND CURRENT ROW) AS rolling_mean
  FROM counts),
labels AS (SELECT cluster, bucket - INTERVAL 120 MINUTE AS bucket, rolling_mean FROM rolled)"""


def ev(t) -> DataFrame:
    return t.events.select("event_id", "ts", (F.col("user_id") % 20).cast("int").alias("cluster"))


def counts(t) -> DataFrame:
    return bucket_counts(ev(t), "ts", "cluster", 60, count_of="event_id")


def labels(t, shift: int = -120) -> DataFrame:
    return rolling_mean(counts(t), "cluster", span_minutes=240, shift_minutes=shift)


@query("A14_bucket_counts", f"WITH {EV_SQL} SELECT {TS('bucket')} AS bucket, cluster, cnt FROM counts")
def a14_bucket_counts(spark, sf_dir):
    return counts(T(spark, sf_dir)).withColumn("bucket", ts_text(F.col("bucket")))


@query("W05_rolling_mean", f"WITH {EV_SQL} SELECT cluster, {TS('bucket')} AS bucket, {R('rolling_mean')} AS rolling_mean FROM rolled")
def w05_rolling_mean(spark, sf_dir):
    return finish(labels(T(spark, sf_dir), shift=0)).withColumn("bucket", ts_text(F.col("bucket")))


@query("W06_shifted_labels", f"WITH {EV_SQL} SELECT cluster, {TS('bucket')} AS bucket, {R('rolling_mean')} AS rolling_mean FROM labels")
def w06_shifted_labels(spark, sf_dir):
    return finish(labels(T(spark, sf_dir))).withColumn("bucket", ts_text(F.col("bucket")))


@query("J06_attach_bucket_counts", f"""WITH {EV_SQL},
rounded AS (SELECT event_id, cluster,
                   make_timestamp(CAST(round_even(epoch_us(ts) / 3600000000.0, 0) * 3600000000 AS BIGINT)) AS bucket
            FROM ev)
SELECT r.event_id, {R('coalesce(l.rolling_mean, 0)')} AS dropoff_cluster_count
FROM rounded r LEFT JOIN labels l ON r.bucket = l.bucket AND r.cluster = l.cluster""")
def j06_attach_bucket_counts(spark, sf_dir):
    t = T(spark, sf_dir)
    out = attach_bucket(ev(t), labels(t), "ts", "cluster", round_minutes=60,
                        out_col="dropoff_cluster_count")
    return finish(out.select("event_id", "dropoff_cluster_count"))


@query("W07_trailing_count", """
SELECT e.event_id, count(*) AS count_60min
FROM events e JOIN events p ON p.ts > e.ts - INTERVAL 60 MINUTE AND p.ts <= e.ts
GROUP BY e.event_id""")
def w07_trailing_count(spark, sf_dir):
    e = T(spark, sf_dir).events.select("event_id", "ts")
    return trailing_count(e, "ts", span_minutes=60, out_col="count_60min") \
        .select("event_id", "count_60min")
