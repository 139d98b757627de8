"""Time-bucket counts and rolling windows.

The trip program counts pickups per (hour, cluster), takes a trailing
240-minute mean of the observed hourly counts per cluster, shifts the
labels back 120 minutes (a centred window) and joins the result onto each
trip by its rounded hour.  The notebook also counts, for every event, the
events in the trailing 60 minutes over the whole table.

Scale notes
-----------
* ``bucket_counts`` is a partial aggregation; its output has one row per
  observed (bucket, key), bounded by the time span x keys, not by rows.
* ``rolling_mean`` windows over that small bucket table per key.
* ``trailing_count`` never uses an unpartitioned window.  Rows collapse to
  distinct timestamps, stored once; the count is the difference of two
  running sums over ranges of that table, however the rows are spread over
  time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .joins import join_measured
from .prefix import running_sums
from ..functions.timefn import (MICROS_PER_MINUTE, as_ntz, epoch_micros, floor_to_minutes,
                                from_epoch_micros, round_to_minutes)


def bucket_counts(df: DataFrame, ts: str, key: str, minutes: int = 60,
                  bucket_col: str = "bucket", count_col: str = "cnt",
                  count_of: str | None = None) -> DataFrame:
    """Rows per (tumbling bucket, key), observed buckets only.

    ``count_of`` counts the non-missing values of a column (``agg({'id':
    'count'})``); by default every row counts.
    """
    counted = F.count(F.col(count_of)) if count_of else F.count(F.lit(1))
    return (df.where(F.col(ts).isNotNull() & F.col(key).isNotNull())
            .groupBy(floor_to_minutes(ts, minutes).alias(bucket_col), F.col(key))
            .agg(counted.alias(count_col)))


def rolling_mean(counts: DataFrame, key: str, span_minutes: int = 240,
                 shift_minutes: int = -120, bucket_col: str = "bucket",
                 value_col: str = "cnt", out_col: str = "rolling_mean") -> DataFrame:
    """W05 + W06: trailing ``(t - span, t]`` mean of the observed buckets
    per key (C15), relabelled ``t + shift``.

    The frame is open on the left: ``RANGE`` over epoch microseconds from
    ``span - 1us`` before to the current row.
    """
    span = span_minutes * MICROS_PER_MINUTE
    w = (Window.partitionBy(key).orderBy(F.col("_t"))
         .rangeBetween(-(span - 1), Window.currentRow))
    shift = shift_minutes * MICROS_PER_MINUTE
    return (counts
            .withColumn("_t", epoch_micros(bucket_col))
            .select(F.col(key),
                    from_epoch_micros(F.col("_t") + F.lit(shift)).alias(bucket_col),
                    F.avg(F.col(value_col)).over(w).alias(out_col)))


def attach_bucket(df: DataFrame, labelled: DataFrame, ts: str, key: str,
                  round_minutes: int = 60, bucket_col: str = "bucket",
                  value_col: str = "rolling_mean", out_col: str | None = None,
                  fill: float = 0.0) -> DataFrame:
    """J06 (+T07): round each row's time to the nearest bucket (half-even)
    and left-join the labelled bucket values on (bucket, key); unmatched
    rows get ``fill``."""
    out_col = out_col or value_col
    rows = df.withColumn(bucket_col, round_to_minutes(ts, round_minutes))
    right = labelled.select(F.col(bucket_col), F.col(key), F.col(value_col).alias(out_col))
    return (join_measured(rows, right, [bucket_col, key], "left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(fill))))


def trailing_count(df: DataFrame, ts: str, span_minutes: int = 60, ranges: int | None = None,
                   out_col: str = "count_trailing") -> DataFrame:
    """For every row, the rows with a timestamp in ``(t - span, t]``
    over the whole table (tied timestamps all count, C16).

    1. Rows collapse to distinct timestamps with a weight (partial
       aggregate): any number of rows sharing a timestamp is one row.  Every
       timestamp also enters, with the same weight, ``span`` later, where its
       rows leave the window.  Both are stored as one table.
    2. Running sums over ranges of that table (``prefix.running_sums``): the
       count is what entered up to t minus what left up to t.  Ranges are
       cut by timestamps, not by time, so a burst spreads over tasks.
    3. The counts join back onto the rows by timestamp.
    """
    span = span_minutes * MICROS_PER_MINUTE
    moves = F.array(F.struct(F.col("_t"), F.col("_w").alias("_in"), F.lit(0).cast("long").alias("_out")),
                    F.struct((F.col("_t") + span).alias("_t"), F.lit(0).cast("long").alias("_in"), F.col("_w").alias("_out")))
    per = written(df.where(F.col(ts).isNotNull()).groupBy(epoch_micros(ts).alias("_t")).agg(F.count(F.lit(1)).alias("_w"))
                  .select(F.explode(moves).alias("_m")).select("_m.*").groupBy("_t")
                  .agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out")), "moves")
    counts = running_sums(per, "_t", {"_came": "_in", "_left": "_out"}, ranges=ranges).where("_in > 0") \
        .select("_t", (F.col("_came") - F.col("_left")).alias(out_col))
    rows = df.withColumn("_t", epoch_micros(ts))
    # one count per distinct timestamp grows with the data: a shuffle join
    # (AQE splits a hot timestamp), never materialised just to be measured
    return rows.join(counts, on="_t", how="left").drop("_t")


def hourly_ntz(ts: str) -> "F.Column":
    """Hour bucket start as TIMESTAMP_NTZ (used by chart data and tests)."""
    return F.date_trunc("HOUR", as_ntz(ts))
