"""Results must not depend on the session time zone: the driver tables load
as TIMESTAMP_NTZ and all time math here is wall-clock (no zone shifts).
Checked under a zone with a half-hour offset, where hour rounding through
a zoned timestamp would go wrong."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF01


def _facts(spark):
    q = E.queries()
    labels = q["W06_shifted_labels"](spark, SF01).agg(F.count(F.lit(1)), F.sum("rolling_mean")).first()
    joined = q["J06_attach_bucket_counts"](spark, SF01).agg(
        F.count(F.lit(1)), F.sum("dropoff_cluster_count"),
        F.sum((F.col("dropoff_cluster_count") == 0).cast("int"))).first()
    trailing = q["W07_trailing_count"](spark, SF01).agg(F.sum("count_60min")).first()[0]
    rounded = q["T07_round_half_even"](spark, SF01).agg(F.max("pickup_datetime_group")).first()[0]
    return tuple(labels), tuple(joined), trailing, rounded


def test_same_results_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        utc = _facts(spark)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = _facts(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert utc == other
    (n_labels, s_labels), (n_rows, s_rows, zeros), trailing, _ = utc
    # regression values of SURVEY §7.3 at sf0.01
    assert n_labels == 7236 and abs(s_labels - 9992.75) < 1e-3
    assert n_rows == 10000 and abs(s_rows - 7516.666667) < 1e-3 and zeros == 4960
    assert trailing == 149036
